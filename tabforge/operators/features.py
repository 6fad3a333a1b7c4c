"""Feature stages: category indexing, one-hot, assembly, min-max scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import MinMaxScaler, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.config import ALPHA_DESC_COLUMN, CATEGORY_COLUMN, NUMERIC_FEATURES


def alpha_desc_indexer(column: str = ALPHA_DESC_COLUMN, handle_invalid: str = "error") -> StringIndexer:
    """Index a category in reverse alphabetical order (``M`` → 0.0, ``F`` → 1.0)."""
    return StringIndexer(inputCol=column, outputCol=f"{column}_index",
                         stringOrderType="alphabetDesc", handleInvalid=handle_invalid)


def freq_indexer(column: str = CATEGORY_COLUMN, handle_invalid: str = "error") -> StringIndexer:
    """Index a category by falling frequency, ties alphabetical."""
    return StringIndexer(inputCol=column, outputCol=f"{column}_index",
                         stringOrderType="frequencyDesc", handleInvalid=handle_invalid)


def one_hot(column: str = CATEGORY_COLUMN) -> OneHotEncoder:
    """One-hot vector of an index column, no slot dropped."""
    return OneHotEncoder(inputCols=[f"{column}_index"], outputCols=[f"{column}_vec"], dropLast=False)


def assembler(numeric: Sequence[str], encoded: Sequence[str], output: str = "features") -> VectorAssembler:
    """Concatenate numeric columns and encoded vectors into one vector."""
    return VectorAssembler(inputCols=[*numeric, *encoded], outputCol=output)


def min_max(input_col: str = "features", output_col: str = "scaledFeatures") -> MinMaxScaler:
    """Scale every vector slot to [0, 1] (a constant slot → 0.5)."""
    return MinMaxScaler(inputCol=input_col, outputCol=output_col)


def feature_stages(
    numeric: Sequence[str] = NUMERIC_FEATURES,
    alpha_desc: str | None = ALPHA_DESC_COLUMN,
    category: str | None = CATEGORY_COLUMN,
    handle_invalid: str = "error",
) -> list:
    """The unfitted stages: indexers, one-hot, assembler, scaler.

    Slots: the numeric columns, the alpha-desc index, then one per category.
    """
    stages: list = []
    encoded: list[str] = []
    if alpha_desc:
        stages.append(alpha_desc_indexer(alpha_desc, handle_invalid))
        encoded.append(f"{alpha_desc}_index")
    if category:
        stages += [freq_indexer(category, handle_invalid), one_hot(category)]
        encoded.append(f"{category}_vec")
    stages += [assembler(numeric, encoded), min_max()]
    return stages


def vector_columns(df: DataFrame, column: str, size: int, prefix: str) -> DataFrame:
    """Replace a vector column by ``size`` double columns ``prefix_0..``."""
    arr = vector_to_array(F.col(column))
    return df.select(*[c for c in df.columns if c != column], *[arr[i].alias(f"{prefix}_{i}") for i in range(size)])


def slot_names(df: DataFrame, column: str = "features") -> list[str]:
    """Names of a vector column's slots, from its ML attribute metadata."""
    meta = df.schema[column].metadata.get("ml_attr", {})
    attrs = meta.get("attrs", {})
    slots: dict[int, str] = {}
    for group in attrs.values():
        for a in group:
            slots[a["idx"]] = a.get("name", f"slot_{a['idx']}")
    n = meta.get("num_attrs", len(slots))
    return [slots.get(i, f"slot_{i}") for i in range(n)]
