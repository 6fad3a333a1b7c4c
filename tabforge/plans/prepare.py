"""Model-ready frame: null, category, group-size and outlier filters, label
encoding, and the unfitted feature stages."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.config import (
    ALLOWED_CATEGORIES,
    ALPHA_DESC_COLUMN,
    CATEGORY_COLUMN,
    GROUP_MIN_COUNT,
    ID_COLUMN,
    IQR_FACTOR,
    LABEL_COLUMN,
    NUMERIC_FEATURES,
    OUTLIER_COLUMNS,
    QUANTILE_REL_ERROR,
)
from tabforge.functions.mapping import encode_label
from tabforge.operators import filters as flt
from tabforge.operators.aggregates import group_counts
from tabforge.operators.features import feature_stages
from tabforge.session import scratch_path


@dataclass
class PrepareSpec:
    """Roles and thresholds of the preparation; defaults are the source's."""

    id_column: str | None = ID_COLUMN
    category: str = CATEGORY_COLUMN
    allowed: list[str] | None = field(default_factory=lambda: list(ALLOWED_CATEGORIES))
    min_count: int = GROUP_MIN_COUNT
    outlier_columns: list[str] = field(default_factory=lambda: list(OUTLIER_COLUMNS))
    iqr_factor: float = IQR_FACTOR
    rel_error: float = QUANTILE_REL_ERROR
    label: str = LABEL_COLUMN
    numeric: list[str] = field(default_factory=lambda: list(NUMERIC_FEATURES))
    alpha_desc: str | None = ALPHA_DESC_COLUMN
    handle_invalid: str = "error"
    # How the filtered frame is kept for the trimming passes: 'table' (Parquet in
    # the shared folder: each pass reads one column, within its bounds), 'persist'
    # (memory and disk) or None.
    materialize: str | None = "table"


def prepare(df: DataFrame, spec: PrepareSpec | None = None) -> DataFrame:
    """Drop rows with any null, drop the id, keep allowed categories with more
    than ``min_count`` rows, trim outliers, encode the label (yes 1 / no 0)."""
    s = spec or PrepareSpec()
    out = flt.drop_any_null(df)
    if s.id_column and s.id_column in out.columns:
        out = out.drop(s.id_column)
    bound = None
    if s.allowed is not None:
        out = flt.allowed_values(out, s.category, s.allowed)
        bound = len(s.allowed)
    out = flt.min_group_size(out, s.category, s.min_count, max_groups=bound)
    if s.outlier_columns and s.materialize == "table":
        path = scratch_path(out.sparkSession, "prepared")
        out.write.parquet(path)
        out = out.sparkSession.read.schema(out.schema).parquet(path)
    elif s.outlier_columns and s.materialize == "persist":
        out = out.persist(StorageLevel.MEMORY_AND_DISK)
    out = flt.iqr_trim(out, s.outlier_columns, s.iqr_factor, s.rel_error)
    return out.withColumn(s.label, encode_label(s.label))


def category_report(df: DataFrame, spec: PrepareSpec | None = None) -> DataFrame:
    """Rows per category of the prepared frame."""
    s = spec or PrepareSpec()
    return group_counts(df, s.category)


def stages_for(spec: PrepareSpec | None = None) -> list:
    """The unfitted feature stages for the spec's column roles."""
    s = spec or PrepareSpec()
    return feature_stages(s.numeric, s.alpha_desc, s.category, s.handle_invalid)


def model_columns(spec: PrepareSpec | None = None) -> Sequence[str]:
    """Raw input columns a fitted model reads."""
    s = spec or PrepareSpec()
    return [*s.numeric, *([s.alpha_desc] if s.alpha_desc else []), s.category]

