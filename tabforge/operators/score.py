"""Batch scoring with a fitted pipeline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.functions.coerce import safe_double
from tabforge.functions.mapping import decode_label
from tabforge.functions.text import is_missing


def scoring_input(df: DataFrame, numeric: Sequence[str], text: Sequence[str]) -> DataFrame:
    """Typed model input: numeric fields by :func:`safe_double`, text kept.

    A field that does not parse becomes null and is named in ``input_error``
    (null when the row is clean), so one bad request never fails a batch.
    """
    casts = {c: safe_double(c) for c in numeric}
    bad = [F.when(F.col(c).isNotNull() & casts[c].isNull(), F.lit(c)) for c in numeric]
    missing = [F.when(F.col(c).isNull(), F.lit(c)) for c in [*numeric, *text]]
    err = F.concat_ws(",", *bad, *missing)
    keep = [c for c in df.columns if c not in casts]
    out = df.select(*keep, *[v.alias(k) for k, v in casts.items()], F.when(err != "", err).alias("input_error"))
    return out


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str] = (), output: str = "response") -> DataFrame:
    """``model.transform`` then 1 → ``Yes`` / else ``No``; narrow transform only."""
    pred = model.transform(df)
    return pred.select(*keep, decode_label("prediction").alias(output))


def model_inputs(model: PipelineModel) -> tuple[list[str], dict[str, list[str]]]:
    """Raw columns a fitted pipeline reads: (numeric columns, {category column:
    labels known to its indexer}) — labels only for indexers that reject
    unseen values (``handleInvalid='error'``); their count is the category count."""
    from pyspark.ml.feature import OneHotEncoderModel, StringIndexerModel, VectorAssembler

    produced: set[str] = set()
    numeric: list[str] = []
    cats: dict[str, list[str]] = {}
    for st in model.stages:
        if isinstance(st, StringIndexerModel):
            for i, (src, dst) in enumerate(zip(_in_cols(st), _out_cols(st))):
                if st.getHandleInvalid() == "error":
                    cats[src] = list(st.labelsArray[i])
                produced.add(dst)
        elif isinstance(st, OneHotEncoderModel):
            produced.update(st.getOutputCols())
        elif isinstance(st, VectorAssembler):
            numeric += [c for c in st.getInputCols() if c not in produced and c not in numeric]
            produced.add(st.getOutputCol())
    return numeric, cats


def _in_cols(st):
    return st.getInputCols() if st.isSet("inputCols") else [st.getInputCol()]


def _out_cols(st):
    return st.getOutputCols() if st.isSet("outputCols") else [st.getOutputCol()]


def score_checked(model: PipelineModel, df: DataFrame, keep: Sequence[str] = (), output: str = "response") -> DataFrame:
    """Score every row in one pass, never failing on bad input.

    A row is flagged in ``input_error`` (comma-separated column names) when a
    model input is null, unparsable (from :func:`scoring_input`), NaN or infinite,
    or holds a category its indexer has not seen. Flagged rows get placeholder inputs so
    no stage can fail, and a null ``output``; clean rows are scored. One scan,
    one narrow transform, row count kept — usable on a stream as well.
    """
    numeric, cats = model_inputs(model)
    unknown = [F.when(F.col(c).isNotNull() & ~F.col(c).isin(labels), F.lit(c)) for c, labels in cats.items()]
    prior = [F.col("input_error")] if "input_error" in df.columns else []
    missing = [F.when(F.col(c).isNull(), F.lit(c)) for c in [*numeric, *cats] if "input_error" not in df.columns]
    # Typed input may hold numbers that no stage takes.
    types = dict(df.dtypes)
    odd = [F.when(F.col(c).isNotNull() & (is_missing(c, True) | (F.abs(c) == float("inf"))), F.lit(c)) for c in numeric if types[c] in ("double", "float")]
    err = F.concat_ws(",", *prior, *missing, *odd, *unknown)
    flagged = df.withColumn("input_error", F.when(err != "", err))
    ok = F.col("input_error").isNull()
    safe = {c: F.when(ok, F.col(c)).otherwise(F.lit(0.0)) for c in numeric}
    safe.update({c: F.when(ok, F.col(c)).otherwise(F.lit(labels[0] if labels else "")) for c, labels in cats.items()})
    pred = model.transform(flagged.withColumns(safe))
    return pred.select(*keep, "input_error", F.when(ok, decode_label("prediction")).alias(output))
