"""Row filters: nulls, ids, sentinels, cell validity, allowed values, group
size and outlier trimming.

All are lazy filters or joins over the input plan; predicates on plain
columns reach the Parquet reader (``PushedFilters``). The only values brought
to the driver are the two quartile bounds per trimmed column (and, for exact
quartiles, a few counts per pass).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.config import (
    ALLOWED_CATEGORIES,
    CATEGORY_COLUMN,
    GROUP_MIN_COUNT,
    ID_COLUMN,
    IQR_FACTOR,
    OUTLIER_COLUMNS,
    QUANTILE_REL_ERROR,
    REQUIRED_COLUMNS,
    SENTINEL_COLUMN,
    SENTINEL_VALUE,
)
from tabforge.functions.coerce import coerce_frame
from tabforge.functions.text import cell_is_valid
from tabforge.operators.aggregates import group_counts, quartile_bounds


def require_columns(df: DataFrame, columns: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Drop rows that are null in any of ``columns``."""
    return df.na.drop(how="any", subset=list(columns))


def fence(df: DataFrame, label: str) -> DataFrame:
    """Observe the row count here (no extra job) and stop predicate pushdown.

    Catalyst pushes a filter down through projections by substituting each
    column by its defining expression. For parsed columns that copies regexes
    and parsers into the pushed predicate (evaluated again in the projection).
    Predicates are not pushed through an observation node, so a filter on a
    parsed column placed after the fence reads the computed value. The metric
    ``rows`` is published under ``tabforge.<label>.<id>`` to query listeners.
    (Name-based, deliberately: ``Observation`` objects attach a manager to the
    session that fitted logistic-regression models then fail to serialize.)
    """
    return df.observe(f"tabforge.{label}.{uuid.uuid4().hex[:8]}", F.count(F.lit(1)).alias("rows"))


def numeric_id(df: DataFrame, column: str = ID_COLUMN) -> DataFrame:
    """Turn the id column into bigint and drop rows whose id does not parse."""
    parsed = fence(coerce_frame(df, {column: "Int64"}), "parsed_id")
    return parsed.filter(F.col(column).isNotNull())


def exclude_value(df: DataFrame, column: str = SENTINEL_COLUMN, value: str = SENTINEL_VALUE) -> DataFrame:
    """Drop rows equal to the sentinel; null rows stay."""
    return df.filter(~F.col(column).eqNullSafe(value))


def valid_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep rows whose every text cell is valid (:func:`cell_is_valid`)."""
    from tabforge.operators.columns import string_columns

    cols = list(columns) if columns is not None else string_columns(df)
    if not cols:
        return df
    return df.filter(reduce(lambda a, b: a & b, [cell_is_valid(F.col(f"`{c}`")) for c in cols]))


def drop_any_null(df: DataFrame) -> DataFrame:
    """Drop rows with a null (or NaN) in any column."""
    return df.na.drop(how="any")


def allowed_values(df: DataFrame, column: str = CATEGORY_COLUMN, values: Sequence = ALLOWED_CATEGORIES) -> DataFrame:
    """Keep rows whose value is in the list (an ``In`` pushed to the scan)."""
    return df.filter(F.col(column).isin(list(values)))


def min_group_size(
    df: DataFrame,
    column: str = CATEGORY_COLUMN,
    min_count: int = GROUP_MIN_COUNT,
    max_groups: int | None = None,
) -> DataFrame:
    """Keep rows whose group has strictly more than ``min_count`` rows.

    The counts are a partial + final hash aggregate (a hot group is combined
    map-side), joined back with a left-semi join. ``max_groups`` states a proven
    bound on the number of groups (e.g. after :func:`allowed_values`); only then
    is the count table broadcast. Without it the join strategy is left to AQE,
    which broadcasts from runtime sizes and splits skewed partitions otherwise.
    """
    keep = group_counts(df, column).filter(F.col("count") > min_count).select(column)
    if max_groups is not None:
        keep = F.broadcast(keep)
    return df.join(keep, on=column, how="left_semi")


def in_range(df: DataFrame, column: str, lower: Column | float, upper: Column | float) -> DataFrame:
    """Inclusive range filter."""
    return df.filter(F.col(column).between(lower, upper))


def iqr_trim(
    df: DataFrame,
    columns: Sequence[str] = OUTLIER_COLUMNS,
    factor: float = IQR_FACTOR,
    rel_error: float = QUANTILE_REL_ERROR,
) -> DataFrame:
    """Remove outliers column by column with the interquartile-range rule.

    Sequential, like the source: the quartiles of column *k* are taken over the
    rows that survived columns *1..k-1*. Per column one aggregate job computes
    a ``percentile_approx`` sketch (bounded memory, partial + final aggregate,
    column-pruned scan) and returns two doubles; they become literal bounds of
    an inclusive range filter, which Parquet scans push down. With
    ``rel_error`` ≤ 1/rows the quartiles are exact. No quartile (empty input)
    → no row passes. Each column costs one pass over ``df``: materialise an
    expensive ``df`` first (see :func:`tabforge.plans.prepare.prepare`).
    """
    out = df
    for c in columns:
        row = quartile_bounds(out, c, factor=factor, rel_error=rel_error).first()
        bounds = row["bounds"] if row is not None else None
        lo = bounds["lower"] if bounds is not None else None
        hi = bounds["upper"] if bounds is not None else None
        out = in_range(out, c, F.lit(lo).cast("double"), F.lit(hi).cast("double"))
    return out
