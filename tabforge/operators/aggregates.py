"""Aggregates: group counts, quartiles, null counts, best / latest rows,
next version numbers.

All are hash aggregates with a partial (map-side) step, so a key holding a
large share of the rows is combined before the shuffle and never lands whole
in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.config import IQR_FACTOR, QUANTILE_REL_ERROR
from tabforge.functions.text import is_missing


def group_counts(df: DataFrame, column: str | Sequence[str]) -> DataFrame:
    """Rows per group, as ``count``."""
    cols = [column] if isinstance(column, str) else list(column)
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("count"))


def _accuracy(rel_error: float) -> int:
    if not rel_error > 0:
        raise ValueError("rel_error must be > 0 for the sketch; use exact_quantiles for 0")
    return max(1, int(math.ceil(1.0 / rel_error)))


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float], accuracy: int = 10_000) -> list[float | None]:
    """Exact lower quantiles (``percentile_disc``): for each p the k-th
    smallest non-null, non-NaN value, k = max(1, ceil(p * n)); infinities count.

    One algorithm at every size. A pass asks a quantile sketch for the value at
    the target rank and for those a little before and after it, the next counts
    exactly how many rows lie below and at these values. Either one of them is
    the answer, or the target lies strictly between two of them; then the next
    passes read this open range only (a filter that the Parquet reader gets).
    A range holds about ``4 / accuracy`` of the rows of the one before, and each
    drops at least the values just counted, so the search ends on any data. All
    targets share the passes; a few numbers reach the driver in each.
    """
    raw = F.col(column)
    values = df.select(raw.cast("double").alias("_x")).filter(F.col("_x").isNotNull() & ~F.isnan("_x"))
    x = F.col("_x")
    goals = {i: None for i in range(len(probs))}
    first = values.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(x, _around(probs, 0, accuracy), accuracy).alias("q")).first()
    if not first["n"]:
        return [None for _ in probs]
    rank = [max(1, math.ceil(float(p) * first["n"])) for p in probs]
    bounds: dict[int, tuple[float | None, float | None, int, int]] = {i: (None, None, 0, first["n"]) for i in goals}
    guesses = {i: sorted(set(first["q"][3 * i : 3 * i + 3])) for i in goals}
    answers: dict[int, float] = {}
    while True:
        # How many rows of each open range lie below and at the guessed values.
        inside = {i: _between(x, *bounds[i][:2]) for i in guesses}
        counts = [F.count(F.when(inside[i] & test, 1)) for i, vs in guesses.items() for v in vs for test in (x < F.lit(v), x == F.lit(v))]
        got = iter(values.filter(_any(inside.values())).agg(*counts).first())
        for i, vs in guesses.items():
            low, high, below, rows = bounds[i]
            for v, less, at in [(v, below + next(got), next(got)) for v in vs]:
                if less < rank[i] <= less + at:
                    answers[i] = v
                elif less + at < rank[i]:
                    low, rows, below_v = v, rows - (less + at - below), less + at
                    below = below_v
                else:
                    high, rows = v, less - below
                    break
            bounds[i] = low, high, below, rows
        open_ = [i for i in guesses if i not in answers]
        if not open_:
            return [answers[i] for i in range(len(probs))]
        inside = {i: _between(x, *bounds[i][:2]) for i in open_}
        parts = {i: [(rank[i] - bounds[i][2]) / bounds[i][3]] for i in open_}
        sketch = [F.percentile_approx(F.when(inside[i], x), _around(parts[i], bounds[i][3], accuracy), accuracy) for i in open_]
        found = values.filter(_any(inside.values())).agg(*sketch).first()
        guesses = {i: sorted(set(q)) for i, q in zip(open_, found)}


def _around(probs: Sequence[float], rows: int, accuracy: int) -> list[float]:
    """Each probability with one a little before and one after it, wider than the sketch's error; itself where that is exact."""
    wide = 2.0 / accuracy if rows == 0 or rows > accuracy else 0.0
    return [min(1.0, max(0.0, float(p) + d)) for p in probs for d in (-wide, 0.0, wide)]


def _between(x: Column, low: float | None, high: float | None) -> Column:
    inside = F.lit(True)
    if low is not None:
        inside = inside & (x > F.lit(low))
    return inside if high is None else inside & (x < F.lit(high))


def _any(tests) -> Column:
    return reduce(lambda a, b: a | b, tests)


def quantiles(df: DataFrame, column: str, probs: Sequence[float], rel_error: float = QUANTILE_REL_ERROR) -> Column:
    """``percentile_approx`` aggregate expression (an array, one per prob).

    The sketch keeps O(1/rel_error) entries whatever the row count; its rank
    error is at most ``rel_error * rows``, so for ``rel_error`` ≤ 1/rows the
    result is the exact lower quantile (``percentile_disc``). NaN is left out.
    """
    x = F.col(column)
    if dict(df.dtypes)[column] in ("double", "float"):
        x = F.when(~F.isnan(x), x)
    return F.percentile_approx(x, [float(p) for p in probs], _accuracy(rel_error))


def quartiles(df: DataFrame, column: str, rel_error: float = QUANTILE_REL_ERROR) -> DataFrame:
    """One row: ``q1`` and ``q3`` of ``column``. ``rel_error`` > 0 uses the
    ``percentile_approx`` sketch (lazy); 0 computes exact quartiles with
    :func:`exact_quantiles` (eager passes) and returns them as a one-row frame."""
    if rel_error == 0:
        q1, q3 = exact_quantiles(df, column, [0.25, 0.75])
        return df.sparkSession.range(1).select(F.lit(q1).cast("double").alias("q1"),
                                               F.lit(q3).cast("double").alias("q3"))
    q = quantiles(df, column, [0.25, 0.75], rel_error)
    return df.agg(q.alias("q")).select(F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3"))


def quartile_bounds(
    df: DataFrame, column: str, factor: float = IQR_FACTOR, rel_error: float = QUANTILE_REL_ERROR
) -> DataFrame:
    """One row, one struct column ``bounds`` = (lower, upper) of the IQR rule."""
    q = quartiles(df, column, rel_error)
    iqr = F.col("q3") - F.col("q1")
    return q.select(
        F.struct(
            (F.col("q1") - F.lit(factor) * iqr).alias("lower"),
            (F.col("q3") + F.lit(factor) * iqr).alias("upper"),
        ).alias("bounds")
    )


def null_counts(df: DataFrame, table: str | None = None) -> DataFrame:
    """Nulls per column in one pass: ``(table_name, column_name, nulls)``.

    One global aggregate of ``count(*) - count(c)`` per column (NaN in floating
    columns also counts), unpivoted to long form.
    """
    exprs = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        miss = is_missing(c, isinstance(f.dataType, (T.DoubleType, T.FloatType)))
        exprs.append(F.sum(F.when(miss, 1).otherwise(0)).cast("bigint").alias(f.name))
    wide = df.agg(*exprs)
    long = wide.unpivot([], [F.col(f"`{c}`") for c in wide.columns], "column_name", "nulls")
    return long.select(F.lit(table).cast("string").alias("table_name"), "column_name", "nulls")


def best_per_group(
    df: DataFrame,
    group: Sequence[str],
    score: str,
    tie_break: str,
    payload: Sequence[str] = (),
) -> DataFrame:
    """Per group the row with the highest ``score``; ties → smallest ``tie_break``."""
    return _extreme_per_group(df, group, F.max(score), score, F.min(tie_break), tie_break, payload)


def latest_per_group(
    df: DataFrame,
    group: Sequence[str],
    time_col: str,
    tie_break: str,
    payload: Sequence[str] = (),
    where: Column | None = None,
) -> DataFrame:
    """Per group the most recent row (latest ``time_col``; ties → largest
    ``tie_break``), optionally among rows matching ``where``."""
    src = df.filter(where) if where is not None else df
    return _extreme_per_group(src, group, F.max(time_col), time_col, F.max(tie_break), tie_break, payload)


def _extreme_per_group(df: DataFrame, group: Sequence[str], top: Column, key: str, tie: Column, tie_break: str, payload: Sequence[str]) -> DataFrame:
    """Per group the extreme of ``key``, then of ``tie_break`` among its rows.

    Both are plain hash aggregates with a map-side step, so a group holding a
    third of the rows arrives as one row a task; the join between them keeps
    the rows at the extreme only. Rows equal in both give one row.
    """
    best = df.groupBy(*group).agg(top.alias("_top")).withColumnsRenamed({g: f"_g_{g}" for g in group})
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group])
    at_top = df.join(best, same & F.col(key).eqNullSafe(F.col("_top")))
    if not payload:
        out = at_top.groupBy(*group, key).agg(tie.alias(tie_break))
        return out.select(*group, key, tie_break)
    first = at_top.groupBy(*group).agg(tie.alias("_tie")).withColumnsRenamed({g: f"_f_{g}" for g in group})
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_f_{g}")) for g in group])
    rows = at_top.join(first, same & F.col(tie_break).eqNullSafe(F.col("_tie")))
    return rows.select(*group, key, tie_break, *payload).dropDuplicates([*group])


def next_versions(requests: DataFrame, registry: DataFrame, name: str, version: str = "version") -> DataFrame:
    """For each requested name: ``coalesce(max(version), 0) + 1`` over the registry."""
    cur = registry.groupBy(name).agg(F.max(version).alias("_v"))
    out = requests.select(name).join(cur, on=name, how="left")
    return out.select(name, (F.coalesce(F.col("_v"), F.lit(0)) + 1).cast("bigint").alias("next_version"))
