"""Exact quantiles on awkward values, and the agreement of the sketch with them."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tabforge.operators.aggregates import exact_quantiles, quartiles
from tabforge.operators.filters import iqr_trim
from tabforge.session import scratch_path

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def by_hand(values, p):
    kept = sorted(v for v in values if v is not None and not math.isnan(v))
    return kept[max(1, math.ceil(p * len(kept))) - 1] if kept else None


def cases():
    r = random.Random(1)
    inf = float("inf")
    yield "uniform", [r.random() for _ in range(3000)]
    yield "heavy tail", [10.0 ** r.uniform(-300, 300) * r.choice((-1, 1)) for _ in range(3000)]
    yield "infinities", [r.random() for _ in range(500)] + [inf] * 200 + [-inf] * 130
    yield "one infinity", [float(i) for i in range(500)] + [inf]
    yield "ties at the rank", [1.0] * 400 + [2.0] * 400 + [3.0] * 800
    yield "ties and a few between", [1.0] * 500 + [1.0 + i / 1e3 for i in range(9)] + [2.0] * 500
    yield "nan and null", [float(i) for i in range(20)] + [math.nan] * 30 + [None] * 7
    yield "one value", [5.0]
    yield "none", [None, math.nan]


@pytest.mark.parametrize(("name", "values"), list(cases()), ids=[n for n, _ in cases()])
@pytest.mark.parametrize("accuracy", [50, 10_000])
def test_exact_quantiles(spark, name, values, accuracy):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    assert exact_quantiles(df, "v", PROBS, accuracy=accuracy) == [by_hand(values, p) for p in PROBS]


def test_sketch_and_exact_leave_nan_out(spark):
    df = spark.createDataFrame([(float(i),) for i in range(20)] + [(math.nan,)] * 30, "v double")
    assert iqr_trim(df, ["v"]).count() == iqr_trim(df, ["v"], rel_error=0.0).count() == 20
    assert quartiles(df, "v", rel_error=0.001).first() == quartiles(df, "v", rel_error=0.0).first()


def test_narrowed_passes_push_the_range_to_the_reader(spark):
    path = scratch_path(spark, "quantile-test")
    spark.range(5000).select((F.col("id") * 1.5).alias("v")).write.parquet(path)
    df = spark.read.parquet(path).filter((F.col("v") > 10.0) & (F.col("v") < 20.0))
    plan = df.agg(F.count("v"))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(v,10.0)" in plan
    assert exact_quantiles(spark.read.parquet(path), "v", [0.25, 0.75], accuracy=20) == [1249 * 1.5, 3749 * 1.5]
