"""Repeated keys against plain counting."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tabforge.operators import keys
from tabforge.operators.keys import candidates, repeated_keys
from tabforge.plans.snapshot import constraint_report, key_violations, write_snapshot


def plain(values):
    return {k: n for k, n in Counter(v for v in values if v is not None).items() if n > 1}


def found(df, column="k"):
    rows = repeated_keys(df, column).collect()
    assert len({r.key for r in rows}) == len(rows)
    return {r.key: r.rows for r in rows}


@pytest.mark.parametrize("parts", [1, 7])
def test_against_counting(spark, parts):
    rnd = random.Random(parts)
    values = [rnd.randrange(4000) for _ in range(3000)] + [2**53 + 1, 2**53 + 2, 2**53 + 2, None, None, -5]
    df = spark.createDataFrame([(v,) for v in values], "k bigint").repartition(parts)
    assert found(df) == plain(values)
    texts = [None if v is None else f"é{v}" for v in values]
    assert found(spark.createDataFrame([(v, 1) for v in texts], "`a.b` string, key int").repartition(parts), "a.b") == plain(texts)


def test_a_key_on_a_third_of_all_rows(spark):
    df = spark.range(300_000, numPartitions=8).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    assert found(df) == {-1: 100_000}


def test_keys_with_equal_prints_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(keys, "fingerprint", lambda df, column: F.when(F.col(column).isNotNull(), F.pmod(F.xxhash64(column), F.lit(5))))
    values = ["a", "b", "c", "d", "e", "f", "g", "a", "b", "b", None]
    assert found(spark.createDataFrame([(v,) for v in values], "k string")) == plain(values)


def test_empty_null_and_floating(spark):
    assert found(spark.createDataFrame([], "k string")) == {}
    assert found(spark.createDataFrame([(None,), (None,)], "k string")) == {}
    assert found(spark.createDataFrame([(0.0,), (-0.0,), (1.5,), (2.5,), (2.5,)], "k double")) == {0.0: 2, 2.5: 2}


def test_batches_of_one_task(spark, monkeypatch):
    monkeypatch.setattr(keys, "BATCH", 10)
    with_batches = spark.range(100, numPartitions=1).select((F.col("id") % 60).alias("print"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert sorted(r.print for r in candidates(with_batches).collect()) == list(range(40))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_no_exchange_of_all_keys(spark):
    plan = candidates(spark.range(1000).select(F.col("id").alias("print")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "hashpartitioning(slice" in plan


def test_report_and_keys_of_a_snapshot(spark, tmp_path):
    schemas = {"t": {"id": "INTEGER NOT NULL PRIMARY KEY", "name": "VARCHAR(2) NULL"}, "u": {"name": "VARCHAR(9)"}}
    types = {"id": "Int64", "name": "object"}
    rows = [(1, "a"), (1, "abc"), (2, None), (None, "x"), (None, "y"), (3, "z"), (1, "q")]
    paths = write_snapshot(spark.createDataFrame(rows, "id bigint, name string"), str(tmp_path), "s", "v", schemas, types)
    assert {(r.table_name, r.column_name, r.key, r.rows) for r in key_violations(spark, paths, schemas).collect()} == {("t", "id", "1", 3), ("t", "id", None, 2)}
    report = {(r.table_name, r.column_name, r.check_name): r.violations for r in constraint_report(spark, paths, schemas).collect()}
    assert report == {("t", "id", "not_null"): 2, ("t", "id", "primary_key"): 4, ("t", "name", "max_length_2"): 1, ("u", "name", "max_length_9"): 0}
