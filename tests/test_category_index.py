"""Category indexes as tables, held against the collected ones."""

import pytest
from pyspark.sql import functions as F

from tabforge.operators.category_index import category_index, indexed, load_category_index
from tabforge.operators.features import alpha_desc_indexer, freq_indexer

VALUES = ["b", "a", "b", "ü", "", "a", "c", " ", "Z", "b"]


@pytest.fixture()
def frame(spark):
    return spark.createDataFrame([(i, v, "x") for i, v in enumerate(VALUES)], "id int, category string, index string").repartition(3)


@pytest.mark.parametrize("order, stage", [("frequency_desc", freq_indexer), ("alphabet_desc", alpha_desc_indexer)])
def test_same_as_the_collected_index(spark, frame, order, stage):
    want = {(r.id, r.category_index) for r in stage("category").fit(frame).transform(frame).collect()}
    got = indexed(frame, "category", category_index(frame, "category", order))
    assert got.columns == ["id", "category", "index", "category_index"]
    assert {(r.id, r.category_index) for r in got.collect()} == want


def test_many_categories_over_many_ranges(spark):
    n = 50_000
    df = spark.range(n).select((F.col("id") * 7919 % n).cast("string").alias("c")).union(spark.range(30_000).select(F.lit("77").alias("c")))
    rows = category_index(df, "c").collect()
    assert sorted(r["index"] for r in rows) == [float(i) for i in range(n)]
    want = ["77"] + sorted(str(i) for i in range(n) if i != 77)
    assert [r["category"] for r in sorted(rows, key=lambda r: r["index"])] == want


def test_nulls_unseen_and_empty(spark, frame, tmp_path):
    path = str(tmp_path / "index")
    category_index(frame, "category", path=path)
    index = load_category_index(spark, path)
    new = spark.createDataFrame([(1, "a"), (2, None), (3, "new")], "id int, category string")
    assert {r.id: r.category_index for r in indexed(new, "category", index, handle_invalid="keep").collect()} == {1: 1.0, 2: 7.0, 3: 7.0}
    assert [r.id for r in indexed(new, "category", index, handle_invalid="skip").collect()] == [1]
    for bad in (2, 3):
        with pytest.raises(Exception, match="no index for"):
            indexed(new.where(F.col("id") == bad), "category", index).collect()
    with pytest.raises(ValueError):
        indexed(new, "category", index, output="id")
    assert category_index(new.where("id > 9"), "category").count() == 0


def test_no_category_is_collected(spark, frame):
    plan = category_index(frame, "category")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
