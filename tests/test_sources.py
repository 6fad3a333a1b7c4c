"""Scans and configs: dataset name, URI mapping, JSON configs, records."""

import json

import pytest
from pyspark.sql import functions as F

from tabforge.config import COLUMN_TYPES, TABLE_SCHEMAS
from tabforge.sources import (
    dataset_name,
    declared_constraints,
    load_json_config,
    read_text_table,
    records_frame,
    table_struct,
    to_hadoop_uri,
    typed_struct,
)


def test_uri_mapping():
    assert to_hadoop_uri("s3://b/k.parquet") == "s3a://b/k.parquet"
    assert to_hadoop_uri("/local/x") == "/local/x"


def test_dataset_name_from_files(spark, tmp_path):
    for name in ["clinic_a.csv", "clinic.b.csv"]:
        (tmp_path / name).write_text("id\n1\n2\n")
    df = read_text_table(spark, str(tmp_path / "*.csv"))
    names = {r.ds: r.n for r in df.groupBy(dataset_name().alias("ds")).agg(F.count(F.lit(1)).alias("n")).collect()}
    assert names == {"clinic_a": 2, "clinic.b": 2}


def test_json_configs(tmp_path):
    p = tmp_path / "types.json"
    p.write_text(json.dumps(COLUMN_TYPES))
    assert load_json_config(str(p)) == COLUMN_TYPES
    wide = typed_struct(COLUMN_TYPES)
    assert len(wide.fields) == 49
    assert wide["patient_id"].dataType.simpleString() == "bigint"
    assert wide["dob"].dataType.simpleString() == "timestamp_ntz"
    ml = table_struct("ml_ready")
    assert [f.name for f in ml.fields] == list(TABLE_SCHEMAS["ml_ready"])
    slots = declared_constraints()
    assert len(slots) == 82
    assert sum(s["primary_key"] for s in slots) == 8
    assert {s["max_length"] for s in slots if s["max_length"]} == {10, 50, 255, 1000}


def test_records_frame(spark):
    df = records_frame(spark, [{"age": 40.0, "gender": "M"}, {"gender": "F"}], "age double, gender string")
    assert [tuple(r) for r in df.collect()] == [(40.0, "M"), (None, "F")]


def test_columns_go_by_name_across_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("patient_id,age\n1,50\n")
    (tmp_path / "b.csv").write_text("age,patient_id,extra\n60,2,x\n")
    df = read_text_table(spark, str(tmp_path / "*.csv"))
    assert sorted((r.patient_id, r.age, r.extra) for r in df.collect()) == [("1", "50", None), ("2", "60", "x")]
    picked = read_text_table(spark, str(tmp_path / "*.csv"), header=["age", "patient_id"])
    assert sorted(map(tuple, picked.collect())) == [("50", "1"), ("60", "2")]
    with pytest.raises(ValueError, match="nothere"):
        read_text_table(spark, str(tmp_path / "*.csv"), header=["nothere"])


@pytest.mark.parametrize("row", ["3,60,EXTRA", "3"])
def test_rows_that_do_not_fit_fail_or_are_kept(spark, tmp_path, row):
    (tmp_path / "a.csv").write_text(f"id,age\n1,50\n{row}\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_text_table(spark, str(tmp_path / "a.csv")).collect()
    kept = read_text_table(spark, str(tmp_path / "a.csv"), bad_rows="keep").collect()
    assert [r._corrupt_record for r in kept] == [None, row]


def test_records_reach_the_scoring_input(spark):
    from tabforge.operators.score import scoring_input

    records = [{"age": "40", "gender": "M"}, {"age": "NaN", "gender": "F"}, {"age": "1d", "gender": "F"}, {"gender": None}]
    got = scoring_input(records_frame(spark, records, "age string, gender string"), ["age"], ["gender"]).collect()
    assert [(r.age, r.input_error) for r in got] == [(40.0, None), (None, "age"), (None, "age"), (None, "age,gender")]


def test_headers_of_ten_thousand_files_in_one_job(spark, tmp_path):
    for i in range(10_000):
        name = f"part {i:05d}+%2B.csv" if i % 1000 == 0 else f"part{i:05d}.csv"
        text = f"id,age\n{i},{i % 90}\n" if i % 3 else f"\nage,id,extra\n{i % 90},{i},x\n"
        (tmp_path / name).write_text(text if i % 500 != 7 else "")
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        df = read_text_table(spark, str(tmp_path / "*.csv"))
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("headers"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 20
    got = df.agg(F.count(F.lit(1)), F.sum(F.col("id").cast("long")), F.sum((F.col("age").cast("long") == F.col("id").cast("long") % 90).cast("int")), F.count("extra")).first()
    kept = [i for i in range(10_000) if i % 500 != 7]
    assert tuple(got) == (len(kept), sum(kept), len(kept), sum(i % 3 == 0 for i in kept))


def test_one_header_needs_no_paths_and_odd_headers_are_read(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"id","a,b"\n1,x\n')
    (tmp_path / "b.csv").write_text('id,"a,b"\n2,y\n')  # spelt otherwise, the same header
    (tmp_path / "c.csv").write_text("")
    df = read_text_table(spark, str(tmp_path))
    assert df.columns == ["id", "a,b"] and sorted(map(tuple, df.collect())) == [("1", "x"), ("2", "y")]
    lines = tmp_path / "lines"
    lines.mkdir()
    (lines / "a.csv").write_text('id,"two\nlines"\n1,x\n')
    (lines / "b.csv").write_text('id,"two\nother"\n2,y\n')
    df = read_text_table(spark, str(lines), options={"multiLine": "true"})
    assert sorted(df.columns) == ["id", "two\nlines", "two\nother"] and df.count() == 2
    with pytest.raises(ValueError, match="no table"):
        read_text_table(spark, str(tmp_path / "c.csv"))


def test_header_of_a_file_of_many_blocks(spark, tmp_path):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    (tmp_path / "big.csv").write_text("id,note\n" + "".join(f"{i},{'n' * 50}\n" for i in range(20_000)))
    (tmp_path / "small.csv").write_text("note,id\nz,-1\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = read_text_table(spark, str(tmp_path))
        assert df.select(F.sum(F.col("id").cast("long")), F.count(F.lit(1))).first() == (sum(range(20_000)) - 1, 20_001)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
