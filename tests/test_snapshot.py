"""Snapshot fan-out: 8 tables, same rows, config order, reports."""

import pytest
from pyspark.sql import functions as F

from tabforge.config import COLUMN_TYPES, TABLE_SCHEMAS
from tabforge.plans.snapshot import constraint_report, snapshot_null_counts, write_snapshot
from tabforge.sources.schema import typed_struct


def wide_rows(spark, n=30):
    schema = typed_struct(COLUMN_TYPES)
    rows = []
    for i in range(n):
        r = {}
        for f in schema.fields:
            t = f.dataType.simpleString()
            r[f.name] = (i if f.name == "patient_id" else
                         float(i) if t == "double" else
                         None if t == "timestamp_ntz" else
                         ("M" if i % 2 else None) if f.name == "gender" else f"v{i}")
        rows.append(tuple(r[f.name] for f in schema.fields))
    return spark.createDataFrame(rows, schema)


def test_write_and_read_back(spark, tmp_path):
    typed = wide_rows(spark)
    paths = write_snapshot(typed, str(tmp_path), "sheet", "2024-01-01_00-00-00")
    assert paths["_dir"].endswith("sheet_ver_2024-01-01_00-00-00")
    assert [t for t in paths if t != "_dir"] == list(TABLE_SCHEMAS)
    for t, schema in TABLE_SCHEMAS.items():
        df = spark.read.parquet(paths[t])
        assert df.columns == list(schema)
        assert df.count() == 30
    ml = spark.read.parquet(paths["ml_ready"])
    assert sorted(r.patient_id for r in ml.collect()) == list(range(30))
    with pytest.raises(Exception):
        write_snapshot(typed, str(tmp_path), "sheet", "2024-01-01_00-00-00")

    nulls = {(r.table_name, r.column_name): r.nulls for r in snapshot_null_counts(spark, paths).collect()}
    assert len(nulls) == sum(len(s) for s in TABLE_SCHEMAS.values())
    assert nulls[("ml_ready", "gender")] == 15 and nulls[("patients", "dob")] == 30
    rep = {(r.table_name, r.column_name, r.check_name): r.violations for r in constraint_report(spark, paths).collect()}
    assert rep[("ml_ready", "gender", "not_null")] == 15
    assert rep[("cognitive", "patient_id", "primary_key")] == 0


def test_missing_column_fails(spark, tmp_path):
    typed = wide_rows(spark).drop("cowat")
    with pytest.raises(ValueError, match="cowat"):
        write_snapshot(typed, str(tmp_path), "sheet", "v1")
