"""The cleaning chain: order of steps and the quirks it keeps."""

import pytest
from pyspark.sql import functions as F

from tabforge.config import COLUMN_TYPES, REQUIRED_COLUMNS
from tabforge.plans.clean import CleanSpec, clean
from tabforge.sources.files import read_text_table

HEADERS = ["Patient ID", "Age", "Gender", "Responder", "MS Type", "Current EDSS", "Current Treat",
           "Report", "WB New", "Lesion New", "DOB", "Unnamed: 11"]
BASE = ["1", "40", "M", "R", "RR", "3.5", "A", "ok", "1,5", "2", "05/01/1980", None]


def frame(spark, rows):
    return spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"`{h}` string" for h in HEADERS))


def row(**over):
    r = list(BASE)
    for k, v in over.items():
        r[int(k[1:])] = v
    return r


def small_spec():
    types = {c: COLUMN_TYPES[c] for c in ["patient_id", "age", "gender", "responder", "ms_type", "current_edss",
                                          "current_treat", "report", "wb_new", "lesion_new", "dob", "response"]}
    return CleanSpec(column_types=types, required=list(REQUIRED_COLUMNS))


def test_clean_types_and_values(spark):
    out = clean(frame(spark, [row()]), small_spec())
    assert out.columns == ["patient_id", "age", "gender", "responder", "ms_type", "current_edss", "current_treat",
                           "report", "wb_new", "lesion_new", "dob", "response"]
    r = out.collect()[0]
    assert r.patient_id == 1 and r.age == 40.0 and r.wb_new == 15.0   # '1,5' → 15 (Q1)
    assert r.response == "yes" and r.dob.month == 5
    assert dict(out.dtypes)["patient_id"] == "bigint" and dict(out.dtypes)["dob"] == "timestamp_ntz"


@pytest.mark.parametrize("over,kept", [
    ({"c0": "x1"}, False),          # id does not parse
    ({"c0": "2.0"}, True),          # id via double
    ({"c0": "1.5"}, False),         # fractional id → null → dropped (Q4)
    ({"c6": "0"}, False),           # sentinel
    ({"c6": "0;"}, True),           # sentinel compared before symbol removal (Q8)
    ({"c6": " 0"}, True),
    ({"c7": "ñ"}, False),           # only non-ASCII → '' → invalid row (Q6)
    ({"c7": "?"}, False),
    ({"c7": " ?"}, True),           # '?' matched exactly (Q7)
    ({"c7": "?;"}, False),          # becomes '?' after symbol removal
    ({"c7": "\t"}, False),
    ({"c2": None}, False),          # required
    ({"c10": None}, True),          # not required
    ({"c10": "?"}, False),          # validity covers every column
])
def test_row_rules(spark, over, kept):
    out = clean(frame(spark, [row(**over)]), small_spec())
    assert (out.count() == 1) is kept


def test_gender_whitelist_and_response(spark):
    out = clean(frame(spark, [row(c2="m", c3="r")]), small_spec()).collect()[0]
    assert out.gender is None and out.response == "no"


def test_header_clash_fails(spark):
    df = spark.createDataFrame([("1", "2")], "`A b` string, `a-b` string")
    with pytest.raises(ValueError, match="normalise"):
        clean(df, small_spec())


def test_text_table_scan(spark, tmp_path):
    p = tmp_path / "sheet.csv"
    p.write_text("Patient ID,,Age,Note\n1,x,NA,\n2,y,n/a, keep \n")
    df = read_text_table(spark, str(p))
    rows = df.collect()
    assert df.columns == ["Patient ID", "_c1", "Age", "Note"]
    assert rows[0]["Age"] is None and rows[0]["Note"] is None
    assert rows[1]["Note"] == " keep "
    out = clean(df, CleanSpec(column_types={"patient_id": "Int64", "age": "float64", "note": "object"},
                              required=["patient_id"], sentinel_column=None, whitelist={}, label_source=None))
    assert out.columns == ["patient_id", "age", "note"]
    assert out.count() == 2


def test_clean_is_one_stage(spark):
    from tabforge.plans import bindings as b

    out = clean(b.dirty_text(spark, "/root/testdata/sf0.001"), b.DIRTY_SPEC)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan            # narrow: no shuffle
    assert "PythonUDF" not in plan and "EvalPython" not in plan
    assert out.count() > 0
