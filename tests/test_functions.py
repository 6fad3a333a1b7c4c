"""Unit tables for the scalar functions (input → expected)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tabforge import functions as fn
from tabforge.operators.columns import normalize_name

from tests.conftest import one_col


def apply(spark, values, expr_fn, dtype="string"):
    df = one_col(spark, values, dtype)
    return [r[0] for r in df.select(expr_fn(F.col("c"))).collect()]


@pytest.mark.parametrize("raw,expected", [
    ("B. Annual lesion vol change (IB)", "b_annual_lesion_vol_change_ib"),
    ("new Shrink-ing", "new_shrink_ing"),
    ("Café %", "caf"),
    ("  Patient ID ", "patient_id"),
    ("__x__y__", "x_y"),
])
def test_normalize_name(raw, expected):
    assert normalize_name(raw) == expected


def test_ascii_fold_and_symbols(spark):
    assert apply(spark, ["çab", "plain", None], fn.ascii_fold) == ["ab", "plain", None]
    assert apply(spark, ["a;b,@c", "1,5", None], fn.strip_symbols) == ["abc", "15", None]


def test_cell_validity(spark):
    vals = [None, "?", " ", "\t", "\x1c", " ?", "ok", "?;", "\n\r"]
    assert apply(spark, vals, fn.cell_is_valid) == [True, False, False, False, False, True, True, True, False]


def test_safe_double(spark):
    vals = [" 12 ", "1e3", ".5", "1d", "1_000", "0x10", "True", "1e400", "-.5e-2", None, "1."]
    assert apply(spark, vals, fn.safe_double) == [12.0, 1000.0, 0.5, None, None, None, None, None, -0.005, None, 1.0]


def test_safe_long(spark):
    vals = ["2.0", "-5", "+4", "1e3", " 7 ", "1.5", "x", "inf", "1e300", None]
    assert apply(spark, vals, fn.safe_long) == [2, -5, 4, 1000, 7, None, None, None, None, None]


def test_safe_timestamp(spark):
    vals = ["2020-01-05", "20200105", "05/01/2020", "13/01/2020", "43835", "2020-13-01", "x",
            "2020-01-05 10:11:12", "Jan 5 2020", None]
    d = dt.datetime
    assert apply(spark, vals, fn.safe_timestamp) == [
        d(2020, 1, 5), d(2020, 1, 5), d(2020, 5, 1), d(2020, 1, 13), None, None, None,
        d(2020, 1, 5, 10, 11, 12), d(2020, 1, 5), None]


def test_safe_long_is_exact_beyond_doubles(spark):
    vals = ["9007199254740993", "9007199254740992", "-9223372036854775808", "9223372036854775807", "9223372036854775808", " +123456789012345678 ", "007"]
    assert apply(spark, vals, fn.safe_long) == [9007199254740993, 9007199254740992, -2**63, 2**63 - 1, None, 123456789012345678, 7]


DAY = dt.datetime(2020, 1, 5)
LAYOUTS = {
    "2020-01-05 10:11": DAY.replace(hour=10, minute=11), "2020-01-05T10:11:12": DAY.replace(hour=10, minute=11, second=12),
    "2020-01-05 10:11:12.5": DAY.replace(hour=10, minute=11, second=12, microsecond=500_000), "2020/01/05": DAY, "2020-1-5": DAY,
    "05-01-2020": dt.datetime(2020, 5, 1), "5 Jan 2020": DAY, "5-Jan-2020": DAY, "January 5 2020": DAY, "Jan-2020": dt.datetime(2020, 1, 1),
    "1/5/2020 10:00": DAY.replace(hour=10), "01/05/20": DAY, "01/05/99": dt.datetime(1999, 1, 5), "  2020-01-05\t": DAY, "sept 5, 2020": dt.datetime(2020, 9, 5),
    "2018-11-04": dt.datetime(2018, 11, 4), "2020-03-29 02:30:00": dt.datetime(2020, 3, 29, 2, 30), "1/5.2020": None, "2020-02-30": None, "25:00": None, "Janx 5 2020": None,
}


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Europe/Berlin"])
def test_timestamps_in_every_layout_and_zone(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert apply(spark, list(LAYOUTS), fn.safe_timestamp) == list(LAYOUTS.values())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_safe_boolean_and_string(spark):
    assert apply(spark, ["TRUE", "yes", "1", "R", "no", None], fn.safe_boolean) == [True, True, True, False, False, None]
    assert apply(spark, [1, None], fn.safe_string, "int") == ["1", None]


def test_response_and_whitelist(spark):
    m = lambda c: fn.map_with_default(c, {"R": "yes"}, "no")
    assert apply(spark, ["R", "r", "NR", None], m) == ["yes", "no", "no", "no"]
    w = lambda c: fn.whitelist(c, ["M", "F"])
    assert apply(spark, ["M", "F", "m", "X", None], w) == ["M", "F", None, None, None]


def test_label_encode_decode(spark):
    assert apply(spark, ["yes", "YES", "no", "No", "maybe", None], fn.encode_label) == [1, 1, 0, 0, None, None]
    assert apply(spark, [1.0, 0.0, 2.0, None], fn.decode_label, "double") == ["Yes", "No", "No", "No"]


def test_na_tokens(spark):
    vals = ["", "NA", "n/a", "NULL", "None", "nan", "#N/A", "<NA>", "na", "0", "x"]
    assert apply(spark, vals, fn.na_to_null) == [None] * 8 + ["na", "0", "x"]


def test_gender_index_alpha_desc(spark):
    from tabforge.operators.features import alpha_desc_indexer

    df = one_col(spark, ["M", "F", "F", "M", "M"], name="gender")
    out = alpha_desc_indexer("gender").fit(df).transform(df).collect()
    assert {(r.gender, r.gender_index) for r in out} == {("M", 0.0), ("F", 1.0)}


def test_no_python_udf_in_functions(spark):
    df = one_col(spark, ["1,5"])
    plan = df.select(fn.safe_double(fn.strip_symbols(fn.ascii_fold("c"))),
                     fn.safe_timestamp("c"), fn.cell_is_valid("c"))._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
