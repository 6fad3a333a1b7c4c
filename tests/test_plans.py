"""Plan checks: pushdown, pruning, bounded broadcasts, no Python in data paths."""

from tabforge.operators import filters as flt
from tabforge.plans import bindings as b
from tabforge.plans.prepare import prepare


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_allowed_values_pushed(spark, sf_small):
    ev = spark.read.parquet(f"{sf_small}/events.parquet")
    p = plan(flt.allowed_values(ev, "event_type", ["click", "view"]))
    assert "PushedFilters: [In(event_type" in p or "PushedFilters: [IsNotNull(event_type), In(event_type" in p


def test_iqr_bounds_pushed_and_pruned(spark, sf_small):
    ev = spark.read.parquet(f"{sf_small}/events.parquet").select("event_id", "value")
    p = plan(flt.iqr_trim(ev, ["value"], rel_error=0.0))
    assert "GreaterThanOrEqual(value" in p and "LessThanOrEqual(value" in p
    assert "ReadSchema: struct<event_id:bigint,value:double>" in p


def test_bounded_group_filter_broadcasts(spark, sf_small):
    ev = spark.read.parquet(f"{sf_small}/events.parquet")
    kept = flt.min_group_size(flt.allowed_values(ev, "event_type", ["click", "view"]), "event_type", 10, max_groups=2)
    kept.count()
    p = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in p and "LeftSemi" in p


def test_prepare_has_no_python(spark, sf_small):
    df = prepare(b.doc_frame(spark, sf_small), b.DOC_PREPARE)
    p = plan(df)
    assert "EvalPython" not in p and "PythonUDF" not in p


def test_text_measures_read_only_needed_columns(spark, sf_small):
    p = plan(b.doc_frame(spark, sf_small))
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string,source:string,n_chars:bigint>" in p
    assert "ReadSchema: struct<doc_id:bigint,quality:int>" in p
