"""Preparation filters, feature stages, training, tracking and scoring."""

import random

import pytest
from pyspark.sql import functions as F

from tabforge.config import TUNING
from tabforge.operators import filters as flt
from tabforge.operators.metrics import evaluate, weighted_metrics
from tabforge.operators.runs import load_latest, log_run, registry
from tabforge.operators.score import score, score_checked, scoring_input
from tabforge.operators.train import train_select
from tabforge.plans import ml_queries
from tabforge.plans.prepare import PrepareSpec, category_report, model_columns, prepare, stages_for
from tabforge.streaming.score import start_scoring_stream

SMALL_GRID = {"classification_models": ["DecisionTreeClassifier", "LogisticRegression"],
              "hyperparameters": {"DecisionTreeClassifier": {"maxDepth": [2, 4]},
                                  "LogisticRegression": {"regParam": [0.01]}}}


@pytest.fixture(scope="module")
def ml_ready(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(240):
        ms = ["RR", "RR", "RR", "APMS", "PPMS", "SPMS"][i % 6] if i < 234 else "PPMS"
        age = rnd.uniform(20, 60) if i % 50 else 500.0          # a few outliers
        edss = rnd.uniform(0, 8)
        lesion = rnd.uniform(0, 10)
        resp = "yes" if edss + rnd.gauss(0, 1) > 4 else "no"
        rows.append((i, age, "M" if i % 3 else "F", ms, lesion, rnd.uniform(1, 2), edss, resp))
    rows.append((999, None, "M", "RR", 1.0, 1.0, 1.0, "no"))       # dropped: null
    rows.append((998, 30.0, "F", "XX", 1.0, 1.0, 1.0, "no"))       # dropped: category
    return spark.createDataFrame(rows, "patient_id bigint, age double, gender string, ms_type string, "
                                       "lesion_new double, wb_new double, current_edss double, response string")


def test_prepare(spark, ml_ready):
    spec = PrepareSpec(rel_error=0.0, materialize="persist")
    out = prepare(ml_ready, spec)
    assert "patient_id" not in out.columns
    assert dict(out.dtypes)["response"] == "int"
    counts = {r.ms_type: r["count"] for r in category_report(out).collect()}
    assert set(counts) <= {"RR", "APMS", "PPMS"}
    assert out.agg(F.max("age")).first()[0] < 500.0


def test_trim_never_widens(spark, ml_ready):
    base = flt.drop_any_null(ml_ready)
    out = flt.iqr_trim(base, ["age", "lesion_new"], rel_error=0.0)
    lo, hi = base.agg(F.min("age"), F.max("age")).first()
    lo2, hi2 = out.agg(F.min("age"), F.max("age")).first()
    assert lo <= lo2 and hi2 <= hi and out.count() <= base.count()


def test_trim_empty_passes(spark):
    empty = spark.createDataFrame([], "x double")
    assert flt.iqr_trim(empty, ["x"]).count() == 0


def test_min_group_size_plan(spark, ml_ready):
    out = flt.min_group_size(ml_ready, "ms_type", 10, max_groups=3)
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
    assert {r.ms_type for r in out.select("ms_type").distinct().collect()} == {"RR", "APMS", "PPMS", "SPMS"} - {
        r.ms_type for r in ml_ready.groupBy("ms_type").count().filter("count <= 10").collect()}


def test_weighted_metrics_match_evaluator(spark):
    rows = [(float(i % 3 == 0), float(i % 4 == 0)) for i in range(100)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    ours = weighted_metrics(df, "label").first()
    ref = evaluate(df, "label")
    assert ours["f1"] == pytest.approx(ref["f1"], abs=1e-12)
    assert ours["weighted_precision"] == pytest.approx(ref["precision"], abs=1e-12)
    assert ours["weighted_recall"] == pytest.approx(ref["recall"], abs=1e-12)


@pytest.fixture(scope="module")
def trained(spark, ml_ready):
    spec = PrepareSpec(rel_error=0.0, materialize="persist")
    ready = prepare(ml_ready, spec)
    res = train_select(ready, stages_for(spec), SMALL_GRID, "response", folds=3, seed=1, parallelism=2)
    return spec, ready, res


def test_train_select(spark, trained):
    spec, ready, res = trained
    assert res.best_name in SMALL_GRID["classification_models"]
    rows = res.results_frame(spark).collect()
    assert len(rows) == 2 and sum(r.selected for r in rows) == 1
    best = max(rows, key=lambda r: (r.f1, -r.order))
    assert best.algorithm == res.best_name
    if res.importances is not None:
        names = [n for n, _ in res.importances]
        assert "age" in names and any(n.startswith("ms_type_vec") for n in names)


def test_same_seed_same_result(spark, trained):
    spec, ready, res = trained
    again = train_select(ready, stages_for(spec), SMALL_GRID, "response", folds=3, seed=1, parallelism=2)
    assert again.best_name == res.best_name and again.metrics == res.metrics


def test_runs_registry_and_scoring(spark, trained, tmp_path):
    spec, ready, res = trained
    root = str(tmp_path / "runs")
    log_run(spark, root, res, "response", model_columns(spec))
    run2 = log_run(spark, root, res, "response", model_columns(spec))
    reg = registry(spark, root).orderBy("version").collect()
    assert [r.version for r in reg] == [1, 2] and reg[1].run_id == run2
    model, feats, target, run_id = load_latest(spark, root)
    assert run_id == run2 and target == "response" and set(feats) == set(model_columns(spec))

    reqs = spark.createDataFrame(
        [(i, str(30.0 + i), "M" if i % 2 else "F", str(float(i % 7)), str(float(i % 5)), "1.5", "RR")
         for i in range(20)] + [(99, "abc", "M", "1", "1", "1", "RR"), (98, "40", "M", "1", "1", "1", "ZZ")],
        "rid int, age string, gender string, current_edss string, lesion_new string, wb_new string, ms_type string")
    typed = scoring_input(reqs, ["age", "current_edss", "lesion_new", "wb_new"], ["gender", "ms_type"])
    batch = {r.rid: (r.response, r.input_error) for r in score_checked(model, typed, keep=["rid"]).collect()}
    assert len(batch) == 22 and batch[99] == (None, "age") and batch[98] == (None, "ms_type")
    assert all(v[0] in ("Yes", "No") for k, v in batch.items() if k not in (98, 99))

    src = str(tmp_path / "req")
    reqs.write.parquet(src)
    q = start_scoring_stream(spark, model, src, reqs.schema, str(tmp_path / "out"), str(tmp_path / "ck"),
                             ["age", "current_edss", "lesion_new", "wb_new"], ["gender", "ms_type"], keep=["rid"])
    q.awaitTermination()
    stream = {r.rid: (r.response, r.input_error) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert stream == batch


def test_versions_are_claimed_once(spark, tmp_path):
    import datetime as dt
    from concurrent.futures import ThreadPoolExecutor

    from tabforge.operators.runs import register_model

    root = str(tmp_path / "reg")
    day = lambda n: dt.datetime(2020, 1, n)
    assert register_model(spark, root, "m", "b", "/b", day(2)) == 1
    assert register_model(spark, root, "m", "a", "/a", day(1)) == 2  # an earlier stamp changes nothing
    assert register_model(spark, root, "other", "c", "/c") == 1
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda i: register_model(spark, root, "m", f"r{i}", "/r"), range(4)))
    assert sorted(got) == [3, 4, 5, 6]
    by = {r.run_id: r.version for r in registry(spark, root).where("name = 'm'").collect()}
    assert by["b"] == 1 and by["a"] == 2 and sorted(by.values()) == [1, 2, 3, 4, 5, 6]


def test_folder_without_data_is_an_error(spark, tmp_path):
    from tabforge.operators.runs import RUNS_SCHEMA, read_table

    assert read_table(spark, str(tmp_path), "runs", RUNS_SCHEMA).count() == 0
    (tmp_path / "runs").mkdir()
    with pytest.raises(Exception, match="(?i)infer"):
        read_table(spark, str(tmp_path), "runs", RUNS_SCHEMA)


def test_folds_do_not_depend_on_partitions(spark, trained):
    spec, ready, res = trained
    dealt = train_select(ready.repartition(7), stages_for(spec), SMALL_GRID, "response", folds=3, seed=1, parallelism=2)
    cv = lambda r: {x["algorithm"]: round(x["cv_f1"], 6) for x in r.results if x["algorithm"] == "LogisticRegression"}
    assert cv(dealt) == cv(res)


@pytest.mark.parametrize("name", ["DecisionTreeClassifier", "RandomForestClassifier", "LogisticRegression", "GBTClassifier"])
def test_every_model_type_survives_saving(spark, trained, tmp_path, name):
    from tabforge.operators.runs import load_model, save_model

    spec, ready, _ = trained
    res = train_select(ready, stages_for(spec), {"classification_models": [name], "hyperparameters": {}}, "response", folds=2, seed=1)
    again = load_model(save_model(res.best_model, str(tmp_path / "m")))
    rows = lambda m: [r.prediction for r in m.transform(ready).select("prediction").collect()]
    assert rows(again) == rows(res.best_model)


def test_every_query_trains_the_whole_search(spark, sf_small, tmp_path, monkeypatch):
    calls = []

    class Trained(Exception):
        pass

    def search(df, stages, tuning, label, folds, seed):
        calls.append((tuning, folds))
        raise Trained

    monkeypatch.setattr(ml_queries, "train_select", search)
    for name in ml_queries.QUERIES:
        with pytest.raises(Trained):
            ml_queries.QUERIES[name](spark, sf_small)
    assert len(calls) == 7 and all(c == (TUNING, 5) for c in calls)


def test_nan_and_infinite_typed_inputs_are_flagged(spark, trained):
    spec, ready, res = trained
    row = ready.first().asDict()
    rows = [row | {spec.numeric[0]: v, "rid": i} for i, v in enumerate([row[spec.numeric[0]], float("nan"), float("inf"), None])]
    df = spark.createDataFrame(rows, ready.withColumn("rid", F.lit(1)).schema)
    got = {r.rid: (r.response is not None, r.input_error) for r in score_checked(res.best_model, df, keep=["rid"]).collect()}
    assert got == {0: (True, None)} | {i: (False, spec.numeric[0]) for i in (1, 2, 3)}


def test_fits_have_no_more_tasks_than_cores():
    from tabforge.operators.train import fit_tasks

    assert [fit_tasks(n, 12) for n in (0, 19_999, 20_000, 155_000)] == [1, 1, 2, 8]  # few rows: as few tasks as before
    assert fit_tasks(930_000, 12) == 12 and fit_tasks(11_999_999, 12) == 12
    assert fit_tasks(100_000_000, 12) == 101  # a task's rows stay bounded


def test_chains_of_short_passes_have_few_tasks():
    from tabforge.operators.train import chain_tasks, fit_tasks

    assert [chain_tasks(n, 12) for n in (0, 19_999, 155_000, 930_000)] == [1, 1, 1, 4]
    assert chain_tasks(100_000_000, 12) == fit_tasks(100_000_000, 12)  # a task's rows stay bounded


def test_fits_that_draw_rows_keep_their_parts_and_every_score_stays(spark, trained, monkeypatch):
    from tabforge.operators import train

    spec, ready, _ = trained
    every = {"classification_models": list(train.ESTIMATORS),
             "hyperparameters": {"DecisionTreeClassifier": {"maxDepth": [2, 4]}, "RandomForestClassifier": {"numTrees": [3], "maxDepth": [3, 9]},
                                 "LogisticRegression": {"regParam": [0.01]}, "GBTClassifier": {"maxIter": [2, 3], "maxDepth": [2]}}}
    frame = ready.repartition(3, "age").cache()
    monkeypatch.setattr(train, "TASK_ROWS", 40)
    parts = {}
    for name, kind in train.ESTIMATORS.items():
        def fit(self, rows, params=None, name=name, plain=kind.fit):
            parts.setdefault(name, set()).add(rows.rdd.getNumPartitions())
            return plain(self, rows, params)

        monkeypatch.setattr(kind, "fit", fit)
    run = lambda: train_select(frame, stages_for(spec), every, "response", folds=2, seed=1)
    few = run()
    own = {min(3, spark.sparkContext.defaultParallelism)}
    assert parts == {n: own if n in train.DRAWS_ROWS else {1} for n in train.ESTIMATORS} and len(train.DRAWS_ROWS) == 3
    monkeypatch.setattr(train, "CHAIN_TASK_ROWS", 1)
    monkeypatch.setattr(train, "make_estimator", lambda *a, plain=train.make_estimator: plain(*a).setCacheNodeIds(False) if a[0] == "RandomForestClassifier" else plain(*a))
    many = run()
    assert train.chain_tasks(240, 8) > 1 and few.best_name == many.best_name
    assert [r[:4] for r in few.grid] == [r[:4] for r in many.grid] and [r[4] for r in few.grid] == pytest.approx([r[4] for r in many.grid], abs=1e-9)
    frame.unpersist()


@pytest.mark.parametrize("name", ["train_rule_select", "score_rule", "run_log", "stream_model_swap"])
def test_texts_are_measured_once(spark, sf_small, monkeypatch, name):
    frames, measured = [], []

    class Trained(Exception):
        pass

    def search(df, *_, **__):
        frames.append(df)
        raise Trained

    def measures(*a, plain=ml_queries.b.measured_docs):
        measured.append(a)
        return plain(*a)

    monkeypatch.setattr(ml_queries, "train_select", search)
    monkeypatch.setattr(ml_queries.b, "measured_docs", measures)
    with pytest.raises(Trained):
        (ml_queries.QUERIES | ml_queries.TRACKING_QUERIES)[name](spark, sf_small)
    assert len(measured) == 1 and not [f for f in frames[0].inputFiles() if "documents.parquet" in f]


@pytest.mark.parametrize("name", ["save_load_score", "stream_score", "score_rule", "stream_rule"])
def test_requests_come_from_the_measures_of_training(spark, sf_small, monkeypatch, name):
    measured, scored = [], []
    monkeypatch.setattr(ml_queries.b, "measured_docs", lambda *a, plain=ml_queries.b.measured_docs: measured.append(a) or plain(*a))
    monkeypatch.setattr(ml_queries, "train_select", lambda *_, **__: None)
    monkeypatch.setattr(ml_queries, "log_run", lambda *_, **__: "run")
    monkeypatch.setattr(ml_queries, "load_latest", lambda *_: (None, [], "response", "run"))

    class Scored(Exception):
        pass

    def take(*args, **__):
        scored.append(args)
        raise Scored

    monkeypatch.setattr(ml_queries, "score_checked", take)
    monkeypatch.setattr(ml_queries, "start_scoring_stream", take)
    with pytest.raises(Scored):
        ml_queries.QUERIES[name](spark, sf_small)
    assert len(measured) == 1 and len(scored) == 1
