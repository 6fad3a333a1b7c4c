"""Registered training, tracking and scoring queries over ``documents`` ⋈
``labels`` (rows-only checks: they fit models, so they have no SQL twin)."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.config import TUNING
from tabforge.operators.run_log import read_table
from tabforge.operators.runs import TABLES, compact_runs, load_latest, log_run
from tabforge.operators.score import score_checked, scoring_input
from tabforge.operators.train import train_select
from tabforge.plans import bindings as b
from tabforge.plans.prepare import model_columns, prepare, stages_for
from tabforge.session import join_path, scratch_path
from tabforge.streaming.score import start_scoring_stream, start_swapping_stream

QUERIES: dict = {}

SEED = 42
FOLDS = 5


def _ready(spark: SparkSession, sf_dir: str, spec=b.DOC_PREPARE, measures: DataFrame | None = None) -> DataFrame:
    return prepare(b.doc_frame(spark, sf_dir, b.measured_docs(spark, sf_dir) if measures is None else measures), spec)


def _train(ready: DataFrame, spec):
    """The whole search, as every query here runs it: four classifiers, their grids, all folds."""
    return train_select(ready, stages_for(spec), TUNING, "response", folds=FOLDS, seed=SEED)


def train_select_best(spark, sf_dir):
    """All four classifiers × their 3×3 grids × 5 folds; one row per
    classifier with in-sample and cross-validated F1, and the pick."""
    res = _train(_ready(spark, sf_dir), b.DOC_PREPARE)
    return res.results_frame(spark)


def feature_importance(spark, sf_dir):
    """Slot importances of the best of the four, by falling importance; no rows if it has none (logistic regression)."""
    res = _train(_ready(spark, sf_dir), b.DOC_PREPARE)
    return res.importances_frame(spark)


# Scoring reads categories that may be absent from training ('es'): keep them.
SCORING_SPEC = replace(b.DOC_PREPARE, handle_invalid="keep")
NUMERIC = ["n_chars", "n_words", "n_lines"]
TEXT = ["source", "lang"]


def _train_and_log(spark, sf_dir, root, measures=None):
    res = _train(_ready(spark, sf_dir, SCORING_SPEC, measures), SCORING_SPEC)
    return log_run(spark, root, res, "response", model_columns(SCORING_SPEC))


def _requests(spark, sf_dir, measures: DataFrame | None = None) -> DataFrame:
    """Every document as a scoring request with text-typed fields."""
    m = b.measured_docs(spark, sf_dir) if measures is None else measures
    return m.select("doc_id", *[F.col(c).cast("string").alias(c) for c in NUMERIC], *TEXT)


def load_and_score(spark, sf_dir, root, measures=None):
    """Load the latest run's model below ``root`` and score all documents (one row per document)."""
    model, _feats, _target, _run = load_latest(spark, root)
    return score_checked(model, scoring_input(_requests(spark, sf_dir, measures), NUMERIC, TEXT), keep=["doc_id"])


def load_and_stream(spark, sf_dir, root, measures=None):
    """Requests written as files, scored by a Structured Streaming query into
    a Parquet sink; returns the sink (one row per request)."""
    model, _f, _t, _r = load_latest(spark, root)
    work = scratch_path(spark, "streams")
    src, reqs = join_path(work, "requests"), _requests(spark, sf_dir, measures)
    reqs.write.parquet(src)
    q = start_scoring_stream(spark, model, src, reqs.schema, join_path(work, "scored"),
                             join_path(work, "checkpoint"), NUMERIC, TEXT, keep=["doc_id"])
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(join_path(work, "scored"))


def trained_root(spark, sf_dir, measures=None):
    """A runs folder with the best of the four trained models, logged."""
    root = scratch_path(spark, "runs")
    _train_and_log(spark, sf_dir, root, measures)
    return root


def save_load_score(spark, sf_dir):
    """Train, save and register; load the latest run's model back; score all documents."""
    measures = b.measured_docs(spark, sf_dir)
    return load_and_score(spark, sf_dir, trained_root(spark, sf_dir, measures), measures)


def stream_score(spark, sf_dir):
    """Train, save and register; load the model back; score a stream of all documents."""
    measures = b.measured_docs(spark, sf_dir)
    return load_and_stream(spark, sf_dir, trained_root(spark, sf_dir, measures), measures)


# A label that is an exact rule of a category, so that what is learnt is known: text in English is accepted.
RULE_SPEC = replace(b.DOC_PREPARE, min_count=0, outlier_columns=[])


def _rule_frame(spark, sf_dir, measures: DataFrame | None = None) -> DataFrame:
    frame = b.doc_frame(spark, sf_dir, b.measured_docs(spark, sf_dir) if measures is None else measures)
    return frame.withColumn("response", F.when(F.col("lang") == "en", "yes").otherwise("no"))


def train_rule_select(spark, sf_dir):
    """All four classifiers on the rule: the first that learns it exactly is picked, and its top feature is the rule's."""
    res = _train(prepare(_rule_frame(spark, sf_dir), RULE_SPEC), RULE_SPEC)
    metrics = res.results_frame(spark).where("selected").select("algorithm", *[F.round(c, 9).alias(c) for c in ("f1", "weighted_precision", "weighted_recall", "cv_f1")])
    top = res.importances_frame(spark).where("rank = 1").select(F.regexp_extract("feature", "^(lang)", 1).alias("top_feature"), F.round("importance", 9).alias("importance"))
    return metrics.join(F.broadcast(top))  # one row each


def _poisoned(spark, sf_dir, measures: DataFrame | None = None) -> DataFrame:
    """Requests of which some hold what is no number or an unseen category."""
    k = F.col("doc_id")
    bad = F.when(k % 11 == 0, "NaN").when(k % 13 == 0, "inf").when(k % 17 == 0, "1d").when(k % 19 == 0, "").when(k % 23 == 0, F.lit(None))
    broken = (k % 11 == 0) | (k % 13 == 0) | (k % 17 == 0) | (k % 19 == 0) | (k % 23 == 0)
    return _requests(spark, sf_dir, measures).withColumn("n_chars", F.when(broken, bad).otherwise(F.col("n_chars"))).withColumn(
        "lang", F.when(k % 29 == 0, "xx").otherwise(F.col("lang"))).withColumn("source", F.lit("src0"))


def _rule_model(spark, sf_dir, root, measures):
    res = _train(prepare(_rule_frame(spark, sf_dir, measures), RULE_SPEC), RULE_SPEC)
    log_run(spark, root, res, "response", model_columns(RULE_SPEC))
    return load_latest(spark, root)[0]


def score_rule(spark, sf_dir):
    """Train on the rule, save, load the latest run, score poisoned requests of every document."""
    measures = b.measured_docs(spark, sf_dir)
    model = _rule_model(spark, sf_dir, scratch_path(spark, "runs"), measures)
    return score_checked(model, scoring_input(_poisoned(spark, sf_dir, measures), NUMERIC, TEXT), keep=["doc_id"])


def stream_rule(spark, sf_dir):
    """The same requests as files, scored by a stream in several batches."""
    root = scratch_path(spark, "streams")
    measures = b.measured_docs(spark, sf_dir)
    model = _rule_model(spark, sf_dir, join_path(root, "runs"), measures)
    requests = _poisoned(spark, sf_dir, measures)
    requests.repartition(3).write.parquet(join_path(root, "requests"))
    q = start_scoring_stream(spark, model, join_path(root, "requests"), requests.schema, join_path(root, "scored"),
                             join_path(root, "checkpoint"), NUMERIC, TEXT, keep=["doc_id"], max_files_per_trigger=1)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(join_path(root, "scored"))


def stream_model_swap(spark, sf_dir):
    """A stream over two logged runs, stopped and started again between them.

    The first run learns that English is accepted, the second that German is.
    Requests of even ``doc_id`` come before the second run is logged, the others
    after it; each is scored once, by the run that was the latest then. The
    search is that of one classifier (all its grid, all folds): which model
    serves a batch is the matter here, not which one wins.
    """
    root = scratch_path(spark, "streams")
    tree = {"classification_models": ["DecisionTreeClassifier"], "hyperparameters": TUNING["hyperparameters"]}
    measures = b.measured_docs(spark, sf_dir)
    requests = _poisoned(spark, sf_dir, measures)
    frame = b.doc_frame(spark, sf_dir, measures)
    for parity, accepted in ((0, "en"), (1, "de")):
        ruled = frame.withColumn("response", F.when(F.col("lang") == accepted, "yes").otherwise("no"))
        res = train_select(prepare(ruled, RULE_SPEC), stages_for(RULE_SPEC), tree, "response", folds=FOLDS, seed=SEED)
        log_run(spark, join_path(root, "runs"), res, "response", model_columns(RULE_SPEC))
        requests.where(F.pmod("doc_id", F.lit(2)) == parity).repartition(2).write.mode("append").parquet(join_path(root, "requests"))
        q = start_swapping_stream(spark, join_path(root, "runs"), join_path(root, "requests"), requests.schema, join_path(root, "scored"),
                                  join_path(root, "checkpoint"), NUMERIC, TEXT, keep=["doc_id"], max_files_per_trigger=1)
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return spark.read.parquet(join_path(root, "scored")).select("doc_id", "input_error", "response", "model_name", "model_version")


STUMP = {"classification_models": ["DecisionTreeClassifier"], "hyperparameters": {"DecisionTreeClassifier": {"maxDepth": [0]}}}
LOGGED_RULES = (2, 3, 5)


def run_log(spark, sf_dir):
    """What three runs left in the run tables, read after a compaction between them.

    Run k learns by a tree without a split whether ``doc_id`` divides by k, so it
    predicts the commoner answer and its metrics follow from counts. The run of
    2 is logged, then 3, the tables are compacted, 3 is logged again (it replaces
    its rows) and 5 is logged; one row for each parameter, metric and importance.
    """
    root = scratch_path(spark, "runs")
    frame = b.doc_frame(spark, sf_dir, b.measured_docs(spark, sf_dir))
    for k in LOGGED_RULES:
        ruled = frame.withColumn("response", F.when(F.col("doc_id") % k == 0, "yes").otherwise("no"))
        res = train_select(prepare(ruled, RULE_SPEC), stages_for(RULE_SPEC), STUMP, "response", folds=2, seed=SEED)
        log = lambda: log_run(spark, root, res, "response", model_columns(RULE_SPEC), run_id=f"run{k}")  # noqa: B023, E731
        log()
        if k == 3:
            compact_runs(spark, root, keep_seconds=0)
            log()
    read = lambda name: read_table(spark, root, name, TABLES[name])
    shown = ["best_algorithm", "target_column", "feature_columns", "best_maxDepth", "best_impurity"]
    rows = [
        read("runs").select("run_id", F.lit("run").alias("kind"), F.lit("algorithm").alias("name"), F.col("algorithm").alias("text"), F.lit(None).cast("double").alias("number")),
        read("run_params").where(F.col("param").isin(shown)).select("run_id", F.lit("param"), "param", "value", F.lit(None).cast("double")),
        read("run_metrics").select("run_id", F.lit("metric"), "metric", F.lit(None).cast("string"), F.round("value", 9)),
        read("run_importances").groupBy("run_id").agg(F.count(F.lit(1)).cast("double").alias("slots"))
                               .select("run_id", F.lit("importance"), F.lit("slots"), F.lit(None).cast("string"), "slots"),
        read("model_registry").select("run_id", F.lit("version"), "name", F.lit(None).cast("string"), F.col("version").cast("double")),
    ]
    return reduce(DataFrame.union, rows)


def _run_log_sql() -> str:
    per_run = "\nUNION ALL ".join(
        f"SELECT 'run{k}' AS run_id, {n}::DOUBLE AS version, count(*) AS n, greatest(count(*) FILTER (WHERE doc_id % {k} = 0), count(*) FILTER (WHERE doc_id % {k} <> 0)) AS m, "
        "4 + count(DISTINCT lang) AS slots FROM f"  # three numbers, the index of source, a slot for each lang
        for n, k in enumerate(LOGGED_RULES, 1))
    texts = [("run", "algorithm", "DecisionTreeClassifier"), ("param", "best_algorithm", "DecisionTreeClassifier"), ("param", "target_column", "response"),
             ("param", "feature_columns", ",".join(model_columns(RULE_SPEC))), ("param", "best_maxDepth", "0"), ("param", "best_impurity", "gini")]
    numbers = [("metric", "best_F1", "p * 2 * p / (1 + p)"), ("metric", "best_Precision", "p * p"), ("metric", "best_Recall", "p"),
               ("importance", "slots", "slots"), ("version", "Best_response_model_DecisionTreeClassifier", "version")]
    parts = [f"SELECT run_id, '{kind}' AS kind, '{name}' AS name, '{text}' AS text, NULL::DOUBLE AS number FROM r" for kind, name, text in texts]
    parts += [f"SELECT run_id, '{kind}', '{name}', NULL, round(({value})::DOUBLE, 9) FROM r" for kind, name, value in numbers]
    return f"""WITH f AS (SELECT d.doc_id, d.lang FROM documents d JOIN labels l ON d.doc_id = l.doc_id
           WHERE d.lang IN ('en', 'de', 'fr') AND d.source IS NOT NULL AND d.text IS NOT NULL AND d.n_chars IS NOT NULL),
c AS ({per_run}),
r AS (SELECT *, m::DOUBLE / n AS p FROM c)
""" + "\nUNION ALL ".join(parts)


_RULE_SCORES = """
WITH r AS (SELECT doc_id, CASE WHEN doc_id % 29 = 0 THEN 'xx' ELSE lang END AS lang,
                  doc_id % 11 = 0 OR doc_id % 13 = 0 OR doc_id % 17 = 0 OR doc_id % 19 = 0 OR doc_id % 23 = 0 AS bad FROM documents),
e AS (SELECT *, concat_ws(',', CASE WHEN bad THEN 'n_chars' END, CASE WHEN lang NOT IN ('en', 'de', 'fr') THEN 'lang' END) AS err FROM r)
SELECT doc_id, nullif(err, '') AS input_error, CASE WHEN err = '' THEN CASE WHEN lang = 'en' THEN 'Yes' ELSE 'No' END END AS response FROM e"""

ORACLE_SQL = {
    "run_log": _run_log_sql(),
    "train_rule_select": """SELECT 'DecisionTreeClassifier' AS algorithm, 1.0::DOUBLE AS f1, 1.0::DOUBLE AS weighted_precision, 1.0::DOUBLE AS weighted_recall, 1.0::DOUBLE AS cv_f1,
       'lang' AS top_feature, 1.0::DOUBLE AS importance FROM documents WHERE lang = 'en' GROUP BY lang""",
    "score_rule": _RULE_SCORES,
    "stream_rule": _RULE_SCORES,
    "stream_model_swap": _RULE_SCORES.replace("SELECT doc_id, nullif", "SELECT doc_id, 1 + doc_id % 2 AS model_version, 'Best_response_model_DecisionTreeClassifier' AS model_name, nullif")
                                     .replace("WHEN lang = 'en' THEN", "WHEN lang = CASE WHEN doc_id % 2 = 0 THEN 'en' ELSE 'de' END THEN"),
}

QUERIES.update({
    "train_rule_select": train_rule_select,
    "score_rule": score_rule,
    "stream_rule": stream_rule,
    "train_select_best": train_select_best,
    "feature_importance": feature_importance,
    "save_load_score": save_load_score,
    "stream_score": stream_score,
})
# Queries about what is logged and served: a search of one classifier gives them their runs.
TRACKING_QUERIES = {"run_log": run_log, "stream_model_swap": stream_model_swap}
