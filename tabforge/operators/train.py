"""Grid search with k-fold cross-validation over several classifiers, and
selection of the best one.

Fits and evaluations are Spark ML jobs over the distributed frame; only the
model objects and a handful of metric values live on the driver.
"""

from __future__ import annotations

import threading
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import StringIndexer
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.config import LABEL_COLUMN, TUNING
from tabforge.config.defaults import CV_FOLDS
from tabforge.operators.features import slot_names
from tabforge.operators.metrics import weighted_metrics
from tabforge.operators.nested import shared_fits, staged_scores

#: Names a row's fold while the models are fitted.
FOLD = "_fold"
#: A fit's jobs have a task for so many rows at least: few rows are spread over the fits that run at once, not over the tasks of each.
TASK_ROWS = 20_000
#: A task for each core is enough as long as it has no more rows than these: every task of a tree's pass sends its own
#: histograms of all nodes, so that more tasks than cores only add to what is scheduled and shuffled.
MOST_TASK_ROWS = 1_000_000
#: A regression is a chain of many short passes, and scoring a fold is one: a task takes so many rows before there is another
#: one, as several fits run at once anyway and a pass over fewer rows costs less than sending its task.
CHAIN_TASK_ROWS = 250_000
#: Forests draw rows, and every tree the rows that its split bounds come from (beyond 10,000 rows), by partition: other
#: partitions would give other models, so theirs are left.
DRAWS_ROWS = ("DecisionTreeClassifier", "RandomForestClassifier", "GBTClassifier")

ESTIMATORS = {
    "DecisionTreeClassifier": DecisionTreeClassifier,
    "RandomForestClassifier": RandomForestClassifier,
    "LogisticRegression": LogisticRegression,
    "GBTClassifier": GBTClassifier,
}


def make_estimator(name: str, features_col: str = "features", label_col: str = LABEL_COLUMN, seed: int = 42):
    """A classifier by class name, reading ``features_col`` and ``label_col``."""
    est = ESTIMATORS[name](featuresCol=features_col, labelCol=label_col)
    if est.hasParam("seed"):
        est = est.setSeed(seed)
    if name == "RandomForestClassifier":
        est = est.setCacheNodeIds(True)  # the same trees: a pass goes on from each row's node instead of from every root
    return est


def param_grid(estimator, tuning: dict = TUNING) -> list:
    """Grid of the estimator's configured hyper-parameters (one empty map if none)."""
    grid = ParamGridBuilder()
    for param, values in tuning.get("hyperparameters", {}).get(type(estimator).__name__, {}).items():
        grid = grid.addGrid(estimator.getParam(param), values)
    return grid.build()


@dataclass
class TrainResult:
    """Outcome of :func:`train_select`."""

    best_name: str
    best_model: PipelineModel
    metrics: dict[str, float]
    params: dict[str, object]
    importances: list[tuple[str, float]] | None
    results: list[dict] = field(default_factory=list)
    #: (algorithm, grid point, its parameters, fold, F1 on the fold) of every point and fold.
    grid: list[tuple[str, int, str, int, float]] = field(default_factory=list)

    def grid_frame(self, spark: SparkSession) -> DataFrame:
        """The score of every grid point in every fold."""
        return spark.createDataFrame(self.grid, "algorithm string, point int, params string, fold int, f1 double")

    def results_frame(self, spark: SparkSession) -> DataFrame:
        """Per algorithm: in-sample and cross-validated metrics, and the pick."""
        rows = [(r["order"], r["algorithm"], r["f1"], r["weighted_precision"], r["weighted_recall"],
                 r["cv_f1"], r["algorithm"] == self.best_name) for r in self.results]
        return spark.createDataFrame(rows, "order int, algorithm string, f1 double, weighted_precision double, "
                                           "weighted_recall double, cv_f1 double, selected boolean")

    def importances_frame(self, spark: SparkSession) -> DataFrame:
        """``(feature, importance, rank)``; empty for models without importances."""
        rows = [(n, float(v), i + 1) for i, (n, v) in enumerate(self.importances or [])]
        return spark.createDataFrame(rows, "feature string, importance double, rank int")


def feature_importances(model: PipelineModel, transformed: DataFrame, features_col: str = "features"):
    """(slot name, importance) sorted by falling importance, name on ties; None
    when the last stage has no importances (logistic regression)."""
    last = model.stages[-1] if hasattr(model, "stages") else model
    if not hasattr(last, "featureImportances"):
        return None
    values = last.featureImportances.toArray()
    names = slot_names(transformed, features_col)
    pairs = [(names[i] if i < len(names) else f"slot_{i}", float(v)) for i, v in enumerate(values)]
    return sorted(pairs, key=lambda p: (-p[1], p[0]))


def _for_fold(stages: list) -> list:
    """The feature stages as a fold fits them: rows with a category that its training part lacks are left out of its score."""
    out = []
    for stage in stages:
        stage = stage.copy()
        if isinstance(stage, StringIndexer) and stage.getHandleInvalid() == "error":
            stage = stage.setHandleInvalid("skip")
        out.append(stage)
    return out


class _Folds:
    """The features of each fold's training and validation rows: made when first asked for, given back after its last fit."""

    def __init__(self, data: DataFrame, stages: list, columns: list[str], uses: int):
        self.data, self.stages, self.columns = data, stages, columns
        self.uses, self.locks, self.frames = {}, {}, {}
        self.most, self.guard = uses, threading.Lock()

    def frame(self, k: int) -> tuple[DataFrame, DataFrame] | None:
        """The fold's frames, kept in memory and on disk; None if no row is in it."""
        with self.guard:
            lock = self.locks.setdefault(k, threading.Lock())
        with lock:
            if k not in self.frames:
                features = Pipeline(stages=_for_fold(self.stages)).fit(self.data.where(F.col(FOLD) != k))
                sides = [features.transform(self.data.where(side)).select(*self.columns).persist(StorageLevel.MEMORY_AND_DISK) for side in (F.col(FOLD) != k, F.col(FOLD) == k)]
                self.frames[k] = None if sides[1].isEmpty() else tuple(sides)
            return self.frames[k]

    def done(self, k: int) -> None:
        with self.guard:
            self.uses[k] = self.uses.get(k, 0) + 1
            over = self.uses[k] == self.most and self.frames.get(k)
        for side in over or ():
            side.unpersist()


def fit_tasks(rows: int, cores: int) -> int:
    """How many tasks a fit's jobs have over ``rows``: by ``TASK_ROWS`` up to one for each core, then by ``MOST_TASK_ROWS``."""
    return max(min(1 + rows // TASK_ROWS, cores), 1 + rows // MOST_TASK_ROWS)


def chain_tasks(rows: int, cores: int) -> int:
    """How many of them a fit has that draws no rows at random: by ``CHAIN_TASK_ROWS``."""
    return min(fit_tasks(rows, cores), 1 + rows // CHAIN_TASK_ROWS)


def train_select(
    df: DataFrame,
    stages: list,
    tuning: dict = TUNING,
    label_col: str = LABEL_COLUMN,
    features_col: str = "features",
    folds: int = CV_FOLDS,
    seed: int = 42,
    parallelism: int = 8,
    select_by: str = "in_sample",
) -> TrainResult:
    """Cross-validated grid search per classifier, then the best classifier.

    The whole pipeline is fitted anew in every fold, on the fold's training part
    only. The feature stages do not depend on the grid, so a fold fits them once
    and all classifiers and grid points share its features; the models are those
    that a pipeline refitted for each grid point gives. A row's fold is a hash of
    its values, so all classifiers see the same folds however the rows are
    partitioned. Grid points whose models are part of a larger one (fewer
    boosting iterations, shallower trees) are read off one fit
    (:mod:`tabforge.operators.nested`) and score as separate fits do.
    ``parallelism`` fits run at once, fold after fold and the longest first, so
    that a fold's last fits overlap with the next one's. Boosted fits, whose
    trees wait for each other, start a fold ahead.

    The best grid point is refit on all rows, once the classifier's own points
    are scored, and scored on them (in-sample
    weighted F1, precision, recall, as the source does); ``select_by='cv'``
    ranks by the mean cross-validated F1 instead. Highest score wins, the
    earlier classifier on ties.
    """
    names = list(tuning["classification_models"])
    if not names:
        raise ValueError("no classifier configured")
    fold = F.pmod(F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in df.columns]), F.lit(folds))
    rows, cores = df.count(), df.sparkSession.sparkContext.defaultParallelism
    data = df.withColumn(FOLD, fold).coalesce(fit_tasks(rows, cores)).persist(StorageLevel.MEMORY_AND_DISK)
    spread = lambda name, part: part if name in DRAWS_ROWS else part.coalesce(chain_tasks(rows, cores))
    estimators = {n: make_estimator(n, features_col, label_col, seed) for n in names}
    grids = {n: param_grid(estimators[n], tuning) for n in names}
    points = [(n, i, p) for n in names for i, p in enumerate(grids[n])]
    fits = sorted((f for n in names for f in shared_fits(n, grids[n])), key=lambda f: -f.cost())
    scores: dict[tuple[str, int], dict[int, float]] = {(n, i): {} for n, i, _ in points}
    shared = _Folds(data, stages, [features_col, label_col], len(fits))

    def score_fit(job) -> None:
        k, fit = job
        try:
            sides = shared.frame(k)
            if sides is not None:
                model = estimators[fit.algorithm].fit(spread(fit.algorithm, sides[0]), fit.params)
                for i, f1 in zip(fit.points, staged_scores(model, sides[1].coalesce(chain_tasks(rows, cores)), label_col, fit.stages)):
                    scores[fit.algorithm, i][k] = f1
        finally:
            shared.done(k)

    def refit(a: tuple[int, str]) -> dict:
        order, name = a
        for scored in scoring[name]:
            scored.result()
        own = [(sum(scores[n, i][k] for k in sorted(scores[n, i])) / max(1, len(scores[n, i])), -i, p) for n, i, p in points if n == name]
        cv_f1, _, best = max(own, key=lambda x: x[:2])  # the earlier grid point on ties
        fitted = estimators[name].fit(spread(name, whole), best)
        m = weighted_metrics(fitted.transform(whole), label_col).first()
        return {"order": order, "algorithm": name, "f1": m["f1"], "weighted_precision": m["weighted_precision"],
                "weighted_recall": m["weighted_recall"], "cv_f1": float(cv_f1), "_model": PipelineModel(stages=[*features.stages, fitted])}

    jobs = sorted(((k, f) for k in range(folds) for f in fits), key=lambda job: job[0] - (job[1].algorithm == "GBTClassifier"))
    scoring: dict[str, list[Future]] = {n: [] for n in names}
    held = [data]
    try:
        features = Pipeline(stages=list(stages)).fit(data)
        whole = features.transform(data).persist(StorageLevel.MEMORY_AND_DISK)
        held.append(whole)
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool, ThreadPoolExecutor(max_workers=len(names)) as last:
            for k, fit in jobs:
                scoring[fit.algorithm].append(pool.submit(score_fit, (k, fit)))
            runs = list(last.map(refit, enumerate(names)))
        best = max(runs, key=lambda r: (r["cv_f1"] if select_by == "cv" else r["f1"], -r["order"]))
        importances = feature_importances(best["_model"], whole, features_col)
    finally:
        for frame in held:
            frame.unpersist()
    model = best["_model"]
    params = {p.name: v for p, v in model.stages[-1].extractParamMap().items()}
    metrics = {"f1": best["f1"], "precision": best["weighted_precision"], "recall": best["weighted_recall"]}
    results = [{k: v for k, v in r.items() if not k.startswith("_")} for r in runs]
    spelt = lambda p: ",".join(f"{k.name}={v}" for k, v in sorted(p.items(), key=lambda x: x[0].name))
    grid = [(n, i, spelt(p), k, float(f1)) for n, i, p in points for k, f1 in sorted(scores[n, i].items())]
    return TrainResult(best["algorithm"], model, metrics, params, importances, results, grid)
