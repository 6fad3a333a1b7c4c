"""Grid points read off one larger fit score as fits of their own do."""

import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from tabforge.config import TUNING
from tabforge.operators.metrics import f1_evaluator
from tabforge.operators.nested import shared_fits, staged_predictions, staged_scores, weighted_f1
from tabforge.operators.train import make_estimator, param_grid, train_select

SMALL = {
    "classification_models": ["DecisionTreeClassifier", "RandomForestClassifier", "LogisticRegression", "GBTClassifier"],
    "hyperparameters": {
        "DecisionTreeClassifier": {"maxDepth": [2, 4, 9], "minInstancesPerNode": [1, 4]},
        "RandomForestClassifier": {"numTrees": [2], "maxDepth": [2, 3]},
        "LogisticRegression": {"regParam": [0.01, 1.0]},
        "GBTClassifier": {"maxIter": [1, 3, 6], "maxDepth": [2, 3]},
    },
}


@pytest.fixture(scope="module")
def noisy(spark):
    """Rows whose label depends on two features and chance, so that deep trees overfit."""
    rng = random.Random(11)
    rows = []
    for i in range(400):
        x, y, c = rng.random(), rng.randint(0, 6), rng.choice("abc")
        label = float((x + 0.1 * y + (c == "a") * 0.3 + rng.gauss(0, 0.35)) > 0.75)
        rows.append((i, x, float(y), c, label))
    return spark.createDataFrame(rows, "id long, x double, y double, c string, response double").repartition(3).cache()


@pytest.fixture(scope="module")
def sides(noisy):
    stages = [StringIndexer(inputCol="c", outputCol="ci"), VectorAssembler(inputCols=["x", "y", "ci"], outputCol="features")]
    ready = Pipeline(stages=stages).fit(noisy).transform(noisy).select("id", "features", "response")
    return ready.where("id % 4 > 0").cache(), ready.where("id % 4 = 0").cache()


@pytest.mark.parametrize("name", SMALL["classification_models"])
def test_every_point_scores_as_its_own_fit(sides, name):
    train, valid = sides
    estimator = make_estimator(name)
    grid = param_grid(estimator, SMALL)
    fits = shared_fits(name, grid)
    assert sorted(i for f in fits for i in f.points) == list(range(len(grid)))
    assert len(fits) == {"DecisionTreeClassifier": 2, "GBTClassifier": 2}.get(name, len(grid))
    evaluator, different = f1_evaluator("response"), set()
    for fit in fits:
        model = estimator.fit(train, fit.params)
        scores = staged_scores(model, valid, "response", fit.stages)
        told = staged_predictions(model, valid, "response", fit.stages)
        for j, i in enumerate(fit.points):
            alone = estimator.fit(train, grid[i]).transform(valid)
            assert scores[j] == pytest.approx(evaluator.evaluate(alone), abs=1e-12)
            assert [(r[0], r[1], r[2]) for r in told.groupBy("response", f"p{j}").count().orderBy("response", f"p{j}").collect()] == [
                tuple(r) for r in alone.groupBy("response", "prediction").count().orderBy("response", "prediction").collect()]
            different.add(scores[j])
    assert len(different) > 1


def test_default_grid_needs_twenty_four_fits():
    fits = [f for n in TUNING["classification_models"] for f in shared_fits(n, fake_grid(TUNING["hyperparameters"][n]))]
    assert len(fits) == 3 + 9 + 9 + 3 and sum(len(f.points) for f in fits) == 36


def fake_grid(params):
    import itertools
    from collections import namedtuple

    name = namedtuple("name", "name")
    return [{name(k): v for k, v in zip(params, values)} for values in itertools.product(*params.values())]


def test_search_reports_every_point_and_fold_and_agrees_with_separate_fits(spark, noisy):
    stages = [StringIndexer(inputCol="c", outputCol="ci", handleInvalid="skip"), VectorAssembler(inputCols=["x", "y", "ci"], outputCol="features")]
    frame = noisy.drop("id")
    found = train_select(frame, stages, SMALL, folds=2)
    rows = found.grid_frame(spark).collect()
    assert len(rows) == 2 * sum(len(param_grid(make_estimator(n), SMALL)) for n in SMALL["classification_models"])
    fold = F.pmod(F.xxhash64(F.lit(42), *[F.col(f"`{c}`") for c in frame.columns]), F.lit(2))
    evaluator = f1_evaluator("response")
    for k in (0, 1):
        features = Pipeline(stages=stages).fit(frame.where(fold != k))
        train, valid = (features.transform(frame.where(s)).select("features", "response").cache() for s in (fold != k, fold == k))
        for name in ("DecisionTreeClassifier", "GBTClassifier"):
            estimator = make_estimator(name)
            grid = param_grid(estimator, SMALL)
            got = {r.point: r.f1 for r in rows if r.algorithm == name and r.fold == k}
            for i in (0, len(grid) - 1):
                alone = estimator.fit(train, grid[i]).transform(valid)
                assert got[i] == pytest.approx(evaluator.evaluate(alone), abs=1e-12)
    means = {}
    for r in rows:
        means.setdefault((r.algorithm, r.point), []).append(r.f1)
    best = {n: max(sum(v) / len(v) for (a, _), v in means.items() if a == n) for n in SMALL["classification_models"]}
    assert {r["algorithm"]: r["cv_f1"] for r in found.results} == pytest.approx(best)


def test_weighted_f1_of_counts():
    assert weighted_f1({(0.0, 0.0): 3, (0.0, 1.0): 1, (1.0, 1.0): 2, (1.0, 0.0): 2}) == pytest.approx((4 * (2 * 0.6 * 0.75 / 1.35) + 4 * (2 * (2 / 3) * 0.5 / (7 / 6))) / 8)
    assert weighted_f1({(1.0, 0.0): 2}) == 0.0
