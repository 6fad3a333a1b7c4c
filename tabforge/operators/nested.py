"""Grid points that one fit answers: smaller models that are part of a larger one.

* A boosted ensemble's first 10 trees are the ensemble of 10 iterations: every
  tree depends on the ones before it only.
* A deep decision tree cut off at depth 5 is the tree of depth 5: a node's split
  depends on its own rows only, and a cut node predicts its own majority.

A forest's trees draw rows and features from one stream of random numbers, which
depends on their number and depth, and regularised regressions share nothing:
those points are fitted one by one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import SparkContext
from pyspark.ml.classification import DecisionTreeClassificationModel, GBTClassificationModel
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.session import join_path, scratch_path

#: The parameter along which an estimator's models are nested.
NESTED = {"DecisionTreeClassifier": "maxDepth", "GBTClassifier": "maxIter"}


@dataclass
class SharedFit:
    """One fit, with ``params``, that answers the grid points ``points`` as its stages ``stages`` (None: as it is)."""

    algorithm: str
    params: dict
    points: list[int]
    stages: list[int] | None

    def cost(self) -> float:
        """A rough order of how long the fit takes, so that long ones start first."""
        size = {p.name: v for p, v in self.params.items()}
        return {"GBTClassifier": 10}.get(self.algorithm, 1) * size.get("maxIter", 1) * size.get("maxDepth", 1)


def shared_fits(algorithm: str, grid: list[dict]) -> list[SharedFit]:
    """The fits that answer all points of ``grid``: the largest of every nested family, and each other point on its own."""
    along = NESTED.get(algorithm)
    families: dict[tuple, list[tuple[int, dict]]] = {}
    for i, point in enumerate(grid):
        named = {p.name: v for p, v in point.items()}
        nested = along is not None and along in named
        rest = tuple(sorted((k, repr(v)) for k, v in named.items() if k != along)) if nested else ("point", i)
        families.setdefault(rest, []).append((i, point))
    out = []
    for family in families.values():
        size = lambda point: next((v for p, v in point.items() if p.name == along), None)
        if len(family) == 1:
            out.append(SharedFit(algorithm, family[0][1], [family[0][0]], None))
        else:
            largest = max(family, key=lambda x: size(x[1]))[1]
            out.append(SharedFit(algorithm, largest, [i for i, _ in family], [size(p) for _, p in family]))
    return out


def first_trees(model: GBTClassificationModel, count: int) -> GBTClassificationModel:
    """The model of the first ``count`` boosting iterations."""
    gateway = SparkContext._active_spark_context._gateway
    own = model._java_obj.trees()
    count = min(count, len(own))
    trees = gateway.new_array(gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, count)
    weights = gateway.new_array(gateway.jvm.double, count)
    for i, weight in enumerate(model.treeWeights[:count]):
        trees[i], weights[i] = own[i], float(weight)
    return GBTClassificationModel(JavaWrapper._new_java_obj("org.apache.spark.ml.classification.GBTClassificationModel", f"{model.uid}_{count}", trees, weights))


def depth_predictions(model: DecisionTreeClassificationModel, spark, depths: list[int]) -> DataFrame:
    """(leaf, p0, p1, ...): what the tree cut off at each of ``depths`` predicts for the rows of each leaf.

    Leaves are numbered from left to right, as the model's leaf column does. The
    nodes are read from the saved model; a tree has as many as the driver holds
    anyway.
    """
    path = join_path(scratch_path(spark, "nested"), "tree")
    model.write().save(path)
    nodes = {r["id"]: r for r in spark.read.parquet(join_path(path, "data")).select("id", "prediction", "leftChild", "rightChild").collect()}
    rows, waiting = [], [(0, [])]
    while waiting:
        at, above = waiting.pop()
        node = nodes[at]
        way = [*above, float(node["prediction"])]
        if node["leftChild"] < 0:
            rows.append((float(len(rows)), *(way[min(d, len(way) - 1)] for d in depths)))
        else:
            waiting += [(node["rightChild"], way), (node["leftChild"], way)]
    return spark.createDataFrame(rows, ", ".join(["leaf double", *(f"p{j} double" for j in range(len(depths)))]))


def staged_predictions(model, rows: DataFrame, label: str, stages: list[int] | None) -> DataFrame:
    """(label, p0, p1, ...): the label of every row and what each stage of ``model`` predicts for it."""
    if stages is None:
        return model.transform(rows).select(F.col(label), F.col("prediction").alias("p0"))
    if isinstance(model, DecisionTreeClassificationModel):
        leaves = depth_predictions(model, rows.sparkSession, stages)
        found = model.copy().setLeafCol("leaf").transform(rows).select(F.col(label), "leaf")
        return found.join(F.broadcast(leaves), "leaf").select(label, *(f"p{j}" for j in range(len(stages))))
    out = rows
    for j, count in enumerate(stages):
        part = first_trees(model, count).setFeaturesCol(model.getFeaturesCol()).setPredictionCol(f"p{j}").setRawPredictionCol("").setProbabilityCol("")
        out = part.transform(out)
    return out.select(label, *(f"p{j}" for j in range(len(stages))))


def weighted_f1(pairs: dict[tuple[float, float], int]) -> float:
    """F1 weighted by the labels' shares, from counts of (label, prediction)."""
    total, f1 = sum(pairs.values()), 0.0
    for k in sorted({y for y, _ in pairs}):
        hits = pairs.get((k, k), 0)
        labelled = sum(n for (y, _), n in pairs.items() if y == k)
        predicted = sum(n for (_, p), n in pairs.items() if p == k)
        if hits:
            precision, recall = hits / predicted, hits / labelled
            f1 += 2 * precision * recall / (precision + recall) * labelled / total
    return f1


def staged_scores(model, rows: DataFrame, label: str, stages: list[int] | None) -> list[float]:
    """The weighted F1 of every stage of ``model`` on ``rows``, from one aggregate over them."""
    many = len(stages or [0])
    told = staged_predictions(model, rows, label, stages)
    pairs = told.select(F.col(label).cast("double").alias("y"), F.posexplode(F.array(*(f"p{j}" for j in range(many)))).alias("stage", "p"))
    counts: list[dict] = [{} for _ in range(many)]
    for r in pairs.groupBy("stage", "y", "p").agg(F.count(F.lit(1)).alias("n")).collect():  # stages x classes x classes rows
        counts[r["stage"]][r["y"], r["p"]] = r["n"]
    return [weighted_f1(c) for c in counts]
