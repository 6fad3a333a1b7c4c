"""Run tracking as Parquet tables, model save / load and the model registry.

Layout below a root folder (normally in the cluster's shared folder):

``runs``            run_id, start_time, algorithm, target, features, artifact, model_path
``run_params``      run_id, param, value
``run_metrics``     run_id, metric, value
``run_importances`` run_id, feature, importance, rank
``model_registry``  name, version, registered_at, run_id, model_path
``model_versions/name=<name>/tickets``   one empty file for every version that was claimed
``model_versions/name=<name>/entering``  one for every caller who is about to claim one
``models/<run_id>/<artifact>``  the saved ``PipelineModel``

A run's rows are a folder ``entry=<id>`` of each table; tables hold a few rows per run.
:func:`compact_runs` merges the folders of many runs (:mod:`tabforge.operators.run_log`).
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.config import LABEL_COLUMN, MODEL_ARTIFACT
from tabforge.operators.aggregates import latest_per_group
from tabforge.operators.run_log import compact_table, read_table
from tabforge.operators.train import TrainResult
from tabforge.session import join_path

RUNS_SCHEMA = ("run_id string, start_time timestamp_ntz, algorithm string, target string, "
               "features string, artifact string, model_path string")
PARAMS_SCHEMA = "run_id string, param string, value string"
METRICS_SCHEMA = "run_id string, metric string, value double"
IMPORTANCES_SCHEMA = "run_id string, feature string, importance double, rank int"
REGISTRY_SCHEMA = "name string, version bigint, registered_at timestamp_ntz, run_id string, model_path string"
TABLES = {"runs": RUNS_SCHEMA, "run_params": PARAMS_SCHEMA, "run_metrics": METRICS_SCHEMA, "run_importances": IMPORTANCES_SCHEMA,
          "model_registry": REGISTRY_SCHEMA}


def _append(df: DataFrame, root: str, name: str, entry: str) -> None:
    """Rows of one run as a folder of its own, so that runs may write at the same time."""
    df.coalesce(1).write.mode("overwrite").parquet(join_path(root, name, f"entry={entry}"))


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def log_run(
    spark: SparkSession,
    root: str,
    result: TrainResult,
    target: str = LABEL_COLUMN,
    features: Sequence[str] = (),
    artifact: str = MODEL_ARTIFACT,
    start_time: dt.datetime | None = None,
    run_id: str | None = None,
) -> str:
    """Save the best model and append its run, parameter, metric, importance
    and registry rows. Returns the run id. ``start_time`` (UTC) is when the run
    began, before its training; the latest run is the one that began last.
    Logging a ``run_id`` again replaces what it wrote and keeps its version."""
    run_id = run_id or uuid.uuid4().hex
    start = start_time or utc_now()
    model_path = save_model(result.best_model, join_path(root, "models", run_id, artifact))
    run = spark.createDataFrame(
        [(run_id, start, result.best_name, target, ",".join(features), artifact, model_path)], RUNS_SCHEMA)
    params = [("best_algorithm", result.best_name), ("target_column", target),
              ("feature_columns", ",".join(features))]
    params += [(f"best_{k}", str(v)) for k, v in sorted(result.params.items())]
    metrics = [(f"best_{k.capitalize() if k != 'f1' else 'F1'}", float(v)) for k, v in result.metrics.items()]
    imps = [(run_id, n, float(v), i + 1) for i, (n, v) in enumerate(result.importances or [])]
    tables = {
        "run_params": spark.createDataFrame([(run_id, k, v) for k, v in params], PARAMS_SCHEMA),
        "run_metrics": spark.createDataFrame([(run_id, k, v) for k, v in metrics], METRICS_SCHEMA),
        "run_importances": spark.createDataFrame(imps, IMPORTANCES_SCHEMA),
    }
    for name, df in tables.items():
        _append(df, root, name, run_id)
    name = f"{artifact}_{result.best_name}"
    if registry(spark, root).where((F.col("name") == name) & (F.col("run_id") == run_id)).isEmpty():
        register_model(spark, root, name, run_id, model_path)
    # The run row goes last: a run is visible only once everything it names exists.
    _append(run, root, "runs", run_id)
    return run_id


def registry(spark: SparkSession, root: str) -> DataFrame:
    """The model registry: ``(name, version, registered_at, run_id, model_path)``."""
    return read_table(spark, root, "model_registry", REGISTRY_SCHEMA).select("name", "version", "registered_at", "run_id", "model_path")


class _Folder:
    """Empty files below a folder: create one under a name of its own, delete one, list them.

    No more is asked of the file system than that a listing shows what was
    written before it: neither an atomic create nor a rename, which object
    stores lack.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.hadoop, self.path = spark._jvm.org.apache.hadoop.fs, path
        self.files = self.hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        self.files.mkdirs(self.hadoop.Path(path))

    def create(self, name: str) -> None:
        self.files.create(self.hadoop.Path(join_path(self.path, name)), True).close()

    def delete(self, name: str) -> None:
        self.files.delete(self.hadoop.Path(join_path(self.path, name)), False)

    def names(self) -> set[str]:
        return {f.getPath().getName() for f in self.files.listStatus(self.hadoop.Path(self.path)) if f.isFile()}


def claim_version(tickets, entering, patience: float = 60.0, pause: float = 0.05) -> int:
    """The next version of a name, a different one for each caller and without gaps.

    A caller marks its entrance, takes a ticket numbered above all it can see
    (two may take the same number; their random names decide) and removes the
    mark. Whoever was still entering then may get a lower ticket and is waited
    for; whoever enters later gets a higher one. So the tickets below its own
    are final, and their number plus one is the version (Lamport's bakery).

    A caller that dies between its two files leaves its mark, as its ticket may
    yet appear: others then stop after ``patience`` seconds with an error that
    names the mark, which may be deleted once its writer is known to be gone.
    """
    own = uuid.uuid4().hex
    entering.create(own)
    number = max((int(t.split("-")[0]) for t in tickets.names()), default=0) + 1
    ticket = f"{number:012d}-{own}"
    tickets.create(ticket)
    entering.delete(own)
    waiting, until = entering.names(), time.monotonic() + patience
    while waiting := waiting & entering.names():
        if time.monotonic() > until:
            raise TimeoutError(f"callers still entering: {sorted(waiting)} in {entering.path}")
        time.sleep(pause)
    return sum(t <= ticket for t in tickets.names())


def register_model(spark: SparkSession, root: str, name: str, run_id: str, model_path: str,
                   registered_at: dt.datetime | None = None) -> int:
    """Append a registration of ``name``; returns its version.

    Versions count up from 1 in the order of their claims; once claimed a
    version never changes, whatever its time stamp and whoever registers at the
    same moment (``claim_version``). A run that dies between its claim and its
    row leaves its version unused.
    """
    at = join_path(root, "model_versions", f"name={name}")
    older = max((int(n) for n in _Folder(spark, at).names() if n.isdigit()), default=0)  # claims of the layout before tickets
    version = older + claim_version(_Folder(spark, join_path(at, "tickets")), _Folder(spark, join_path(at, "entering")))
    row = spark.createDataFrame([(name, version, registered_at or utc_now(), run_id, model_path)], REGISTRY_SCHEMA)
    _append(row, root, "model_registry", uuid.uuid4().hex)
    return version


def latest_run(runs: DataFrame, artifact: str = MODEL_ARTIFACT) -> DataFrame:
    """The most recent run that saved ``artifact`` (one row or none)."""
    return latest_per_group(runs.withColumn("_all", F.lit(0)), ["_all"], "start_time", "run_id",
                            payload=["algorithm", "target", "features", "model_path"],
                            where=F.col("artifact") == artifact).drop("_all")


def load_latest(spark: SparkSession, root: str, artifact: str = MODEL_ARTIFACT):
    """(model, feature columns, target, run id) of the latest run with ``artifact``."""
    row = latest_run(read_table(spark, root, "runs", RUNS_SCHEMA), artifact).first()
    if row is None:
        raise FileNotFoundError(f"no run saved a model named {artifact!r} under {root}")
    feats = [f for f in (row["features"] or "").split(",") if f]
    return load_model(row["model_path"]), feats, row["target"], row["run_id"]


def latest_version(spark: SparkSession, root: str, artifact: str = MODEL_ARTIFACT) -> tuple[str, str, int, str]:
    """(run id, registered name, version, model path) of the latest run with ``artifact``; nothing is loaded."""
    run = latest_run(read_table(spark, root, "runs", RUNS_SCHEMA), artifact).first()
    if run is None:
        raise FileNotFoundError(f"no run saved a model named {artifact!r} under {root}")
    name = f"{artifact}_{run['algorithm']}"
    # A run killed between its registration and its row registers again when it is logged again: the first one counts.
    version = registry(spark, root).where((F.col("name") == name) & (F.col("run_id") == run["run_id"])).agg(F.min("version")).first()[0]
    return run["run_id"], name, version, run["model_path"]


def compact_runs(spark: SparkSession, root: str, keep_seconds: float = 86_400.0) -> dict[str, int]:
    """Merge the entries of every run table (:func:`tabforge.operators.run_log.compact_table`): files taken in, by table.

    Runs may be logged and read meanwhile. Each table is merged by itself; a run
    is visible by its row in ``runs``, which is read the same before and after.
    """
    return {name: compact_table(spark, root, name, schema, keep_seconds) for name, schema in TABLES.items()}
