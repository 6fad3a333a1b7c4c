"""Session helpers: the shared working folder and a local session for tests."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for lineage cuts, snapshots and models.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only
    when neither is set on a ``local`` master (tests) a private folder is
    created and registered, so later calls in the same session reuse it; on a
    cluster that is an error, as a machine-local folder is not shared.
    """
    path = spark.conf.get(_CHECKPOINT_KEY, None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared, durable folder (e.g. on HDFS or S3)")
        path = tempfile.mkdtemp(prefix="tabforge-")
        spark.conf.set(_CHECKPOINT_KEY, path)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def join_path(base: str, *parts: str) -> str:
    """Join path segments with ``/`` (works for local paths and URIs alike)."""
    out = base.rstrip("/")
    for p in parts:
        out = f"{out}/{p.strip('/')}"
    return out


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh, unique folder below the shared dir for one write."""
    return join_path(shared_dir(spark), "tabforge", kind, uuid.uuid4().hex)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, settings: dict[str, str] | None = None) -> SparkSession:
    """Session for tests and the local bench (the library never creates one)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tabforge")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark
