"""A journal of a job's finished steps, so that a restarted job goes on where it stopped."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.session import join_path
from tabforge.sources.files import to_hadoop_uri


def input_state(spark: SparkSession, path: str) -> dict:
    """What tells the files under a path or glob apart from earlier ones: how many, how long, and a sum over their
    names, lengths and times. The contents are not read."""
    files = spark.read.format("binaryFile").load(to_hadoop_uri(path)).select("path", "length", "modificationTime")
    row = files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
                    F.coalesce(F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")), F.lit(0)).alias("names")).first()
    return {"path": path, "files": row["files"], "bytes": row["bytes"], "names": str(row["names"])}


class Journal:
    """Finished steps below a folder, one entry for each step and each state of its inputs.

    A step's key is a hash of its name and its inputs. Its entry, one row with
    what the step returned, is written after everything the step wrote, and
    Spark commits a file as a whole: a step either is in the journal with all
    its output or runs again. A step that runs again must replace what a
    broken attempt left. One job at a time may use a journal.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    @staticmethod
    def key(name: str, inputs: dict) -> str:
        return hashlib.sha256(json.dumps([name, inputs], sort_keys=True).encode()).hexdigest()[:32]

    def _at(self, name: str, key: str) -> str:
        return join_path(self.path, f"step={name}", f"key={key}")

    def found(self, name: str, key: str) -> dict | None:
        """What the step returned, or None if it did not finish."""
        try:
            row = self.spark.read.schema("output string").parquet(self._at(name, key)).first()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return None if row is None else json.loads(row["output"])

    def step(self, name: str, inputs: dict, run: Callable[[str], dict]) -> dict:
        """What ``run`` (called with the step's key) returned for these inputs, now or in an earlier job."""
        key = self.key(name, inputs)
        done = self.found(name, key)
        if done is None:
            done = json.loads(json.dumps(run(key)))
            row: DataFrame = self.spark.createDataFrame([(json.dumps(done),)], "output string")
            row.coalesce(1).write.mode("overwrite").parquet(self._at(name, key))
        return done
