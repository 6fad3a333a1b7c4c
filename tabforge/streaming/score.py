"""Score a stream of requests with a fitted pipeline.

``readStream`` (file source with an explicit schema) → typed input with an
error column → ``model.transform`` → ``Yes``/``No`` → ``writeStream`` to a
Parquet sink with a checkpoint in the shared folder. Every stage of the
pipeline is a per-row transform, so the query is stateless: no watermark, no
state store, and exactly-once output through the file sink's commit log.

:func:`start_swapping_stream` looks the model up anew for every micro-batch, so
that a run logged while the stream is running takes over without a restart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tabforge.config import MODEL_ARTIFACT
from tabforge.operators.runs import latest_version, load_model
from tabforge.operators.score import score_checked, scoring_input
from tabforge.session import join_path

#: Columns that say which model scored a row.
MODEL_COLUMNS = ("run_id", "model_name", "model_version")
_CHOICE_SCHEMA = "batch bigint, run_id string, model_name string, model_version bigint, model_path string"


def start_scoring_stream(
    spark: SparkSession,
    model: PipelineModel,
    source: str,
    schema: T.StructType | str,
    sink: str,
    checkpoint: str,
    numeric: Sequence[str],
    text: Sequence[str],
    keep: Sequence[str] = (),
    fmt: str = "parquet",
    available_now: bool = True,
    max_files_per_trigger: int | None = 1000,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the scoring query; ``available_now`` drains what is there and stops.

    A backlog runs as as many micro-batches as ``max_files_per_trigger`` makes it.
    """
    requests = _requests(spark, source, schema, fmt, max_files_per_trigger)
    typed = scoring_input(requests, numeric, text)
    scored = score_checked(model, typed, keep=keep)
    writer = scored.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    return _triggered(writer, available_now, processing_time).start(sink)


def _requests(spark, source, schema, fmt, max_files_per_trigger) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(source)


def _triggered(writer, available_now, processing_time):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=processing_time) if processing_time else writer


class _BatchModel:
    """The model of a micro-batch: that of the latest run when the batch is first tried.

    The choice is written before the batch is scored, so a batch that Spark
    tries again after a failure is scored by the same model, whatever has been
    logged since. Only the last batch can be tried again, so one choice is kept:
    the next one replaces it, and if that write breaks off nothing was scored
    by the new choice yet. The model stays loaded until another one is chosen.
    """

    def __init__(self, root: str, artifact: str, path: str):
        self.root, self.artifact, self.path = root, artifact, path
        self.run_id, self.model = None, None

    def _written(self, spark: SparkSession, batch_id: int):
        try:
            return spark.read.schema(_CHOICE_SCHEMA).parquet(self.path).where(F.col("batch") == batch_id).first()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def choose(self, spark: SparkSession, batch_id: int):
        """(model, {column: value} for ``MODEL_COLUMNS``) of the batch."""
        row = self._written(spark, batch_id)
        if row is None:
            chosen = spark.createDataFrame([(batch_id, *latest_version(spark, self.root, self.artifact))], _CHOICE_SCHEMA)
            chosen.coalesce(1).write.mode("overwrite").parquet(self.path)
            row = chosen.first()
        if row["run_id"] != self.run_id:
            self.model, self.run_id = load_model(row["model_path"]), row["run_id"]
        return self.model, {c: row[c] for c in MODEL_COLUMNS}


def start_swapping_stream(
    spark: SparkSession,
    root: str,
    source: str,
    schema: T.StructType | str,
    sink: str,
    checkpoint: str,
    numeric: Sequence[str],
    text: Sequence[str],
    keep: Sequence[str] = (),
    artifact: str = MODEL_ARTIFACT,
    fmt: str = "parquet",
    available_now: bool = True,
    max_files_per_trigger: int | None = 1000,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Score a stream with the latest run below ``root``, looked up for every micro-batch.

    Rows leave as ``keep``, ``input_error``, ``response`` and the columns of
    ``MODEL_COLUMNS``: which run, registered name and version scored them. Each
    micro-batch is a folder ``batch=<id>`` of ``sink`` that another attempt
    at the same batch replaces, so every request is in the sink once, across
    restarts too; a reader may meet a batch that is just being replaced as
    absent. A batch that finds no run yet fails, and a restart goes on with it.
    A request that the model of its batch cannot take (a category that this
    model has not seen) is flagged in ``input_error`` as in batch scoring.
    """
    clash = {"batch", *MODEL_COLUMNS} & set(keep)
    if clash:
        raise ValueError(f"names kept for the sink's own columns: {sorted(clash)}")
    models = _BatchModel(root, artifact, join_path(checkpoint, "batch_model"))

    def score_batch(batch: DataFrame, batch_id: int) -> None:
        model, named = models.choose(batch.sparkSession, batch_id)
        scored = score_checked(model, scoring_input(batch, numeric, text), keep=keep)
        types = {c: "bigint" if c == "model_version" else "string" for c in MODEL_COLUMNS}
        scored = scored.select("*", *[F.lit(named[c]).cast(types[c]).alias(c) for c in MODEL_COLUMNS])
        scored.write.mode("overwrite").parquet(join_path(sink, f"batch={batch_id}"))

    writer = _requests(spark, source, schema, fmt, max_files_per_trigger).writeStream.foreachBatch(score_batch)
    return _triggered(writer.option("checkpointLocation", checkpoint), available_now, processing_time).start()
