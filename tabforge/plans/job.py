"""The end-to-end batch job: raw text → typed tables → model-ready frame →
trained, selected and logged classifier.

Steps hand over by path: the snapshot tables are written once and the
model-ready table is read back from them, so every step restarts from
storage, and a lost executor costs only its own tasks.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.config import COLUMN_TYPES, TABLE_SCHEMAS, TUNING
from tabforge.operators.runs import RUNS_SCHEMA, load_model, log_run, read_table, utc_now
from tabforge.operators.train import TrainResult, train_select
from tabforge.plans.clean import CleanSpec, clean
from tabforge.plans.journal import Journal, input_state
from tabforge.plans.prepare import PrepareSpec, model_columns, prepare, stages_for
from tabforge.plans.snapshot import write_snapshot
from tabforge.session import join_path
from tabforge.sources.files import read_text_table


@dataclass
class JobResult:
    tables: dict[str, str]
    run_id: str
    train: TrainResult


def run_job(
    spark: SparkSession,
    raw: DataFrame | str,
    base: str,
    prefix: str,
    runs_root: str,
    clean_spec: CleanSpec | None = None,
    prepare_spec: PrepareSpec | None = None,
    table_schemas: dict[str, dict[str, str]] = TABLE_SCHEMAS,
    column_types: dict[str, str] = COLUMN_TYPES,
    model_table: str = "ml_ready",
    tuning: dict = TUNING,
    folds: int = 5,
    seed: int = 42,
    version: str | None = None,
    parallelism: int = 4,
    journal: str | None = None,
    raw_state: dict | None = None,
) -> JobResult:
    """Clean ``raw`` (all-text frame, or a path/glob of text tables), write the
    snapshot, prepare the model table, train and select, log the run. Returns
    paths, run id and results.

    With ``journal`` (a folder), finished steps are noted there, and a job that
    is started again with the same inputs and settings goes on after the last
    of them: the snapshot is written once, training reads the prepared table
    again, and a run is logged under one id however often the step ran. The
    state of files comes from their names, lengths and times; a frame needs
    ``raw_state``, any values that change with its rows.
    """
    if journal is not None:
        return _resumable(spark, raw, base, prefix, runs_root, clean_spec or CleanSpec(column_types=dict(column_types)), prepare_spec or PrepareSpec(),
                          table_schemas, column_types, model_table, tuning, folds, seed, version, parallelism, Journal(spark, journal), raw_state)
    started = utc_now()
    if isinstance(raw, str):
        raw = read_text_table(spark, raw)
    cs = clean_spec or CleanSpec(column_types=dict(column_types))
    ps = prepare_spec or PrepareSpec()
    tables = write_snapshot(clean(raw, cs), base, prefix, version, table_schemas, column_types)
    ready = prepare(spark.read.parquet(tables[model_table]), ps)
    result = train_select(ready, stages_for(ps), tuning, ps.label, folds=folds, seed=seed, parallelism=parallelism)
    run_id = log_run(spark, runs_root, result, ps.label, model_columns(ps), start_time=started)
    return JobResult(tables, run_id, result)


def _resumable(spark, raw, base, prefix, runs_root, cs, ps, table_schemas, column_types, model_table, tuning, folds, seed, version, parallelism, log, raw_state) -> JobResult:
    """:func:`run_job` by its journal: three steps, each with the one before among its inputs."""
    if raw_state is None:
        if not isinstance(raw, str):
            raise ValueError("a journal needs raw_state for a frame: values that change with its rows")
        raw_state = input_state(spark, raw)

    def snapshot(key: str) -> dict:
        frame = read_text_table(spark, raw) if isinstance(raw, str) else raw
        return write_snapshot(clean(frame, cs), base, prefix, version, table_schemas, column_types, mode="overwrite")

    tables = log.step("snapshot", {"raw": raw_state, "base": base, "prefix": prefix, "version": version, "clean": asdict(cs),
                                   "tables": table_schemas, "types": column_types}, snapshot)

    def prepared(key: str) -> dict:
        path = join_path(log.path, "ready", key)
        prepare(spark.read.parquet(tables[model_table]), ps).write.mode("overwrite").parquet(path)
        return {"path": path}

    ready = log.step("prepare", {"table": tables[model_table], "prepare": asdict(ps)}, prepared)

    def trained(key: str) -> dict:
        started = utc_now()
        result = train_select(spark.read.parquet(ready["path"]), stages_for(ps), tuning, ps.label, folds=folds, seed=seed, parallelism=parallelism)
        log_run(spark, runs_root, result, ps.label, model_columns(ps), start_time=started, run_id=key)
        return {"run_id": key, "best_name": result.best_name, "metrics": result.metrics, "params": result.params,
                "importances": result.importances, "results": result.results, "grid": result.grid}

    out = log.step("train", {"ready": ready["path"], "prepare": asdict(ps), "tuning": tuning, "folds": folds, "seed": seed, "runs": runs_root}, trained)
    run_id = out.pop("run_id")
    row = read_table(spark, runs_root, "runs", RUNS_SCHEMA).where(F.col("run_id") == run_id).first()
    out["importances"] = out["importances"] and [tuple(x) for x in out["importances"]]
    out["grid"] = [tuple(x) for x in out["grid"]]
    return JobResult(tables, run_id, TrainResult(best_model=load_model(row["model_path"]), **out))
