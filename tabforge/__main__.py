"""Batch application: ``spark-submit -m tabforge`` or ``python -m tabforge``.

    python -m tabforge --input 's3a://bucket/sheets/*.csv' --prefix sheet \\
        [--base <dir>] [--runs <dir>] [--tuning grid.json] [--folds 5] [--seed 42]
        [--journal <dir>]

Reads the all-text records, writes the versioned snapshot, prepares the model
table, runs the grid search, logs the run, and prints a one-line JSON summary.
Cluster, memory and file-system settings come from ``spark-submit``; ``--base``
and ``--runs`` default to folders under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from tabforge.config import TUNING
from tabforge.plans.job import run_job
from tabforge.plans.prepare import PrepareSpec
from tabforge.session import join_path, shared_dir
from tabforge.sources.schema import load_json_config


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="tabforge", description=__doc__.split("\n")[0])
    ap.add_argument("--input", required=True, help="path or glob of the text tables (CSV with a header row)")
    ap.add_argument("--prefix", required=True, help="dataset name used in the snapshot folder")
    ap.add_argument("--base", help="snapshot root (default: <spark.checkpoint.dir>/db)")
    ap.add_argument("--runs", help="run-table root (default: <spark.checkpoint.dir>/runs)")
    ap.add_argument("--tuning", help="JSON with classification_models and hyperparameters (default: built-in grid)")
    ap.add_argument("--folds", type=int, default=5)
    ap.add_argument("--seed", type=int, default=42)
    ap.add_argument("--rel-error", type=float, default=0.05, help="quartile error (0 = exact)")
    ap.add_argument("--journal", help="folder of finished steps: the same job started again goes on after them")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("tabforge").getOrCreate()
    root = shared_dir(spark)
    res = run_job(spark, args.input, args.base or join_path(root, "db"), args.prefix,
                  args.runs or join_path(root, "runs"), prepare_spec=PrepareSpec(rel_error=args.rel_error),
                  tuning=load_json_config(args.tuning) if args.tuning else TUNING, folds=args.folds, seed=args.seed, journal=args.journal)
    summary = {"run_id": res.run_id, "algorithm": res.train.best_name, "metrics": res.train.metrics,
               "snapshot": res.tables["_dir"]}
    print(json.dumps(summary))
    return summary


if __name__ == "__main__":
    main()
