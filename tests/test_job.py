"""The end-to-end job on all-text records in the source's own layout."""

import random

from pyspark.sql import functions as F

from tabforge.config import COLUMN_TYPES, TABLE_SCHEMAS
from tabforge.operators.runs import RUNS_SCHEMA, load_latest, read_table
from tabforge.plans.job import run_job
from tabforge.plans.prepare import PrepareSpec

SMALL_GRID = {"classification_models": ["DecisionTreeClassifier", "LogisticRegression"],
              "hyperparameters": {"DecisionTreeClassifier": {"maxDepth": [3]}}}


def header(col):
    # Spreadsheet-style header that normalises back to the column name.
    return " ".join(w.capitalize() for w in col.split("_"))


def raw_records(spark, n=300):
    rnd = random.Random(3)
    cols = [c for c in COLUMN_TYPES if c != "response"]
    rows = []
    for i in range(n):
        r = {}
        for c in cols:
            t = COLUMN_TYPES[c]
            if t.startswith("datetime"):
                r[c] = f"{rnd.randint(1, 12):02d}/{rnd.randint(1, 28):02d}/20{rnd.randint(10, 23)}"
            elif t == "float64":
                r[c] = f"{rnd.uniform(0, 10):.2f}"
            else:
                r[c] = "x"
        r["patient_id"] = str(i) if i % 40 else f"{i}.0"
        r["age"] = f"{rnd.uniform(20, 70):.1f}"
        r["gender"] = "MF"[i % 2] if i % 17 else "m"
        r["responder"] = "R" if rnd.random() < 0.5 else "NR"
        r["ms_type"] = ["RR", "RR", "APMS", "PPMS", "SPMS"][i % 5]
        r["current_treat"] = "0" if i % 23 == 0 else "drug;A"
        r["report"] = "ok" if i % 29 else "?"
        r["wb_new"] = f"{rnd.uniform(1, 2):.3f}"
        r["lesion_new"] = f"{rnd.uniform(0, 10):.1f}" if i % 31 else None
        r["type"] = "ñ" if i % 37 == 0 else "mri"
        rows.append(tuple(r[c] for c in cols) + ("junk",))
    schema = ", ".join(f"`{header(c)}` string" for c in cols) + ", `Unnamed: 48` string"
    return spark.createDataFrame(rows, schema)


def test_run_job(spark, tmp_path):
    raw = raw_records(spark)
    res = run_job(spark, raw, str(tmp_path / "db"), "sheet", str(tmp_path / "runs"),
                  prepare_spec=PrepareSpec(materialize="persist"), tuning=SMALL_GRID, folds=3,
                  version="2024-01-01_00-00-00")
    counts = {t: spark.read.parquet(p).count() for t, p in res.tables.items() if t != "_dir"}
    assert list(counts) == list(TABLE_SCHEMAS)
    assert len(set(counts.values())) == 1
    n = next(iter(counts.values()))
    assert 0 < n < 300
    ml = spark.read.parquet(res.tables["ml_ready"])
    assert ml.columns == list(TABLE_SCHEMAS["ml_ready"])
    assert ml.filter(F.col("gender").isNull()).count() > 0     # 'm' → null, kept until preparation
    assert res.train.best_name in SMALL_GRID["classification_models"]
    runs = read_table(spark, str(tmp_path / "runs"), "runs", RUNS_SCHEMA).collect()
    assert len(runs) == 1 and runs[0].run_id == res.run_id
    model, feats, target, run_id = load_latest(spark, str(tmp_path / "runs"))
    assert run_id == res.run_id and target == "response"
    assert set(feats) == {"age", "lesion_new", "wb_new", "current_edss", "gender", "ms_type"}


def test_cli(spark, tmp_path):
    from tabforge.__main__ import main

    import json

    raw = raw_records(spark, 200)
    grid = tmp_path / "grid.json"
    grid.write_text(json.dumps(SMALL_GRID))
    src = str(tmp_path / "sheet")
    raw.coalesce(1).write.option("header", "true").csv(src)
    out = main(["--input", f"{src}/*.csv", "--prefix", "sheet", "--base", str(tmp_path / "db"),
                "--runs", str(tmp_path / "runs"), "--tuning", str(grid), "--folds", "2", "--rel-error", "0"])
    assert out["algorithm"] in ("DecisionTreeClassifier", "RandomForestClassifier", "LogisticRegression", "GBTClassifier")
    assert out["snapshot"].startswith(str(tmp_path / "db"))
