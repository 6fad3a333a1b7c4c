"""A job that is stopped after any step and started again ends as one that never stopped."""

import pytest

from tabforge.operators import runs
from tabforge.operators.runs import RUNS_SCHEMA, read_table, registry
from tabforge.plans import job
from tabforge.plans.journal import Journal, input_state
from tabforge.plans.prepare import PrepareSpec
from tests.test_job import raw_records

GRID = {"classification_models": ["DecisionTreeClassifier"], "hyperparameters": {"DecisionTreeClassifier": {"maxDepth": [2]}}}


class Stopped(Exception):
    pass


def test_stopped_at_every_step(spark, tmp_path, monkeypatch):
    src = str(tmp_path / "sheet")
    raw_records(spark, 200).coalesce(1).write.option("header", "true").csv(src)
    root = str(tmp_path / "runs")

    def start():
        return job.run_job(spark, f"{src}/*.csv", str(tmp_path / "db"), "sheet", root, prepare_spec=PrepareSpec(rel_error=0.0),
                           tuning=GRID, folds=2, version="v1", journal=str(tmp_path / "journal"))

    calls = []

    def counted(name, stop, after=False):
        plain = getattr(job, name)

        def run(*a, **k):
            calls.append(name)
            if stop and not after:
                raise Stopped
            out = plain(*a, **k)
            if stop:
                raise Stopped
            return out

        return run

    steps = [("write_snapshot", True), ("prepare", False), ("train_select", False), ("log_run", True)]
    for name, after in steps:
        with monkeypatch.context() as m:
            for other, _ in steps:
                m.setattr(job, other, counted(other, other == name, after))
            with pytest.raises(Stopped):
                start()
    with monkeypatch.context() as m:
        for other, _ in steps:
            m.setattr(job, other, counted(other, False))
        done = start()
        before = list(calls)
        again = start()
    assert calls == before  # nothing runs twice once it is done
    assert calls.count("write_snapshot") == 2 and calls.count("prepare") == 2 and calls.count("train_select") == 3

    plain = job.run_job(spark, f"{src}/*.csv", str(tmp_path / "db2"), "sheet", str(tmp_path / "runs2"), prepare_spec=PrepareSpec(rel_error=0.0),
                        tuning=GRID, folds=2, version="v1")
    for table in (t for t in plain.tables if t != "_dir"):
        a, b = (spark.read.parquet(r.tables[table]) for r in (done, plain))
        assert a.count() == b.count() and a.exceptAll(b).isEmpty()
    assert done.run_id == again.run_id and again.train.metrics == done.train.metrics == pytest.approx(plain.train.metrics)
    assert again.train.results == done.train.results and again.train.grid == done.train.grid
    assert [r.run_id for r in read_table(spark, root, "runs", RUNS_SCHEMA).collect()] == [done.run_id]
    assert [r.version for r in registry(spark, root).collect()] == [1]
    assert runs.load_latest(spark, root)[3] == done.run_id


def test_changed_inputs_are_another_step(spark, tmp_path):
    log, ran = Journal(spark, str(tmp_path / "journal")), []
    step = lambda inputs: log.step("s", inputs, lambda key: ran.append(key) or {"at": len(ran)})
    assert step({"a": 1})["at"] == 1 and step({"a": 1})["at"] == 1 and step({"a": 2})["at"] == 2
    src = tmp_path / "in"
    src.mkdir()
    (src / "x.csv").write_text("a\n1\n")
    first = input_state(spark, str(src))
    assert first == input_state(spark, str(src)) and first["files"] == 1
    (src / "y.csv").write_text("a\n1\n")
    assert input_state(spark, str(src)) != first
    with pytest.raises(ValueError, match="raw_state"):
        job.run_job(spark, spark.range(1), "b", "p", "r", journal=str(tmp_path / "j"))
