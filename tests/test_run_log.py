"""Compaction of the run tables: every run once, before, during and after, whoever writes or reads meanwhile."""

import os
import threading

import pytest

from tabforge.operators import run_log
from tabforge.operators.run_log import compact_table, read_table
from tabforge.operators.runs import RUNS_SCHEMA, TABLES, _append, compact_runs, registry, utc_now

SCHEMA = "run_id string, value int"


def write(spark, root, run, value=0):
    _append(spark.createDataFrame([(run, value)], SCHEMA), root, "t", run)


def held(spark, root):
    return sorted((r.run_id, r.value) for r in read_table(spark, root, "t", SCHEMA).collect())


def files_read(spark, root):
    return len(read_table(spark, root, "t", SCHEMA).inputFiles())


def many(spark, root, n):
    """``n`` entries in one job, in the layout of single ones."""
    rows = spark.range(n).selectExpr("concat('r', id) run_id", "0 value", "concat('r', id) entry")
    rows.repartition(8, "entry").write.partitionBy("entry").mode("append").parquet(os.path.join(root, "t"))
    return [(f"r{i}", 0) for i in range(n)]


def test_a_thousand_runs_become_one_file(spark, tmp_path):
    root = str(tmp_path)
    rows = sorted(many(spark, root, 1000))
    assert files_read(spark, root) == 1000
    assert compact_table(spark, root, "t", SCHEMA) == 1000
    assert files_read(spark, root) == 1 and held(spark, root) == rows
    write(spark, root, "new", 5)
    assert files_read(spark, root) == 2 and held(spark, root) == sorted(rows + [("new", 5)])
    # Entries are kept for readers of the state before, until keep_seconds have passed.
    assert os.path.isdir(tmp_path / "t" / "entry=r1")
    assert compact_table(spark, root, "t", SCHEMA, keep_seconds=0) == 1
    assert not [d for d in os.listdir(tmp_path / "t") if d.startswith("entry=")]
    assert len(os.listdir(tmp_path / "t" / "_merged")) in (2, 3)  # one generation, its marker, a checksum file of it
    assert files_read(spark, root) == 1 and held(spark, root) == sorted(rows + [("new", 5)])
    assert compact_table(spark, root, "t", SCHEMA, keep_seconds=0) == 0
    assert held(spark, root) == sorted(rows + [("new", 5)])


def test_a_run_written_again_replaces_its_merged_rows(spark, tmp_path):
    root = str(tmp_path)
    for run in ("12", "1e3", "c"):  # ids that look like numbers stay texts
        write(spark, root, run)
    compact_table(spark, root, "t", SCHEMA)
    write(spark, root, "1e3", 7)
    want = [("12", 0), ("1e3", 7), ("c", 0)]
    assert held(spark, root) == want
    for keep in (1e6, 0, 0):
        compact_table(spark, root, "t", SCHEMA, keep_seconds=keep)
        assert held(spark, root) == want
    write(spark, root, "c", 9)
    assert held(spark, root) == [("12", 0), ("1e3", 7), ("c", 9)]


def test_readers_and_writers_during_compactions(spark, tmp_path):
    root, logged, stop, wrong = str(tmp_path), [], threading.Event(), []
    write(spark, root, "w0")
    logged.append("w0")

    def reader():
        while not stop.is_set():
            before = list(logged)
            got = [r for r, _ in held(spark, root)]
            if len(got) != len(set(got)) or not set(before) <= set(got):
                wrong.append((before, got))

    def writer():
        for i in range(1, 10):
            write(spark, root, f"w{i}")
            logged.append(f"w{i}")

    threads = [threading.Thread(target=reader), threading.Thread(target=writer)]
    for t in threads:
        t.start()
    while threads[1].is_alive():
        compact_table(spark, root, "t", SCHEMA)
    stop.set()
    threads[0].join()
    assert not wrong and held(spark, root) == [(f"w{i}", 0) for i in range(10)]


@pytest.mark.parametrize("at", ["finish", "drop_files", "drop_generation"])
def test_a_compaction_that_dies_changes_nothing(spark, tmp_path, monkeypatch, at):
    root = str(tmp_path)
    for i in range(3):
        write(spark, root, f"r{i}")
    compact_table(spark, root, "t", SCHEMA)
    write(spark, root, "r3")

    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(run_log._Store, at, die)
        with pytest.raises(KeyboardInterrupt):
            compact_table(spark, root, "t", SCHEMA, keep_seconds=0)
    want = [(f"r{i}", 0) for i in range(4)]
    assert held(spark, root) == want
    compact_table(spark, root, "t", SCHEMA, keep_seconds=0)
    assert held(spark, root) == want


def test_of_two_compactions_one_gives_up(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    write(spark, root, "a")
    plain, inner = run_log._rows, []

    def other_first(*args):
        if not inner:
            inner.append(None)
            inner[0] = compact_table(spark, root, "t", SCHEMA)
        return plain(*args)

    monkeypatch.setattr(run_log, "_rows", other_first)
    assert compact_table(spark, root, "t", SCHEMA) == 0 and inner == [1]
    assert held(spark, root) == [("a", 0)]


def test_all_run_tables(spark, tmp_path):
    root = str(tmp_path)
    assert compact_runs(spark, root) == dict.fromkeys(TABLES, 0)
    for run in "ab":
        _append(spark.createDataFrame([(run, utc_now(), "x", "t", "f", "m", "/m")], RUNS_SCHEMA), root, "runs", run)
    assert compact_runs(spark, root) == dict.fromkeys(TABLES, 0) | {"runs": 2}
    assert read_table(spark, root, "runs", RUNS_SCHEMA).count() == 2 and registry(spark, root).count() == 0
