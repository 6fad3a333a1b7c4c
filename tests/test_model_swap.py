"""A stream whose model changes while it runs: early rows by the first run, later ones by the second, once each."""

import os
import time

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier

from tabforge.operators.features import assembler
from tabforge.operators.runs import latest_version, log_run
from tabforge.operators.train import TrainResult
from tabforge.streaming.score import start_swapping_stream

SCHEMA = "rid int, x string"


def log_model(spark, root, high_is_yes):
    """A run whose model answers Yes for x above 4, or for the others."""
    rows = [(float(i % 10), float((i % 10 > 4) == high_is_yes)) for i in range(60)]
    model = Pipeline(stages=[assembler(["x"], []), DecisionTreeClassifier(featuresCol="features", labelCol="label", seed=1)]).fit(
        spark.createDataFrame(rows, "x double, label double"))
    return log_run(spark, root, TrainResult("DecisionTreeClassifier", model, {"f1": 1.0}, {}, None))


class Stream:
    def __init__(self, spark, tmp_path):
        self.spark, self.tmp = spark, tmp_path
        self.root, self.source, self.sink, self.checkpoint = (str(tmp_path / k) for k in ("runs", "in", "out", "ck"))
        spark.createDataFrame([], SCHEMA).write.parquet(self.source)

    def add(self, ids):
        self.spark.createDataFrame([(i, "oops" if i % 10 == 9 else str(i % 10)) for i in ids], SCHEMA).coalesce(1).write.mode("append").parquet(self.source)

    def start(self, **how):
        return start_swapping_stream(self.spark, self.root, self.source, SCHEMA, self.sink, self.checkpoint, ["x"], [], keep=["rid"], **how)

    def drain(self):
        self.start(max_files_per_trigger=1).awaitTermination()

    def rows(self):
        got = self.spark.read.parquet(self.sink).collect()
        out = {r.rid: (r.model_version, r.run_id, r.response, r.input_error) for r in got}
        assert len(out) == len(got)  # no request twice
        return out


def expected(ids, version, run, high_is_yes):
    say = lambda i: (None, "x") if i % 10 == 9 else ("Yes" if (i % 10 > 4) == high_is_yes else "No", None)
    return {i: (version, run, *say(i)) for i in ids}


def test_swap_across_a_restart(spark, tmp_path):
    s = Stream(spark, tmp_path)
    first = log_model(spark, s.root, True)
    s.add(range(20))
    s.drain()
    second = log_model(spark, s.root, False)
    s.add(range(20, 30))
    s.add(range(30, 40))
    s.drain()
    assert s.rows() == expected(range(20), 1, first, True) | expected(range(20, 40), 2, second, False)
    assert latest_version(spark, s.root)[:3] == (second, "Best_response_model_DecisionTreeClassifier", 2)


def test_swap_while_running(spark, tmp_path):
    s = Stream(spark, tmp_path)
    first = log_model(spark, s.root, True)
    s.add(range(10))
    q = s.start(available_now=False, processing_time="200 milliseconds")
    try:
        def wait(n):
            until = time.monotonic() + 60
            while time.monotonic() < until:
                if os.path.isdir(s.sink) and spark.read.schema("rid int").parquet(s.sink).count() >= n:
                    return
                time.sleep(0.2)
            raise AssertionError(q.exception())

        wait(10)
        second = log_model(spark, s.root, False)
        s.add(range(10, 20))
        wait(20)
    finally:
        q.stop()
    assert s.rows() == expected(range(10), 1, first, True) | expected(range(10, 20), 2, second, False)


def test_a_batch_tried_again_keeps_its_model_and_replaces_its_rows(spark, tmp_path):
    s = Stream(spark, tmp_path)
    first = log_model(spark, s.root, True)
    s.add(range(10))
    s.drain()
    before = s.rows()
    log_model(spark, s.root, False)
    # The batch was written, but the stream died before Spark took note of it.
    commits = os.path.join(s.checkpoint, "commits")
    last = str(max(int(n) for n in os.listdir(commits) if n.isdigit()))
    for name in (last, f".{last}.crc"):
        if os.path.exists(os.path.join(commits, name)):
            os.remove(os.path.join(commits, name))
    s.drain()
    assert s.rows() == before == expected(range(10), 1, first, True)


def test_without_a_run_the_batch_waits_for_one(spark, tmp_path):
    s = Stream(spark, tmp_path)
    s.add(range(10))
    with pytest.raises(Exception, match="no run saved a model"):
        s.drain()
    run = log_model(spark, s.root, True)
    s.drain()
    assert s.rows() == expected(range(10), 1, run, True)


def test_names_of_the_sink_are_refused(spark, tmp_path):
    s = Stream(spark, tmp_path)
    with pytest.raises(ValueError, match="run_id"):
        start_swapping_stream(spark, s.root, s.source, "run_id int, x string", s.sink, s.checkpoint, ["x"], [], keep=["run_id"])
