"""Stream scoring resumes from its checkpoint: every request scored once."""

from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier

from tabforge.operators.features import assembler, freq_indexer
from tabforge.streaming.score import start_scoring_stream


def test_stream_resumes_exactly_once(spark, tmp_path):
    train = spark.createDataFrame([(float(i % 10), "a" if i % 2 else "b", float(i % 10 > 4)) for i in range(60)],
                                  "x double, cat string, label double")
    model = Pipeline(stages=[freq_indexer("cat"), assembler(["x"], ["cat_index"]),
                             DecisionTreeClassifier(featuresCol="features", labelCol="label", seed=1)]).fit(train)
    schema = "rid int, x string, cat string"
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")

    def add(batch, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)

    add(0, [(i, str(i % 10), "a") for i in range(10)])
    q = start_scoring_stream(spark, model, src, schema, out, ck, ["x"], ["cat"], keep=["rid"],
                             max_files_per_trigger=1)
    q.awaitTermination()
    first = spark.read.parquet(out).count()
    add(1, [(i, "oops" if i == 15 else str(i % 10), "b") for i in range(10, 20)])
    q = start_scoring_stream(spark, model, src, schema, out, ck, ["x"], ["cat"], keep=["rid"],
                             max_files_per_trigger=1)
    q.awaitTermination()
    rows = {r.rid: (r.response, r.input_error) for r in spark.read.parquet(out).collect()}
    assert first == 10
    assert sorted(rows) == list(range(20))                     # nothing lost, nothing twice
    assert spark.read.parquet(out).count() == 20
    assert rows[15] == (None, "x")
    assert all(v[0] in ("Yes", "No") for k, v in rows.items() if k != 15)
