"""The corpus pipeline: each stage works on all rows that the one before kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which ``run`` writes as Parquet and rereads for the next.
All but the last return the columns of ``docs``. Stages take null, empty and
repeated rows as their operators do, and pass further columns through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.llm import line_dedup, mixing, near_dedup, packing, quality_classifier
from tabforge.llm.common import table, written

#: Quality classifier, near-dedup and mixing have no exact SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = quality_classifier.fit(docs, quality_classifier.training_labels(table(spark, sf_dir, "labels")))
    scored = quality_classifier.classify(docs, model)
    return scored.where(F.col("predicted") == 1).select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line makes superfluous go; documents that lose their last line go with them."""
    out = line_dedup.dedup_lines(docs, emptied=False)
    return out.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id; of an id with several texts, only those that are copies go."""
    gone = near_dedup.near_rows(docs).where(~F.col("kept")).select("doc_id", "text_key").distinct()
    same = (docs["doc_id"] == gone["doc_id"]) & (near_dedup.text_key(docs["text"]) == gone["text_key"])
    return docs.join(gone, same, "left_anti").select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a row for every time that a document is drawn."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of tokens: where each piece of each document lies."""
    return packing.pack(docs, *packing.vocabulary_paths())


STAGES = [("quality_classifier", quality), ("line_dedup", lines), ("minhash_near_dedup", near_duplicates), ("mix_sources", mixture), ("pack", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
