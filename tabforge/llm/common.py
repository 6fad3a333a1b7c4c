"""Helpers shared by the text operators: written tables, word splitting, seeded order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.session import scratch_path

#: Words are separated by the space and the controls from tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"
#: Stands in for a null doc_id where rows are put in order: nulls come last.
LAST_ID = (1 << 63) - 1


def written(df: DataFrame, kind: str, **options: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back; ``options`` are the writer's.

    Cuts the lineage: a lost executor costs a reread, never a recomputation of
    what came before.
    """
    path = scratch_path(df.sparkSession, f"llm-{kind}")
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(c: Column | str) -> Column:
    """Null text counts as empty."""
    return F.coalesce(c if isinstance(c, Column) else F.col(c), F.lit(""))


def words(c: Column) -> Column:
    """The words of a text, in order."""
    return F.array_remove(F.split(c, SPACE_RUN, -1), "")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` uses it, in lambdas too."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def draw(seed: str, *cols: Column) -> Column:
    """32 bits that depend on the seed and the values only (nulls as ``-``)."""
    parts = [F.coalesce(c.cast("string"), F.lit("-")) for c in cols]
    return F.conv(F.substring(F.md5(F.concat_ws("/", F.lit(seed), *parts)), 1, 8), 16, 10).cast("long")


def parts_for(df: DataFrame) -> int:
    """How many parts a shuffled table is dealt into: what the session asks for."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def broadcast_if_small(df: DataFrame, row_bytes: int, limit: int = 16 << 20) -> DataFrame:
    """``df`` (a written table) marked for broadcast if its rows take ``limit`` bytes at most; else joined as Spark plans it."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df
