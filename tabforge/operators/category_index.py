"""Category indexes as tables: any number of categories, none of them on the driver.

``StringIndexer`` collects every distinct category and ships all of them with the
model, which fits the few categories of a feature column. For columns with
millions, an index is a table ``(category, index)`` that is joined when rows are
indexed, at fit and at scoring time alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabforge.session import scratch_path

ORDERS = ("frequency_desc", "alphabet_desc")
#: ``monotonically_increasing_id`` has the partition above these bits and the row's place below.
_PLACE_BITS = 33


def category_index(df: DataFrame, column: str, order: str = "frequency_desc", path: str | None = None) -> DataFrame:
    """The index of a column's categories: ``category`` (as text) and ``index`` (double, from 0, without gaps).

    ``frequency_desc`` puts the most frequent first, ties alphabetical;
    ``alphabet_desc`` the last of the alphabet first (by UTF-8 bytes). Nulls are
    no category; an empty column has an empty index. Written to ``path`` (a
    folder of its own in the shared folder by default) and read back.

    Rows are counted map-side, so a frequent category is one row per task in
    the shuffle. The categories are sorted by ranges; a category's index is its
    place in its range plus the sizes of the ranges before.
    """
    if order not in ORDERS:
        raise ValueError(f"order must be one of {ORDERS}, not {order!r}")
    spark = df.sparkSession
    counts = df.select(F.col(column).cast("string").alias("category")).where("category IS NOT NULL").groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    by = [F.desc("n"), F.asc("category")] if order == "frequency_desc" else [F.desc("category")]
    placed_at = scratch_path(spark, "category-places")
    counts.orderBy(*by).select("category", F.monotonically_increasing_id().alias("place")).write.parquet(placed_at)
    placed = spark.read.schema("category string, place bigint").parquet(placed_at)
    of = F.shiftright("place", _PLACE_BITS)
    sizes = placed.groupBy(of.alias("range")).agg(F.count(F.lit(1)).alias("n"))
    # One row per range, as many as the sort had partitions.
    before = sizes.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("before"))
    place = F.col("place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    index = placed.withColumn("range", of).join(F.broadcast(before), "range").select("category", (place + F.col("before")).cast("double").alias("index"))
    path = path or scratch_path(spark, "category-index")
    index.write.parquet(path)
    return load_category_index(spark, path)


def load_category_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("category string, index double").parquet(path)


def indexed(df: DataFrame, column: str, index: DataFrame, output: str | None = None, handle_invalid: str = "error") -> DataFrame:
    """``df`` with the index of ``column`` (``<column>_index`` unless named).

    A null or a category that the index lacks is an error when the row is read
    (``error``), gets the number after the last index (``keep``) or loses its row
    (``skip``). A join on the category: Spark broadcasts the index while its
    measured size allows it and splits a frequent category's rows beyond.
    """
    if handle_invalid not in ("error", "keep", "skip"):
        raise ValueError(f"handle_invalid must be error, keep or skip, not {handle_invalid!r}")
    output = output or f"{column}_index"
    if output in df.columns:
        raise ValueError(f"column {output!r} exists already")
    key, value = f"_{output}_category", f"_{output}_value"
    table = index.select(F.col("category").alias(key), F.col("index").alias(value))
    found = df.join(table, df[column].cast("string") == table[key], "inner" if handle_invalid == "skip" else "left")
    result = F.col(value)
    if handle_invalid == "keep":
        result = F.coalesce(result, F.lit(float(index.count())))
    elif handle_invalid == "error":
        seen = F.coalesce(df[column].cast("string"), F.lit("null"))
        result = F.coalesce(result, F.raise_error(F.concat(F.lit(f"{column} has no index for "), seen)).cast("double"))
    return found.select(*[df[c] for c in df.columns], result.alias(output))
