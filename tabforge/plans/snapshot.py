"""Versioned snapshot of the typed wide frame split into configured tables.

Layout: ``<base>/<prefix>_ver_<version>/<table>`` (one Parquet folder per
table), and the empty file ``_COMPLETE`` once all of them are written.

The wide frame is written first, in one pass over the raw input; each table
is then a column-pruned read of it. This cuts the lineage (an executor lost
while writing table 5 re-reads Parquet instead of re-cleaning the raw text),
keeps all tables on exactly the same rows, and reads each column only for the
tables that need it. Table writes run as concurrent Spark jobs; the wide frame
goes when they are done.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.config import COLUMN_TYPES, TABLE_SCHEMAS
from tabforge.operators.aggregates import null_counts
from tabforge.operators.keys import repeated_keys
from tabforge.session import join_path
from tabforge.sources.schema import declared_constraints, table_struct

TYPED, COMPLETE = "_typed", "_COMPLETE"


def version_stamp(now: dt.datetime | None = None) -> str:
    """``yyyy-mm-dd_HH-MM-SS`` of the run start."""
    return (now or dt.datetime.now()).strftime("%Y-%m-%d_%H-%M-%S")


def snapshot_dir(base: str, prefix: str, version: str) -> str:
    return join_path(base, f"{prefix}_ver_{version}")


def write_snapshot(
    typed: DataFrame,
    base: str,
    prefix: str,
    version: str | None = None,
    table_schemas: dict[str, dict[str, str]] = TABLE_SCHEMAS,
    column_types: dict[str, str] = COLUMN_TYPES,
    mode: str = "errorifexists",
    max_concurrent: int = 4,
    files_per_table: int | None = None,
) -> dict[str, str]:
    """Write every configured table; returns ``{table: path}`` in config order
    plus ``'_dir'`` → the snapshot folder. A configured column missing from
    ``typed`` is an error before anything is written. ``files_per_table`` merges
    a table's files (no shuffle) where the caller knows that it is small. The
    marker that a snapshot is finished is written last."""
    spark = typed.sparkSession
    folder = snapshot_dir(base, prefix, version or version_stamp())
    needed: list[str] = []
    for schema in table_schemas.values():
        for c in schema:
            if c not in needed:
                needed.append(c)
    missing = [c for c in needed if c not in typed.columns]
    if missing:
        raise ValueError(f"typed frame lacks configured columns: {missing}")
    wide = typed.select(*[F.col(c).cast(_field(c, table_schemas, column_types).dataType) for c in needed])
    wide_path = join_path(folder, TYPED)
    wide.write.mode(mode).parquet(wide_path)

    def write_one(table: str) -> tuple[str, str]:
        path = join_path(folder, table)
        part = spark.read.parquet(wide_path).select(*table_schemas[table])
        if files_per_table is not None:
            part = part.coalesce(files_per_table)
        part.write.mode(mode).parquet(path)
        return table, path

    with ThreadPoolExecutor(max_workers=max(1, max_concurrent)) as pool:
        written = dict(pool.map(write_one, list(table_schemas)))
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(hadoop.Path(wide_path), True)  # all its rows are in the tables now
    files.createNewFile(hadoop.Path(join_path(folder, COMPLETE)))
    out = {t: written[t] for t in table_schemas}
    out["_dir"] = folder
    return out


def read_snapshot(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One table of a finished snapshot; a folder whose writing broke off is an error."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    mark = hadoop.Path(join_path(folder, COMPLETE))
    if not mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark):
        raise FileNotFoundError(f"{folder} is no finished snapshot")
    return spark.read.parquet(join_path(folder, table))


def _field(column, table_schemas, column_types):
    for t, schema in table_schemas.items():
        if column in schema:
            return table_struct(t, table_schemas, column_types)[column]
    raise KeyError(column)


def snapshot_null_counts(
    spark: SparkSession, paths: dict[str, str], table_schemas: dict[str, dict[str, str]] = TABLE_SCHEMAS
) -> DataFrame:
    """``(table_name, column_name, nulls)`` for every table slot: one aggregate per table, reading it once."""
    counts = [null_counts(read_snapshot(spark, paths["_dir"], t).select(*schema), t) for t, schema in table_schemas.items()]
    return reduce(DataFrame.unionByName, counts)


def key_violations(
    spark: SparkSession, paths: dict[str, str], table_schemas: dict[str, dict[str, str]] = TABLE_SCHEMAS
) -> DataFrame:
    """Rows that break a declared PRIMARY KEY, by key: ``(table_name, column_name, key, rows)``.

    A key (as text) with the number of its rows where it stands on more than
    one, and null with the number of rows without a key; nothing where a key is
    kept. See :mod:`tabforge.operators.keys`.
    """
    def broken(ck: dict) -> list[DataFrame]:
        rows = read_snapshot(spark, paths["_dir"], ck["table"]).select(ck["column"])
        named = [F.lit(ck["table"]).alias("table_name"), F.lit(ck["column"]).alias("column_name")]
        without = rows.where(F.col(ck["column"]).isNull()).agg(F.count(F.lit(1)).alias("rows")).where("rows > 0")
        return [repeated_keys(rows, ck["column"]).select(*named, F.col("key").cast("string"), "rows"),
                without.select(*named, F.lit(None).cast("string").alias("key"), "rows")]

    with ThreadPoolExecutor(max_workers=4) as pool:
        found = [df for dfs in pool.map(broken, [ck for ck in declared_constraints(table_schemas) if ck["primary_key"]]) for df in dfs]
    if not found:
        return spark.createDataFrame([], "table_name string, column_name string, key string, rows bigint")
    return reduce(DataFrame.unionByName, found)


def constraint_report(
    spark: SparkSession, paths: dict[str, str], table_schemas: dict[str, dict[str, str]] = TABLE_SCHEMAS
) -> DataFrame:
    """Violations of the declared (unenforced) constraints, one aggregate per table and one for all keys:
    ``(table_name, column_name, check_name, violations)`` for NOT NULL, PRIMARY KEY
    (rows minus distinct keys) and VARCHAR(n) (texts longer than n)."""
    reports, names = [], "table_name string, column_name string, check_name string"
    declared = declared_constraints(table_schemas)
    for table in table_schemas:
        checks = {}
        for ck in (x for x in declared if x["table"] == table):
            c = F.col(ck["column"])
            if ck["not_null"]:
                checks[ck["column"], "not_null"] = F.sum(F.when(c.isNull(), 1).otherwise(0))
            if ck["max_length"] is not None:
                checks[ck["column"], f"max_length_{ck['max_length']}"] = F.sum(F.when(F.length(c.cast("string")) > ck["max_length"], 1).otherwise(0))
        if not checks:
            continue
        counts = read_snapshot(spark, paths["_dir"], table).agg(*[e.alias(f"v{i}") for i, e in enumerate(checks.values())])
        reports.append(counts.select(F.inline(F.array(*[
            F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), F.lit(k).alias("check_name"),
                     F.coalesce(F.col(f"v{i}"), F.lit(0)).cast("bigint").alias("violations"))
            for i, (c, k) in enumerate(checks)]))))
    keys = [(ck["table"], ck["column"], "primary_key") for ck in declared if ck["primary_key"]]
    if keys:
        extra = F.col("rows") - F.when(F.col("key").isNull(), 0).otherwise(1)
        broken = key_violations(spark, paths, table_schemas).groupBy("table_name", "column_name").agg(F.sum(extra).alias("violations"))
        all_keys = spark.createDataFrame(keys, names)
        reports.append(all_keys.join(broken, ["table_name", "column_name"], "left").select(*all_keys.columns, F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations")))
    if not reports:
        return spark.createDataFrame([], f"{names}, violations bigint")
    return reduce(DataFrame.unionByName, reports)
