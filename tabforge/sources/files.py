"""File scans."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.config import NA_TOKENS
from tabforge.functions.text import na_to_null


#: Holds the text of a row that does not fit its header.
CORRUPT = "_corrupt_record"


def to_hadoop_uri(path: str) -> str:
    """Object-store URIs as the Hadoop S3A connector expects them."""
    return "s3a://" + path[len("s3://"):] if path.startswith("s3://") else path


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan; an explicit column list is pruned at the reader."""
    df = spark.read.parquet(to_hadoop_uri(path))
    return df.select(*columns) if columns else df


def header_lines(spark: SparkSession, paths: Sequence[str], options: dict[str, str]) -> DataFrame:
    """(path, header, own): the first line with text of every file that has one, found in one job.

    Lines come from the first block of a file, in order, so the smallest row
    number of a file's lines is its header's; a file adds one row to the
    shuffle for each task that reads it. ``own`` is the path where the line
    alone does not tell the header (a quoted cell that goes on in the next line,
    an encoding other than UTF-8), else empty.
    """
    lines = spark.read.options(**{k: v for k, v in options.items() if k in ("lineSep", "pathGlobFilter", "recursiveFileLookup")}).text(list(paths))
    lines = lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value", F.monotonically_increasing_id().alias("row"))
    lines = lines.where((F.col("block") == 0) & (F.btrim("value", F.lit(" \t\r\n\ufeff")) != ""))
    first = lines.groupBy("path").agg(F.min_by("value", "row").alias("header"))
    plain = F.lit(options.get("encoding", options.get("charset", "UTF-8")).upper() in ("UTF-8", "US-ASCII"))
    quotes = F.length(F.regexp_replace("header", r'[^"]', ""))
    # File names come with percent signs; a plus is a plus.
    path = F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))
    return first.select(path.alias("path"), "header", F.when(plain & (quotes % 2 == 0), "").otherwise(path).alias("own"))


def read_text_table(
    spark: SparkSession,
    path: str | Sequence[str],
    header: Sequence[str] | None = None,
    na_tokens: Iterable[str] = NA_TOKENS,
    options: dict[str, str] | None = None,
    bad_rows: str = "fail",
) -> DataFrame:
    """All-string scan of CSV files: every cell is text, NA tokens become null.

    Columns go by name: each file's own header names them, files with the same
    header are one scan, and scans are united by name, so files may order their
    columns differently; a column that some files lack is null there. ``header``
    picks columns (a missing one is an error). A row with more or fewer cells
    than its header fails the read, or, with ``bad_rows="keep"``, is returned
    with its text in ``_corrupt_record``; nothing is cut off silently. One job
    over the lines finds the headers (:func:`header_lines`); the driver gets a
    row for each different header, and paths only if there are several. Files
    are split by block, so a scan grows with the input; quoted cells with line breaks need
    ``options={"multiLine": "true"}``, which reads each file in one task. Blank
    headers come back as ``_cN`` (dropped by
    :func:`tabforge.operators.columns.drop_unnamed`).
    """
    def reader():
        # Keep text verbatim: no built-in null/NaN tokens, no white-space trimming.
        out = spark.read.format("csv").option("header", "true").option("inferSchema", "false").option("columnPruning", "false")
        out = out.option("nullValue", "\u0000\u0000").option("emptyValue", "").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
        return out.options(**(options or {}))

    paths = [to_hadoop_uri(path)] if isinstance(path, str) else [to_hadoop_uri(p) for p in path]
    groups: dict[tuple[str, ...], list[str]] = {}
    lines = header_lines(spark, paths, options or {}).persist()
    try:
        found = lines.groupBy("header", "own").agg(F.min("path").alias("path"), F.count(F.lit(1)).alias("files")).orderBy("path").collect()
        named = {(r["header"], r["own"]): tuple(reader().load(r["path"]).columns) for r in found}
        if len(set(named.values())) == 1:
            groups[next(iter(named.values()))] = paths
        elif found:
            for r in lines.orderBy("path").collect():
                groups.setdefault(named[r["header"], r["own"]], []).append(r["path"])
    finally:
        lines.unpersist()
    scans = []
    for names, members in groups.items():
        if not names:  # an empty file
            continue
        fields = [T.StructField(n, T.StringType()) for n in names]
        if bad_rows == "keep":
            scan = reader().option("mode", "PERMISSIVE").schema(T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])).load(members)
        else:
            scan = reader().option("mode", "FAILFAST").schema(T.StructType(fields)).load(members)
        scans.append(scan)
    if not scans:
        raise ValueError(f"no table in {paths}")
    df = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), scans)
    tokens = list(na_tokens)
    columns = [c for c in df.columns if c != CORRUPT] if header is None else list(header)
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"no file has the columns {missing}")
    kept = [na_to_null(F.col(f"`{c}`"), tokens).alias(c) for c in columns]
    return df.select(*kept, *([CORRUPT] if bad_rows == "keep" else []))


def dataset_name(path_col: Column | None = None) -> Column:
    """Name of the source file without folder and extension, per row."""
    src = path_col if path_col is not None else F.col("_metadata.file_name")
    base = F.regexp_extract(src, r"([^/]*)$", 1)
    return F.regexp_replace(base, r"\.[^.]*$", "")
