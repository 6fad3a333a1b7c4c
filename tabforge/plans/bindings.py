"""Bindings of the operators to the driver's tables.

* ``dirty`` — an all-text view derived from ``orders`` by fixed ``CASE``
  rules (ids with junk, ``?``/blank/null cells, sentinel ``0``, amounts in
  cents with ``,``/``;`` and junk, dates in two layouts, flags, non-ASCII
  notes, NA tokens, a blank header). It exercises the cleaning rules on data
  whose size grows with ``orders``.
* ``doc_frame`` — a model table from ``documents`` ⋈ ``labels``: three text
  measures over the whole text, the source and language as categories, the
  quality label as ``yes``/``no``.

The DuckDB twins of these views live in :mod:`tabforge.plans.catalog`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.operators.columns import drop_unnamed, normalize_headers
from tabforge.plans.clean import CleanSpec
from tabforge.plans.oracle import DATE_LAYOUTS
from tabforge.plans.prepare import PrepareSpec
from tabforge.session import scratch_path
from tabforge.sources.files import read_parquet
from tabforge.functions.text import na_to_null

# Awkward headers of the dirty view → normalised names.
DIRTY_HEADERS = {
    "ID Raw": "id_raw",
    "Status (raw)": "status_raw",
    "Treat-Raw": "treat_raw",
    "Amount  raw": "amount_raw",
    "Date.raw": "date_raw",
    "Flag Raw!": "flag_raw",
    "Opt raw": "opt_raw",
    "Note Raw": "note_raw",
    "_c9": None,              # blank header: all null, dropped by the cleaning
}

DIRTY_TYPES = {
    "id_raw": "Int64",
    "status_raw": "object",
    "treat_raw": "object",
    "amount_raw": "float64",
    "date_raw": "datetime64[ns]",
    "flag_raw": "object",
    "opt_raw": "bool",
    "note_raw": "object",
    "response": "object",
}

DIRTY_SPEC = CleanSpec(
    column_types=DIRTY_TYPES,
    required=["id_raw", "status_raw", "treat_raw", "flag_raw"],
    id_column="id_raw",
    sentinel_column="treat_raw",
    sentinel_value="0",
    whitelist={"status_raw": ["F", "O"]},
    label_source="flag_raw",
    label_column="response",
    positive_code="R",
)

# Tables of the snapshot over the cleaned dirty view, with declared DDL.
DIRTY_TABLES = {
    "order_status": {
        "id_raw": "INTEGER NOT NULL PRIMARY KEY",
        "status_raw": "VARCHAR(1) NOT NULL",
        "treat_raw": "VARCHAR(8) NULL",
        "date_raw": "DATE NULL",
    },
    "order_amounts": {
        "id_raw": "INTEGER NOT NULL PRIMARY KEY",
        "amount_raw": "FLOAT NULL",
        "flag_raw": "VARCHAR(2) NOT NULL",
        "opt_raw": "BOOLEAN NULL",
        "response": "VARCHAR(3) NOT NULL",
    },
}


def _when_chain(pairs: list[tuple[Column, Column | str | None]], default: Column) -> Column:
    out = None
    for cond, val in pairs:
        v = F.lit(val) if not isinstance(val, Column) else val
        out = F.when(cond, v) if out is None else out.when(cond, v)
    return out.otherwise(default)


def dirty_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The all-text view with its awkward headers, before NA-token mapping."""
    o = read_parquet(spark, f"{sf_dir}/orders.parquet",
                     ["o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "o_orderdate"])
    k = F.col("o_orderkey")
    key = k.cast("string")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string")
    null = F.lit(None).cast("string")
    cols = {
        "ID Raw": _when_chain([(k % 67 == 0, (k + F.lit(9007199254740993)).cast("string")), (k % 50 == 0, F.concat(F.lit("x"), key)),
                               (k % 31 == 0, F.concat(key, F.lit(".0"))),
                               (k % 37 == 0, F.concat(key, F.lit(".5"))),
                               (k % 41 == 0, F.concat(F.lit(" "), key, F.lit(" ")))], key),
        "Status (raw)": _when_chain([(k % 11 == 0, "?"), (k % 13 == 0, " "), (k % 17 == 0, null),
                                     (k % 61 == 0, "\t")], F.col("o_orderstatus")),
        "Treat-Raw": _when_chain([(k % 7 == 0, "0"), (k % 43 == 0, " 0")], F.col("o_orderpriority")),
        "Amount  raw": _when_chain([(k % 19 == 0, "abc"), (k % 29 == 0, "NA"),
                                    (k % 10 == 5, F.concat(cents.substr(F.lit(1), F.lit(1)), F.lit(","), cents.substr(F.lit(2), F.length(cents)))),
                                    (k % 10 == 0, F.concat(cents.substr(F.lit(1), F.lit(1)), F.lit(";"), cents.substr(F.lit(2), F.length(cents))))],
                                   cents),
        "Date.raw": _when_chain([(k % 23 == 0, "n.d."), (k % 47 == 0, ""),
                                 *[((k % 6 == 1) & (F.floor(k / 6) % 13 == i), F.date_format("o_orderdate", f)) for i, (f, _) in enumerate(DATE_LAYOUTS)],
                                 (k % 3 == 0, F.date_format("o_orderdate", "MM/dd/yyyy"))],
                                F.date_format("o_orderdate", "yyyy-MM-dd")),
        "Flag Raw!": _when_chain([(k % 3 == 0, "R"), (k % 3 == 1, "NR")], F.lit("r")),
        "Opt raw": _when_chain([(k % 5 == 0, "Yes"), (k % 5 == 1, "true"), (k % 5 == 2, "1"),
                                (k % 5 == 3, "no")], F.lit("N/A")),
        "Note Raw": _when_chain([(k % 53 == 0, "ñ"), (k % 9 == 0, F.concat(F.lit("café "), F.col("o_orderpriority"))),
                                 (k % 59 == 0, "NULL")],
                                F.concat(F.col("o_orderstatus"), F.lit("@"), F.col("o_orderpriority"))),
        "_c9": null,
    }
    return o.select(*[v.alias(n) for n, v in cols.items()])


def dirty_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scan step: NA tokens → null, headers still awkward."""
    raw = dirty_raw(spark, sf_dir)
    return raw.select(*[na_to_null(F.col(f"`{c}`")).alias(c) for c in raw.columns])


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty view with normalised headers and the blank column dropped."""
    return normalize_headers(drop_unnamed(dirty_text(spark, sf_dir)))


# --- documents ⋈ labels -----------------------------------------------------

DOC_PREPARE = PrepareSpec(
    id_column="doc_id",
    category="lang",
    allowed=["en", "de", "fr"],
    min_count=10,
    outlier_columns=["n_chars", "n_words", "n_lines"],
    rel_error=0.0,
    label="response",
    numeric=["n_chars", "n_words", "n_lines"],
    alpha_desc="source",
)


def doc_measures(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, n_words, n_lines, source, lang`` over whole texts."""
    t = F.col("text")
    spaces = F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit("")))
    breaks = F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit("")))
    return docs.select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        (spaces + 1).cast("double").alias("n_words"),
        (breaks + 1).cast("double").alias("n_lines"),
        "source",
        "lang",
    )


def _doc_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doc_measures(read_parquet(spark, f"{sf_dir}/documents.parquet", ["doc_id", "text", "source", "lang", "n_chars"]))


def measured_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The measures of all documents as a table in the shared folder: the texts are read once, however often its rows are."""
    measures = _doc_measures(spark, sf_dir)
    path = scratch_path(spark, "measures")
    measures.write.parquet(path)
    return spark.read.schema(measures.schema).parquet(path)


def doc_frame(spark: SparkSession, sf_dir: str, measures: DataFrame | None = None) -> DataFrame:
    """Labelled documents as a model table (label ``response`` yes/no), from ``measures`` (:func:`measured_docs`) or else the texts themselves."""
    measures = _doc_measures(spark, sf_dir) if measures is None else measures
    labels = read_parquet(spark, f"{sf_dir}/labels.parquet", ["doc_id", "quality"])
    joined = measures.join(labels, "doc_id")
    return joined.select(*[c for c in joined.columns if c != "quality"],
                         F.when(F.col("quality") == 1, "yes").otherwise("no").alias("response"))
