"""Registered queries over the driver's tables, and their DuckDB twins.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE_SQL[name]``. Every
query reads whole tables (or data Spark derives from them); queries that
train or stream have no SQL twin.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge import functions as fn
from tabforge.operators import aggregates as agg
from tabforge.operators import columns as cols
from tabforge.operators import features as feat
from tabforge.operators import filters as flt
from tabforge.operators.category_index import category_index, indexed
from tabforge.operators.keys import repeated_keys
from tabforge.operators.metrics import weighted_metrics
from tabforge.plans import bindings as b
from tabforge.plans import oracle as o
from tabforge.plans.clean import clean
from tabforge.plans.prepare import prepare
from tabforge.plans.snapshot import constraint_report, key_violations, snapshot_null_counts, version_stamp, write_snapshot
from tabforge.session import scratch_path
from tabforge.sources.files import dataset_name as src_name
from tabforge.sources.files import read_parquet, read_text_table
from tabforge.sources.schema import declared_constraints

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

EXACT = 0.0    # exact quartiles, equal to percentile_disc


def register(name: str, sql: str | None = None):
    def deco(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return f
    return deco


def _t(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet", columns)


_DIRTY_SELECT = ", ".join(o.DIRTY_COLUMNS)

# --- scans -------------------------------------------------------------------


@register("na_tokens_to_null", f"WITH {o.dirty_cte()} SELECT {_DIRTY_SELECT} FROM dirty")
def na_tokens_to_null(spark, sf_dir):
    return b.dirty(spark, sf_dir)


@register("text_scan", f"WITH {o.dirty_cte()} SELECT {_DIRTY_SELECT} FROM dirty")
def text_scan(spark, sf_dir):
    """The dirty view written as CSV files whose columns stand in three different orders, and scanned."""
    raw = b.dirty_raw(spark, sf_dir).drop("_c9")
    names, paths = raw.columns, []
    for i in range(3):
        order = names[i * 3 :] + names[: i * 3]
        part = raw.where(F.pmod(F.xxhash64("ID Raw"), F.lit(3)) == i).select(*[f"`{c}`" for c in order])
        paths.append(scratch_path(spark, "text-scan"))
        part.write.option("header", "true").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(paths[-1])
    scan = read_text_table(spark, paths, header=names)
    return cols.normalize_headers(scan)


@register("parquet_scan", "SELECT * FROM lineitem")
def parquet_scan(spark, sf_dir):
    return _t(spark, sf_dir, "lineitem")


@register("dataset_name", "SELECT 'lineitem' AS dataset, count(*) AS rows FROM lineitem")
def dataset_name(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    named = li.select(src_name(F.col("_metadata.file_name")).alias("dataset"))
    return named.groupBy("dataset").agg(F.count(F.lit(1)).alias("rows"))


# --- projections -------------------------------------------------------------


@register("rename_normalized", """
SELECT c_custkey AS cust_key, c_name AS name, c_acctbal AS acct_bal_usd, c_mktsegment AS mkt_segment
FROM customer""")
def rename_normalized(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    awkward = c.select(F.col("c_custkey").alias("Cust Key#"), F.col("c_name").alias(" Name "),
                       F.col("c_acctbal").alias("Acct-Bal (USD)"), F.col("c_mktsegment").alias("MKT__Segment"),
                       F.col("c_nationkey").alias("_c4"))
    return cols.normalize_headers(cols.drop_unnamed(awkward))


@register("project_table", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders")
def project_table(spark, sf_dir):
    o_ = _t(spark, sf_dir, "orders")
    return cols.drop_columns(cols.project(o_, ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"]), "o_totalprice")


# --- row filters on the dirty view --------------------------------------------


@register("require_columns", f"""WITH {o.dirty_cte()}
SELECT {_DIRTY_SELECT} FROM dirty
WHERE id_raw IS NOT NULL AND status_raw IS NOT NULL AND amount_raw IS NOT NULL AND date_raw IS NOT NULL""")
def require_columns(spark, sf_dir):
    return flt.require_columns(b.dirty(spark, sf_dir), ["id_raw", "status_raw", "amount_raw", "date_raw"])


_ID_COLS = ", ".join(c for c in o.DIRTY_COLUMNS if c != "id_raw")


@register("numeric_id_filter", f"""WITH {o.dirty_cte()},
t AS (SELECT {o.lng('id_raw')} AS id_raw, {_ID_COLS} FROM dirty)
SELECT * FROM t WHERE id_raw IS NOT NULL""")
def numeric_id_filter(spark, sf_dir):
    return flt.numeric_id(b.dirty(spark, sf_dir), "id_raw")


@register("exclude_sentinel", f"""WITH {o.dirty_cte()}
SELECT {_DIRTY_SELECT} FROM dirty WHERE treat_raw IS DISTINCT FROM '0'""")
def exclude_sentinel(spark, sf_dir):
    return flt.exclude_value(b.dirty(spark, sf_dir), "treat_raw", "0")


@register("row_validity", f"""WITH {o.dirty_cte()}
SELECT {_DIRTY_SELECT} FROM dirty WHERE {' AND '.join(o.valid(c) for c in o.DIRTY_COLUMNS)}""")
def row_validity(spark, sf_dir):
    return flt.valid_rows(b.dirty(spark, sf_dir))


@register("drop_any_null", f"""WITH {o.dirty_cte()}
SELECT {_DIRTY_SELECT} FROM dirty WHERE {' AND '.join(f'{c} IS NOT NULL' for c in o.DIRTY_COLUMNS)}""")
def drop_any_null(spark, sf_dir):
    return flt.drop_any_null(b.dirty(spark, sf_dir))


# --- scalar functions --------------------------------------------------------


@register("ascii_fold", f"SELECT doc_id, {o.fold('text')} AS text FROM documents")
def ascii_fold(spark, sf_dir):
    d = _t(spark, sf_dir, "documents", ["doc_id", "text"])
    return d.select("doc_id", fn.ascii_fold("text").alias("text"))


@register("strip_symbols", f"SELECT doc_id, {o.strip('text')} AS text FROM documents")
def strip_symbols(spark, sf_dir):
    d = _t(spark, sf_dir, "documents", ["doc_id", "text"])
    return d.select("doc_id", fn.strip_symbols("text").alias("text"))


@register("whitelist_map", """
SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c_mktsegment END AS segment
FROM customer""")
def whitelist_map(spark, sf_dir):
    c = _t(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    return c.select("c_custkey", fn.whitelist("c_mktsegment", ["BUILDING", "MACHINERY"]).alias("segment"))


@register("map_with_default", f"""WITH {o.dirty_cte()}
SELECT id_raw, flag_raw, CASE WHEN flag_raw = 'R' THEN 'yes' ELSE 'no' END AS response FROM dirty""")
def map_with_default(spark, sf_dir):
    d = b.dirty(spark, sf_dir)
    return d.select("id_raw", "flag_raw", fn.map_with_default("flag_raw", {"R": "yes"}, "no").alias("response"))


@register("safe_double", f"""WITH {o.dirty_cte()}
SELECT id_raw, amount_raw, {o.dbl('amount_raw')} AS amount FROM dirty""")
def safe_double(spark, sf_dir):
    d = b.dirty(spark, sf_dir)
    return d.select("id_raw", "amount_raw", fn.safe_double("amount_raw").alias("amount"))


@register("safe_long", f"""WITH {o.dirty_cte()}
SELECT id_raw, {o.lng('id_raw')} AS id FROM dirty""")
def safe_long(spark, sf_dir):
    d = b.dirty(spark, sf_dir)
    return d.select("id_raw", fn.safe_long("id_raw").alias("id"))


@register("safe_timestamp", f"""WITH {o.dirty_cte()}
SELECT id_raw, date_raw, {o.ts('date_raw')} AS ts FROM dirty""")
def safe_timestamp(spark, sf_dir):
    d = b.dirty(spark, sf_dir)
    return d.select("id_raw", "date_raw", fn.safe_timestamp("date_raw").alias("ts"))


@register("safe_boolean", f"""WITH {o.dirty_cte()}
SELECT id_raw, opt_raw, {o.boolean('opt_raw')} AS opt FROM dirty""")
def safe_boolean(spark, sf_dir):
    d = b.dirty(spark, sf_dir)
    return d.select("id_raw", "opt_raw", fn.safe_boolean("opt_raw").alias("opt"))


@register("safe_string", "SELECT l_orderkey, l_linenumber, CAST(l_linenumber AS VARCHAR) AS line_text FROM lineitem")
def safe_string(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"])
    return li.select("l_orderkey", "l_linenumber", fn.safe_string("l_linenumber").alias("line_text"))


# --- the cleaning, the snapshot, reports ---------------------------------------

_CLEANED = "id_raw, status_raw, treat_raw, amount_raw, date_raw, flag_raw, opt_raw, note_raw, response"


@register("clean_full", f"WITH {o.clean_cte()} SELECT {_CLEANED} FROM cleaned")
def clean_full(spark, sf_dir):
    return clean(b.dirty_text(spark, sf_dir), b.DIRTY_SPEC)


def _snapshot_dirty(spark, sf_dir):
    typed = clean(b.dirty_text(spark, sf_dir), b.DIRTY_SPEC)
    return write_snapshot(typed, scratch_path(spark, "snapshots"), "dirty_orders", version_stamp(),
                          b.DIRTY_TABLES, b.DIRTY_TYPES)


@register("clean_snapshot", f"""WITH {o.clean_cte()}
SELECT id_raw, amount_raw, flag_raw, opt_raw, response FROM cleaned""")
def clean_snapshot(spark, sf_dir):
    paths = _snapshot_dirty(spark, sf_dir)
    return spark.read.parquet(paths["order_amounts"])


def _slot_sql(cte: str, tables: dict[str, dict[str, str]]) -> str:
    parts = []
    for t, schema in tables.items():
        for c in schema:
            parts.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) - count({c}) AS nulls FROM {cte}")
    return "\nUNION ALL\n".join(parts)


@register("clean_snapshot_status", f"""WITH {o.clean_cte()}
SELECT id_raw, status_raw, treat_raw, CAST(date_raw AS DATE) AS date_raw FROM cleaned""")
def clean_snapshot_status(spark, sf_dir):
    """The snapshot's other table."""
    return spark.read.parquet(_snapshot_dirty(spark, sf_dir)["order_status"]).withColumn("date_raw", F.to_date("date_raw"))


@register("snapshot_null_counts", f"WITH {o.clean_cte()}\n{_slot_sql('cleaned', b.DIRTY_TABLES)}")
def snapshot_null_counts_q(spark, sf_dir):
    return snapshot_null_counts(spark, _snapshot_dirty(spark, sf_dir), b.DIRTY_TABLES)


def _constraint_sql() -> str:
    parts = []
    for ck in declared_constraints(b.DIRTY_TABLES):
        t, c = ck["table"], ck["column"]
        if ck["not_null"]:
            parts.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, 'not_null' AS check_name, "
                         f"count(*) - count({c}) AS violations FROM cleaned")
        if ck["primary_key"]:
            parts.append(f"SELECT '{t}', '{c}', 'primary_key', count(*) - count(DISTINCT {c}) FROM cleaned")
        if ck["max_length"] is not None:
            parts.append(f"SELECT '{t}', '{c}', 'max_length_{ck['max_length']}', "
                         f"count(*) FILTER (WHERE length(CAST({c} AS VARCHAR)) > {ck['max_length']}) FROM cleaned")
    return "\nUNION ALL\n".join(parts)


@register("constraint_report", f"WITH {o.clean_cte()}\n{_constraint_sql()}")
def constraint_report_q(spark, sf_dir):
    return constraint_report(spark, _snapshot_dirty(spark, sf_dir), b.DIRTY_TABLES)


@register("key_violations", f"WITH {o.clean_cte()}\n" + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST({c} AS VARCHAR) AS key, count(*) AS rows FROM cleaned GROUP BY {c} HAVING count(*) > 1 OR {c} IS NULL"
    for t, c in [(ck["table"], ck["column"]) for ck in declared_constraints(b.DIRTY_TABLES) if ck["primary_key"]]))
def key_violations_q(spark, sf_dir):
    """The keys that break a declared PRIMARY KEY, with their rows."""
    return key_violations(spark, _snapshot_dirty(spark, sf_dir), b.DIRTY_TABLES)


@register("repeated_keys", "SELECT l_orderkey AS key, count(*) AS rows FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def repeated_keys_q(spark, sf_dir):
    """Every order key on more than one line: a key that most rows break."""
    return repeated_keys(_t(spark, sf_dir, "lineitem", ["l_orderkey"]), "l_orderkey")


@register("null_counts", f"WITH {o.dirty_cte()}\n" + "\nUNION ALL\n".join(
    f"SELECT 'dirty' AS table_name, '{c}' AS column_name, count(*) - count({c}) AS nulls FROM dirty"
    for c in o.DIRTY_COLUMNS))
def null_counts(spark, sf_dir):
    return agg.null_counts(b.dirty(spark, sf_dir), "dirty")


def _orders_snapshot(spark, sf_dir):
    types = {"o_orderkey": "Int64", "o_custkey": "Int64", "o_orderstatus": "object",
             "o_totalprice": "float64", "o_orderdate": "datetime64[ns]"}
    tables = {"order_head": {"o_orderkey": "INTEGER NOT NULL PRIMARY KEY", "o_custkey": "INTEGER",
                             "o_orderstatus": "VARCHAR(1)"},
              "order_money": {"o_orderkey": "INTEGER NOT NULL PRIMARY KEY", "o_totalprice": "FLOAT",
                              "o_orderdate": "DATE"}}
    return write_snapshot(_t(spark, sf_dir, "orders"), scratch_path(spark, "snapshots"), "orders", version_stamp(), tables, types)


@register("snapshot_round_trip", "SELECT o_orderkey, o_totalprice, o_orderdate FROM orders")
def snapshot_round_trip(spark, sf_dir):
    return spark.read.parquet(_orders_snapshot(spark, sf_dir)["order_money"])


@register("snapshot_round_trip_head", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def snapshot_round_trip_head(spark, sf_dir):
    return spark.read.parquet(_orders_snapshot(spark, sf_dir)["order_head"])


# --- preparation filters and aggregates -----------------------------------------


@register("allowed_values", "SELECT * FROM events WHERE event_type IN ('click', 'purchase', 'signup')")
def allowed_values(spark, sf_dir):
    return flt.allowed_values(_t(spark, sf_dir, "events"), "event_type", ["click", "purchase", "signup"])


@register("group_counts", "SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def group_counts(spark, sf_dir):
    return agg.group_counts(_t(spark, sf_dir, "events"), "event_type")


@register("min_group_size", """
SELECT * FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) > 10)""")
def min_group_size(spark, sf_dir):
    return flt.min_group_size(_t(spark, sf_dir, "orders"), "o_custkey", 10)


@register("quartiles", "SELECT quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3 FROM events")
def quartiles(spark, sf_dir):
    return agg.quartiles(_t(spark, sf_dir, "events"), "value", rel_error=EXACT)


@register("iqr_trim", f"WITH {o.iqr_step('events', 't1', 'value')} SELECT * FROM t1")
def iqr_trim(spark, sf_dir):
    return flt.iqr_trim(_t(spark, sf_dir, "events"), ["value"], rel_error=EXACT)


_LI_TRIM = "l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount"


@register("iqr_trim_sequential", f"""WITH li AS (SELECT {_LI_TRIM} FROM lineitem),
{o.iqr_step('li', 't1', 'l_quantity')},
{o.iqr_step('t1', 't2', 'l_extendedprice')},
{o.iqr_step('t2', 't3', 'l_discount')}
SELECT * FROM t3""")
def iqr_trim_sequential(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem", _LI_TRIM.split(", "))
    return flt.iqr_trim(li, ["l_quantity", "l_extendedprice", "l_discount"], rel_error=EXACT)


@register("iqr_trim_default")
def iqr_trim_default(spark, sf_dir):
    """The source's setting (relative error 0.05): approximate, no SQL twin."""
    return flt.iqr_trim(_t(spark, sf_dir, "events"), ["value"])


@register("prepare_features", f"""WITH {o.doc_frame_cte()},
a AS (SELECT n_chars, n_words, n_lines, source, lang, response FROM docf
      WHERE doc_id IS NOT NULL AND n_chars IS NOT NULL AND n_words IS NOT NULL AND n_lines IS NOT NULL
        AND source IS NOT NULL AND lang IS NOT NULL AND response IS NOT NULL AND lang IN ('en', 'de', 'fr')),
g AS (SELECT * FROM a WHERE lang IN (SELECT lang FROM a GROUP BY lang HAVING count(*) > 10)),
{o.iqr_step('g', 't1', 'n_chars')},
{o.iqr_step('t1', 't2', 'n_words')},
{o.iqr_step('t2', 't3', 'n_lines')}
SELECT n_chars, n_words, n_lines, source, lang,
  CAST(CASE WHEN lower(response) = 'yes' THEN 1 WHEN lower(response) = 'no' THEN 0 END AS INTEGER) AS response
FROM t3""")
def prepare_features(spark, sf_dir):
    return prepare(b.doc_frame(spark, sf_dir, b.measured_docs(spark, sf_dir)), b.DOC_PREPARE)


@register("category_report", f"""WITH {o.doc_frame_cte()},
a AS (SELECT * FROM docf WHERE lang IN ('en', 'de', 'fr')),
g AS (SELECT * FROM a WHERE lang IN (SELECT lang FROM a GROUP BY lang HAVING count(*) > 10)),
{o.iqr_step('g', 't1', 'n_chars')},
{o.iqr_step('t1', 't2', 'n_words')},
{o.iqr_step('t2', 't3', 'n_lines')}
SELECT lang, count(*) AS count FROM t3 GROUP BY lang""")
def category_report(spark, sf_dir):
    return agg.group_counts(prepare(b.doc_frame(spark, sf_dir, b.measured_docs(spark, sf_dir)), b.DOC_PREPARE), "lang")


# --- labels ------------------------------------------------------------------------


@register("encode_label", """
SELECT l_orderkey, l_linenumber,
  CAST(CASE WHEN lower(txt) = 'yes' THEN 1 WHEN lower(txt) = 'no' THEN 0 END AS INTEGER) AS label
FROM (SELECT l_orderkey, l_linenumber,
        CASE l_returnflag WHEN 'R' THEN 'Yes' WHEN 'A' THEN 'no' ELSE 'unknown' END AS txt FROM lineitem)""")
def encode_label(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_returnflag"])
    txt = fn.map_with_default("l_returnflag", {"R": "Yes", "A": "no"}, "unknown")
    return li.select("l_orderkey", "l_linenumber", fn.encode_label(txt).alias("label"))


@register("decode_label", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 25 THEN 'Yes' ELSE 'No' END AS response FROM lineitem""")
def decode_label(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity"])
    pred = F.when(F.col("l_quantity") > 25, 1.0).otherwise(0.0)
    return li.select("l_orderkey", "l_linenumber", fn.decode_label(pred).alias("response"))


# --- feature stages -------------------------------------------------------------------


@register("index_alpha_desc", """
SELECT c_custkey, c_mktsegment,
  CAST(dense_rank() OVER (ORDER BY c_mktsegment DESC) - 1 AS DOUBLE) AS c_mktsegment_index
FROM customer""")
def index_alpha_desc(spark, sf_dir):
    c = _t(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    return indexed(c, "c_mktsegment", category_index(c, "c_mktsegment", "alphabet_desc"))


_FREQ_RANK = """ranked AS (SELECT event_type, CAST(row_number() OVER (ORDER BY n DESC, event_type) - 1 AS DOUBLE) AS idx
  FROM (SELECT event_type, count(*) AS n FROM events GROUP BY event_type))"""


@register("index_freq_desc", f"""WITH {_FREQ_RANK}
SELECT e.event_id, e.event_type, r.idx AS event_type_index FROM events e JOIN ranked r USING (event_type)""")
def index_freq_desc(spark, sf_dir):
    e = _t(spark, sf_dir, "events", ["event_id", "event_type"])
    return indexed(e, "event_type", category_index(e, "event_type", "frequency_desc"))


@register("one_hot", f"""WITH {_FREQ_RANK}
SELECT e.event_id, e.event_type,
""" + ",\n".join(f"  CAST(CASE WHEN r.idx = {i} THEN 1 ELSE 0 END AS DOUBLE) AS slot_{i}" for i in range(5)) + """
FROM events e JOIN ranked r USING (event_type)""")
def one_hot(spark, sf_dir):
    e = _t(spark, sf_dir, "events", ["event_id", "event_type"])
    model = Pipeline(stages=[feat.freq_indexer("event_type"), feat.one_hot("event_type")]).fit(e)
    size = len(model.stages[0].labelsArray[0])
    out = model.transform(e).drop("event_type_index")
    return feat.vector_columns(out, "event_type_vec", size, "slot")


_ASSEMBLE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("assemble", "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"{c} AS f_{i}" for i, c in enumerate(_ASSEMBLE_COLS)) + " FROM lineitem")
def assemble(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", *_ASSEMBLE_COLS])
    out = feat.assembler(_ASSEMBLE_COLS, []).transform(li).select("l_orderkey", "l_linenumber", "features")
    return feat.vector_columns(out, "features", len(_ASSEMBLE_COLS), "f")


@register("min_max_scale", "WITH m AS (SELECT " + ", ".join(
    f"min({c}) AS lo{i}, max({c}) AS hi{i}" for i, c in enumerate(_ASSEMBLE_COLS)) +
    " FROM lineitem)\nSELECT l_orderkey, l_linenumber, " + ", ".join(
    f"CASE WHEN hi{i} = lo{i} THEN 0.5 ELSE ({c} - lo{i}) * (1.0 / (hi{i} - lo{i})) END AS s_{i}"
    for i, c in enumerate(_ASSEMBLE_COLS)) + " FROM lineitem, m")
def min_max_scale(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", *_ASSEMBLE_COLS])
    assembled = feat.assembler(_ASSEMBLE_COLS, []).transform(li)
    scaled = feat.min_max("features", "scaled").fit(assembled).transform(assembled)
    out = scaled.select("l_orderkey", "l_linenumber", "scaled")
    return feat.vector_columns(out, "scaled", len(_ASSEMBLE_COLS), "s")


# --- metrics, selection, registry --------------------------------------------------------


@register("weighted_metrics", """
WITH pr AS (SELECT CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS DOUBLE) AS y,
                   CAST(CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS DOUBLE) AS p FROM lineitem),
pairs AS (SELECT y, p, count(*) AS n FROM pr GROUP BY y, p),
ys AS (SELECT y, sum(n) AS n_y, sum(CASE WHEN y = p THEN n ELSE 0 END) AS tp FROM pairs GROUP BY y),
ps AS (SELECT p AS y, sum(n) AS n_p FROM pairs GROUP BY p),
per AS (SELECT coalesce(ys.n_y, 0) AS n_y, coalesce(ys.tp, 0) AS tp, coalesce(ps.n_p, 0) AS n_p
        FROM ys FULL OUTER JOIN ps ON ys.y = ps.y),
per2 AS (SELECT *, CASE WHEN n_p > 0 THEN tp / n_p ELSE 0.0 END AS prec,
                   CASE WHEN n_y > 0 THEN tp / n_y ELSE 0.0 END AS rec FROM per),
per3 AS (SELECT *, CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END AS f1c FROM per2)
SELECT sum(f1c * n_y) / sum(n_y) AS f1, sum(prec * n_y) / sum(n_y) AS weighted_precision,
       sum(rec * n_y) / sum(n_y) AS weighted_recall, sum(tp) / sum(n_y) AS accuracy,
       CAST(sum(n_y) AS BIGINT) AS rows
FROM per3""")
def weighted_metrics_q(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem", ["l_returnflag", "l_quantity"])
    pred = li.select(F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("label"),
                     F.when(F.col("l_quantity") > 25, 1.0).otherwise(0.0).alias("prediction"))
    return weighted_metrics(pred, "label", "prediction")


@register("best_candidate", """
SELECT event_type, value, event_id FROM (
  SELECT event_type, value, event_id,
         row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS rn FROM events)
WHERE rn = 1""")
def best_candidate(spark, sf_dir):
    return agg.best_per_group(_t(spark, sf_dir, "events"), ["event_type"], "value", "event_id")


@register("latest_run", """
SELECT event_type, ts, event_id FROM (
  SELECT event_type, ts, event_id,
         row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""")
def latest_run(spark, sf_dir):
    return agg.latest_per_group(_t(spark, sf_dir, "events"), ["event_type"], "ts", "event_id")


@register("version_number", """
SELECT c.c_custkey, CAST(coalesce(r.v, 0) + 1 AS BIGINT) AS next_version
FROM customer c LEFT JOIN (SELECT o_custkey, max(o_orderkey) AS v FROM orders GROUP BY o_custkey) r
  ON c.c_custkey = r.o_custkey""")
def version_number(spark, sf_dir):
    registry = _t(spark, sf_dir, "orders", ["o_custkey", "o_orderkey"]).select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("version"))
    return agg.next_versions(_t(spark, sf_dir, "customer", ["c_custkey"]), registry, "c_custkey")


# --- training, tracking, scoring -------------------------------------------

from tabforge.plans import ml_queries as _ml  # noqa: E402  (registers the ML queries)

QUERIES.update(_ml.QUERIES | _ml.TRACKING_QUERIES)
ORACLE_SQL.update({k: v.strip() for k, v in _ml.ORACLE_SQL.items()})
