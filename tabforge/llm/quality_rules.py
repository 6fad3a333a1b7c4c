"""Quality rules whose thresholds adapt to language and source.

Each text's signals are computed in its row. Every (lang, source) keeps, per
signal, a quantile sketch of logarithmic buckets: counts per bucket add up, so
sketches of partitions merge without loss, and a quantile is right to one
bucket's width. Upper fences read from the sketches replace fixed cutoffs, and
the rows are joined with their group's fences and judged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tabforge.llm.common import bind, table, text_of, words, written

#: Signals judged against an adaptive fence, each so many of one count per 1000 of another, with the slack
#: that a fence leaves above its quantiles (a group whose texts are all alike has no spread of its own).
SIGNALS = {"symbols": ("n_symbols", "n_words", 200), "dup_lines": ("n_dup_lines", "n_lines", 500),
           "repeats": ("n_repeat_words", "n_words", 400), "word_length": ("word_chars", "n_words", 2000)}
#: Bucket 0 of a sketch holds rates of zero, bucket 1 those up to 1, bucket i > 1 those whose BASE * ln rounds to i - 1.
BASE = 16
#: A fence lies REACH times the spread between the quantiles LOW and HIGH above HIGH.
LOW, HIGH, REACH = 0.25, 0.75, 3.0
#: Groups with fewer rows read the merged sketch of their language, then that of all rows.
MIN_ROWS = 50


def repeated_words(w: Column) -> Column:
    """Words covered by three-word windows that occur twice or more.

    Windows are hashed. Their distinct count shows at once whether any repeats;
    only then are the sorted (hash, position) pairs looked through for equal
    neighbours, and the union of the windows found is measured.
    """
    n = F.size(w)
    hashed = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def covered(h: Column) -> Column:
        return bind(F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), union)

    def union(p: Column) -> Column:
        twin = lambda x, k: x["h"].eqNullSafe(F.get(p, k - 1)["h"]) | x["h"].eqNullSafe(F.get(p, k + 1)["h"])  # noqa: E731
        starts = F.array_sort(F.transform(F.filter(p, twin), lambda x: x["i"]))
        step = lambda acc, i: F.struct((acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"), i.alias("last"))  # noqa: E731
        return F.aggregate(starts, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")), step, lambda acc: acc["n"])

    some = bind(hashed, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0)))
    return F.when(n < 3, F.lit(0)).otherwise(some)


def signals(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, lang, source, text) without the text but with its counts, all long, and base_failed."""
    text = text_of("text")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    by_word = bind(words(text), lambda w: F.struct(
        F.size(w).alias("n"), F.length(F.array_join(w, "")).alias("chars"), repeated_words(w).alias("repeats")))
    by_line = bind(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dups")))
    out = docs.select("doc_id", "lang", "source", by_word.alias("w"), by_line.alias("l"), F.regexp_count(text, F.lit("[#*$%&|<>]")).alias("symbols"))
    out = out.select("doc_id", "lang", "source", *[c.cast("long").alias(k) for k, c in {
        "n_words": F.col("w.n"), "word_chars": F.col("w.chars"), "n_symbols": F.col("symbols"), "n_dup_lines": F.col("l.dups"),
        "n_repeat_words": F.col("w.repeats"), "n_lines": F.col("l.n")}.items()])
    return out.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def rate(name: str) -> Column:
    part, whole, _ = SIGNALS[name]
    return F.when(F.col(whole) > 0, F.col(part) * 1000.0 / F.col(whole)).otherwise(0.0)


def sketches(rows: DataFrame) -> DataFrame:
    """(lang, source, signal, bucket, n): the sketch of every group, one row for each bucket in use."""
    def bucket(r: Column) -> Column:
        return F.when(r <= 0, 0).otherwise(1 + F.greatest(F.lit(0), F.round(F.log(r) * BASE))).cast("int")

    each = F.explode(F.array(*[F.struct(F.lit(k).alias("signal"), bucket(rate(k)).alias("bucket")) for k in SIGNALS]))
    return rows.select("lang", "source", each.alias("x")).groupBy("lang", "source", "x.signal", "x.bucket").agg(F.count(F.lit(1)).alias("n"))


def fences(sketch: DataFrame) -> DataFrame:
    """(lang, source, one column per signal): the highest rate that a group's rows may have.

    Works on sketches only, whose size goes with the number of groups. Sketches
    of a language, and of everything, are sums of their groups' sketches.
    """
    groups = sketch.select("lang", "source").distinct()
    levels = []
    for depth, keys in enumerate((["lang", "source"], ["lang"], [])):
        merged = sketch.groupBy(*keys, "signal", "bucket").agg(F.sum("n").alias("n"))
        per = W.partitionBy(*keys, "signal")
        merged = merged.withColumn("rows", F.sum("n").over(per)).withColumn("upto", F.sum("n").over(per.orderBy("bucket")))
        value = F.when(F.col("bucket") == 0, 0.0).otherwise(F.exp((F.col("bucket") - 1) / float(BASE)))
        at = lambda q: F.min(F.when(F.col("upto") >= q * F.col("rows"), value))  # noqa: E731, B023
        read = merged.groupBy(*keys, "signal").agg(F.max("rows").alias("rows"), at(LOW).alias("low"), at(HIGH).alias("high"))
        if depth < 2:
            read = read.where(F.col("rows") >= MIN_ROWS)
        read = read.withColumnsRenamed({k: f"_{k}" for k in keys})
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
        if keys:
            levels.append(groups.join(read, same).drop(*[f"_{k}" for k in keys]).withColumn("depth", F.lit(depth)))
        else:  # one row per signal
            levels.append(groups.withColumn("signal", F.explode(F.array(*[F.lit(k) for k in SIGNALS]))).join(read, "signal").withColumn("depth", F.lit(depth)))
    every = levels[0].unionByName(levels[1]).unionByName(levels[2])
    slack = F.create_map(*[x for k, v in SIGNALS.items() for x in (F.lit(k), F.lit(float(v[2])))])
    best = every.groupBy("lang", "source", "signal").agg(F.min_by(F.struct("low", "high"), "depth").alias("q"))
    fence = F.col("q.high") + REACH * (F.col("q.high") - F.col("q.low")) + slack[F.col("signal")]
    return best.groupBy("lang", "source").pivot("signal", list(SIGNALS)).agg(F.first(F.round(fence, 3)))


def judge(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang, source): its counts, base_failed, failed_rules and kept.

    Null texts are empty and fail the base rules, as all texts of under 50 words
    do. Null languages and sources are groups like others. Rows that fail the
    base rules don't count in the sketches. Repeated rows are judged alike.
    """
    rows = written(signals(docs), "rule-signals")
    sketch = written(sketches(rows.where(~F.col("base_failed"))), "rule-sketches")
    limits = written(fences(sketch), "rule-fences").withColumnsRenamed({"lang": "_lang", "source": "_source"} | {k: f"max_{k}" for k in SIGNALS})
    joined = rows.join(limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    over = F.filter(F.array(*[F.when(rate(k) > F.col(f"max_{k}"), F.lit(k)) for k in SIGNALS]), lambda x: x.isNotNull())
    joined = joined.withColumn("failed_rules", F.when(F.col("base_failed"), F.array().cast("array<string>")).otherwise(over))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         F.array_join("failed_rules", ",").alias("failed_rules"), (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))


def _sql() -> str:
    bucket = lambda k: f"CASE WHEN {k} <= 0 THEN 0 ELSE 1 + greatest(0, CAST(round(ln({k}) * {BASE}) AS INT)) END"  # noqa: E731
    long = " UNION ALL ".join(f"SELECT lang, source, '{k}' AS signal, {bucket(k)} AS bucket FROM r WHERE NOT base_failed" for k in SIGNALS)
    value = f"CASE WHEN bucket = 0 THEN 0.0::DOUBLE ELSE exp((bucket - 1) / CAST({BASE} AS DOUBLE)) END"
    read = []
    for depth, keys in enumerate(("lang, source, ", "lang, ", "")):
        read.append(f"""h{depth} AS (SELECT {keys}signal, bucket, count(*) AS n FROM x GROUP BY ALL),
c{depth} AS (SELECT *, sum(n) OVER (PARTITION BY {keys}signal) AS rows, sum(n) OVER (PARTITION BY {keys}signal ORDER BY bucket) AS upto FROM h{depth}),
f{depth} AS (SELECT {keys}signal, min({value}) FILTER (upto >= CAST({LOW} AS DOUBLE) * rows) AS low, min({value}) FILTER (upto >= CAST({HIGH} AS DOUBLE) * rows) AS high
      FROM c{depth} GROUP BY {keys}signal HAVING max(rows) >= {MIN_ROWS if depth < 2 else 0})""")
    joins = "LEFT JOIN f0 ON f0.lang IS NOT DISTINCT FROM g.lang AND f0.source IS NOT DISTINCT FROM g.source AND f0.signal = s.signal LEFT JOIN f1 ON f1.lang IS NOT DISTINCT FROM g.lang AND f1.signal = s.signal LEFT JOIN f2 ON f2.signal = s.signal"
    slack = "CASE s.signal " + " ".join(f"WHEN '{k}' THEN {v[2]}" for k, v in SIGNALS.items()) + " END"
    low, high = (f"coalesce(f0.{q}, f1.{q}, f2.{q})" for q in ("low", "high"))
    fence = " ".join(f", max(round({high} + CAST({REACH} AS DOUBLE) * ({high} - {low}) + {slack}, 3)) FILTER (s.signal = '{k}') AS max_{k}" for k in SIGNALS)
    rates = ", ".join(f"CASE WHEN {v[1]} > 0 THEN {v[0]} * 1000.0::DOUBLE / {v[1]} ELSE 0.0 END AS {k}" for k, v in SIGNALS.items())
    failed = "concat_ws(',', " + ", ".join(f"CASE WHEN {k} > max_{k} THEN '{k}' END" for k in SIGNALS) + ")"
    return rf"""
WITH a AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^ 	-]+') AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda s: regexp_matches(s, '[^ 	-]')) AS l FROM documents),
v AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM a),
o AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM v),
p AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS k FROM o WHERE n > 1) GROUP BY doc_id),
b AS (SELECT a.doc_id, lang, source, len(w) AS n_words, len(array_to_string(w, '')) AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
             len(l) - len(list_distinct(l)) AS n_dup_lines, len(l) AS n_lines, coalesce(p.n, 0) AS n_repeat_words FROM a LEFT JOIN p USING (doc_id)),
r AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {rates} FROM b),
x AS ({long}),
{", ".join(read)},
z AS (SELECT g.lang, g.source{fence} FROM (SELECT DISTINCT lang, source FROM x) g CROSS JOIN (SELECT DISTINCT signal FROM x) s {joins} GROUP BY g.lang, g.source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, CASE WHEN base_failed THEN '' ELSE {failed} END AS failed_rules,
       NOT base_failed AND {failed} = '' AS kept
FROM r LEFT JOIN z ON r.lang IS NOT DISTINCT FROM z.lang AND r.source IS NOT DISTINCT FROM z.source"""


OP8_SQL = _sql()
