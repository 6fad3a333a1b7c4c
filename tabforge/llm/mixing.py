"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

A source's documents are dealt into blocks. Its target decides, to the word, how
many blocks its permuted list of blocks contributes (a second pass through the
list where the target exceeds the source). The exact block quotas of all sources
are split among the output shards by a binary tree whose every node draws the
left half's counts from a multivariate hypergeometric law, so shards differ only
by chance and quotas add up exactly. A shard takes the next blocks of each
source's permuted list and shuffles its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tabforge.llm.common import bind, draw, table, text_of, words, written

#: Weights of the sources in code-point order (null last), repeating.
WEIGHTS = (5, 2, 1)
#: Rows of a block. Beyond MAX_BLOCKS blocks a source's blocks hold more rows instead, so that neither a
#: source's list of blocks nor the rows of a block outgrow one task.
BLOCK_DOCS, MAX_BLOCKS = 64, 1 << 20
SHARD_WORDS = 20_000_000


def targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``sizes`` (source, source_size, any more) with ``target``: shares by weight, none above ``most`` times its size.

    With sources ordered by size per weight those that stop at their cap come
    first, so the water level over the rest is a running sum. One row per source.
    """
    n = len(weights)
    by_name = W.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(n)) + 1).cast("int"))
    s = sizes.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    everything = W.partitionBy()
    in_order = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source").rowsBetween(W.unboundedPreceding, -1)
    budget = share * F.sum("source_size").over(everything)
    before = F.coalesce(F.sum("cap").over(in_order), F.lit(0.0))
    heavier = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(in_order), F.lit(0.0))
    s = s.withColumn("level", (budget - before) / heavier)
    open_level = F.max(F.when(F.col("level") * F.col("weight") < F.col("cap"), F.col("level"))).over(everything)
    return s.withColumn("target", F.round(F.least("cap", F.coalesce(open_level * F.col("weight"), F.col("cap"))), 3)).select(*sizes.columns, "target")


def _ln_gamma(x: Column) -> Column:
    """log gamma for x >= 1 (Stirling's series from x + 6)."""
    y = x + 6
    shift = F.log(x * (x + 1) * (x + 2)) + F.log((x + 3) * (x + 4) * (x + 5))
    return (y - 0.5) * F.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y * y * y) - shift


def _ln_choose(n: Column, k: Column) -> Column:
    return _ln_gamma(n + 1) - _ln_gamma(k + 1) - _ln_gamma(n - k + 1)


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of ``drawn`` out of ``total`` are among the ``marked``: the count at which the distribution passes ``u``.

    Inverts the distribution within ten standard deviations of the mean and
    within the support; what lies beyond has a probability under 1e-20.
    """
    given = F.struct(*[c.cast("double").alias(k) for k, c in {"total": total, "marked": marked, "drawn": drawn, "u": u}.items()])

    def moments(g: Column) -> Column:
        mean = F.when(g["total"] > 0, g["drawn"] * g["marked"] / g["total"]).otherwise(0.0)
        left = mean * (1 - g["marked"] / g["total"]) * (g["total"] - g["drawn"]) / (g["total"] - 1)
        spread = F.when(g["total"] > 1, F.sqrt(F.greatest(F.lit(0.0), left))).otherwise(0.0)
        whole = _ln_choose(g["total"], g["drawn"])
        return bind(F.struct(g.alias("g"), mean.alias("mean"), spread.alias("spread"), whole.alias("whole")), invert)

    def invert(m: Column) -> Column:
        g = m["g"]
        low = F.greatest(F.lit(0.0), g["drawn"] + g["marked"] - g["total"], F.floor(m["mean"] - 10 * m["spread"] - 1).cast("double"))
        high = F.least(g["drawn"], g["marked"], F.ceil(m["mean"] + 10 * m["spread"] + 1).cast("double"))

        def step(acc: Column, k: Column) -> Column:
            p = F.exp(_ln_choose(g["marked"], k) + _ln_choose(g["total"] - g["marked"], g["drawn"] - k) - m["whole"])
            return bind(acc["cdf"] + p, lambda cdf: F.struct(cdf.alias("cdf"), F.when((acc["at"] < 0) & (cdf >= g["u"]), k).otherwise(acc["at"]).alias("at")))

        start = F.struct(F.lit(0.0).alias("cdf"), F.lit(-1.0).alias("at"))
        support = F.transform(F.sequence(low.cast("long"), high.cast("long")), lambda k: k.cast("double"))
        return F.aggregate(support, start, step, lambda acc: F.when(acc["at"] < 0, high).otherwise(acc["at"]))

    return bind(given, moments).cast("long")


def split_quotas(quotas: DataFrame, shards: int, seed: str) -> DataFrame:
    """Rows (source, shard, first, last) from ``quotas`` (source, quota): block positions first <= p < last go to the shard.

    A node of the tree holds a range of shards and one quota for each source.
    Its left half has slots in proportion to its shards; the sources draw their
    part of these slots one after the other, each from what the ones before
    left, which is the multivariate hypergeometric law. Each level is one more
    expression over nodes; a node is as large as the number of sources.
    """
    root = quotas.agg(F.sort_array(F.collect_list(F.struct(F.col("source").isNull().alias("none"), "source", "quota"))).alias("q"))
    nodes = root.where(F.size("q") > 0).select(
        F.transform("q", lambda x: x["source"]).alias("names"), F.transform("q", lambda x: x["quota"]).alias("q"),
        F.lit(0).cast("long").alias("lo"), F.lit(shards).cast("long").alias("hi"))
    for _ in range(max(0, (shards - 1).bit_length())):
        middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("long")
        total = F.aggregate("q", F.lit(0).cast("long"), lambda a, x: a + x)
        want = F.floor(total * (middle - F.col("lo")) / (F.col("hi") - F.col("lo"))).cast("long")
        nodes = nodes.withColumns({"mid": middle, "total": total, "want": want})

        def one(acc: Column, i: Column) -> Column:
            marked = F.get(F.col("q"), i)
            u = (draw(seed, F.col("lo"), F.col("hi"), i).cast("double") + 0.5) / 2**32
            got = hypergeometric(acc["total"], marked, acc["want"], u)
            return bind(got, lambda n: F.struct((acc["total"] - marked).alias("total"), (acc["want"] - n).alias("want"), F.concat(acc["got"], F.array(n)).alias("got")))

        start = F.struct(F.col("total").alias("total"), F.col("want").alias("want"), F.array().cast("array<bigint>").alias("got"))
        left = F.aggregate(F.sequence(F.lit(0), F.size("q") - 1), start, one, lambda a: a["got"])
        nodes = nodes.withColumn("left", F.when(F.col("hi") - F.col("lo") > 1, left).otherwise(F.col("q")))
        sides = F.when(F.col("hi") - F.col("lo") > 1, F.array(
            F.struct(F.col("lo").alias("lo"), F.col("mid").alias("hi"), F.col("left").alias("q")),
            F.struct(F.col("mid").alias("lo"), F.col("hi").alias("hi"), F.zip_with("q", "left", lambda a, b: a - b).alias("q")),
        )).otherwise(F.array(F.struct("lo", "hi", "q")))
        nodes = nodes.select("names", F.explode(sides).alias("s")).select("names", "s.lo", "s.hi", "s.q")
    flat = nodes.select(F.col("lo").alias("shard"), F.explode(F.arrays_zip("names", "q")).alias("x")).select("shard", F.col("x.names").alias("source"), F.col("x.q").alias("n"))
    last = F.sum("n").over(W.partitionBy("source").orderBy("shard"))
    return flat.select("source", "shard", (last - F.col("n")).alias("first"), last.alias("last"))


def mix(docs: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS, seed: str = "mix", table_options: dict[str, str] | None = None) -> DataFrame:
    """What the mix takes of each row of ``docs`` (doc_id, source, size, and any column ``in``, which stays).

    Adds source_size, target, taken (words) and draws: a list of (shard, place,
    words), one for each time the row is drawn; sorting a shard by place shuffles
    it. The row where a source's target ends gives only part of its words. Null
    or zero sizes take nothing. Rows that repeat are drawn independently but for
    their order, which is by doc_id and size. The result depends on the rows and
    the seed only, not on partitions. ``table_options`` are for the writer of
    the table that holds the rows meanwhile.
    """
    src = F.col("source")
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    sizes = written(targets(sizes, share, most, weights), "mix-sources")

    # Blocks in permuted order, with the words before each of them.
    per_source = sizes.select(src.alias("s_name"), "docs", "source_size", "target")
    block = F.pmod(draw(seed + "-block", F.col("doc_id")), F.least(F.ceil(F.col("docs") / BLOCK_DOCS), F.lit(MAX_BLOCKS)))
    dealt = written(docs.join(per_source, src.eqNullSafe(F.col("s_name"))).withColumn("block", block).drop("s_name", "docs"), "mix-dealt", **(table_options or {}))
    blocks = dealt.groupBy("source", "block", "source_size", "target").agg(F.sum("size").alias("words"))
    permuted = W.partitionBy("source").orderBy(draw(seed + "-order", src, F.col("block")), "block")
    blocks = blocks.withColumn("before", F.sum("words").over(permuted) - F.col("words")).withColumn("position", F.row_number().over(permuted) - 1)
    goal_words = F.round("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(goal_words / F.col("source_size"))).otherwise(0).cast("long")  # full passes
    extra = goal_words - whole * F.col("source_size")
    blocks = written(blocks.withColumns({"whole": whole, "extra": extra}).drop("source_size", "target"), "mix-blocks")

    # Each source's quota of blocks, split among the shards.
    again = (F.col("extra") > F.col("before")) & (F.col("words") > 0)
    quota = blocks.groupBy("source").agg(F.sum(F.col("whole") + again.cast("long")).alias("quota"), F.count(F.lit(1)).alias("n_blocks"))
    total = quota.join(sizes.select(src.alias("s_name"), "target"), src.eqNullSafe(F.col("s_name"))).agg(F.sum("target")).first()[0] or 0.0
    shards = max(1, round(total / SHARD_WORDS))
    ranges = split_quotas(quota.select("source", "quota"), shards, seed)
    passes = F.sequence(F.lit(1), (F.col("whole") + again.cast("long")).cast("int"))
    turns = blocks.where(F.col("whole") + again.cast("long") > 0).select("source", "block", "position", F.explode(passes).alias("turn"))
    turns = turns.join(quota.select(F.col("source").alias("s_name"), "n_blocks"), src.eqNullSafe(F.col("s_name"))).withColumn(
        "p", (F.col("turn") - 1) * F.col("n_blocks") + F.col("position")).drop("s_name")
    places = ranges.where(F.col("first") < F.col("last")).select(
        F.col("source").alias("s_name"), "shard", F.explode(F.sequence("first", F.col("last") - 1)).alias("at"))
    turns = turns.join(places, src.eqNullSafe(F.col("s_name")) & (F.col("p") == F.col("at")))
    plan = turns.groupBy(F.col("source").alias("s_name"), F.col("block").alias("at")).agg(F.sort_array(F.collect_list(F.struct("turn", "shard"))).alias("turns"))
    plan = blocks.join(plan, src.eqNullSafe(F.col("s_name")) & (F.col("block") == F.col("at")), "left").drop("s_name", "at")

    # Only the block where the target ends looks at its rows' order.
    plan = plan.select(F.col("source").alias("b_name"), F.col("block").alias("b"), "before", "words", "whole", "extra", "turns")
    rows = dealt.join(plan, src.eqNullSafe(F.col("b_name")) & (F.col("block") == F.col("b"))).drop("b_name", "b")
    cut = (F.col("extra") > F.col("before")) & (F.col("extra") < F.col("before") + F.col("words"))
    in_block = W.partitionBy("source", "block").orderBy(draw(seed + "-row", F.col("doc_id")), "doc_id", "size")
    part = F.greatest(F.lit(0), F.least("size", F.col("extra") - F.col("before") - (F.sum("size").over(in_block) - F.col("size"))))
    ending = rows.where(cut).withColumn("more", part)
    others = rows.where(~cut).withColumn("more", F.when(F.col("extra") > F.col("before"), F.col("size")).otherwise(0).cast("long"))
    rows = others.unionByName(ending)
    given = F.transform(F.coalesce("turns", F.array().cast("array<struct<turn:int,shard:bigint>>")), lambda t: F.struct(
        t["shard"].alias("shard"), draw(seed + "-place", F.col("doc_id"), t["turn"]).alias("place"),
        F.when(t["turn"] <= F.col("whole"), F.col("size")).otherwise(F.col("more")).alias("words")))
    return rows.withColumn("draws", F.filter(given, lambda d: d["words"] > 0)).withColumn(
        "taken", F.col("whole") * F.col("size") + F.col("more")).drop("block", "before", "words", "whole", "extra", "turns", "more")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row once for every draw, shuffled within its shard.

    A row that gives only part of its words has its text cut after them (words
    joined by one space), and n_chars, if there, set to what is left. Further
    columns stay, whatever their names.
    """
    size = F.size(words(text_of("text"))).cast("long")
    drawn = mix(docs.select("doc_id", "source", size.alias("size"), F.struct("*").alias("in")), table_options={"compression": "zstd"}, **options).withColumn("d", F.explode("draws"))
    cut = F.col("d.words") < F.col("size")
    text = F.when(cut, F.array_join(F.slice(words(text_of("in.text")), F.lit(1), F.col("d.words").cast("int")), " ")).otherwise(F.col("in.text"))
    drawn = drawn.select("in", "doc_id", "d", text.alias("text"), cut.alias("cut")).repartition("d.shard").sortWithinPartitions("d.shard", "d.place", "doc_id")
    columns = {c: F.col("in").getField(c) for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("cut"), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(columns["n_chars"])
    return drawn.select(*[c.alias(k) for k, c in columns.items()])


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", "source", F.size(words(text_of("text"))).cast("long").alias("size"))
    out = mix(sized)
    return out.select("doc_id", "source", "size", "source_size", "target", "taken", F.size("draws").alias("times"))


def _draw_sql(seed: str, *parts: str) -> str:
    made = ", ".join(f"coalesce(CAST({p} AS VARCHAR), '-')" for p in parts)
    return f"CAST('0x' || substr(md5(concat_ws('/', '{seed}', {made})), 1, 8) AS BIGINT)"


OP7_SQL = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS docs FROM d GROUP BY source),
w AS (SELECT *, CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3] AS DOUBLE) AS weight, 2.0::DOUBLE * source_size AS cap FROM s),
l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER o, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS level
      FROM w WINDOW o AS (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT source, source_size, docs, round(least(cap, coalesce(max(level) FILTER (level * weight < cap) OVER () * weight, cap)), 3) AS target FROM l),
q AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // source_size ELSE 0 END AS whole FROM g),
b AS (SELECT d.*, source_size, target, whole, CAST(round(target) AS BIGINT) - whole * source_size AS extra,
             {_draw_sql("mix-block", "doc_id")} % least(CAST(ceil(docs / 64) AS BIGINT), 1048576) AS block
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
k AS (SELECT source, block, sum(size) AS words FROM b GROUP BY ALL),
c AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY {_draw_sql("mix-order", "source", "block")}, block ROWS UNBOUNDED PRECEDING) - words AS before FROM k),
t AS (SELECT b.*, greatest(0, least(size, extra - before - (sum(size) OVER (PARTITION BY b.source, b.block
                  ORDER BY {_draw_sql("mix-row", "doc_id")}, doc_id, size ROWS UNBOUNDED PRECEDING) - size))) AS more
      FROM b JOIN c ON b.source IS NOT DISTINCT FROM c.source AND b.block = c.block)
SELECT doc_id, source, size::BIGINT AS size, source_size, target, (whole * size + more)::BIGINT AS taken,
       CASE WHEN size > 0 THEN whole + CASE WHEN more > 0 THEN 1 ELSE 0 END ELSE 0 END AS times
FROM t"""
