"""Document fingerprints: a homomorphic hash of the multiset of a text's paragraphs.

Every paragraph is hashed to a wide vector and a text's fingerprint is the sum
of its paragraphs' vectors modulo 2**32 in every place. So the order of the
paragraphs does not matter, and a paragraph is put in or taken out by adding or
subtracting its vector (``added``, ``removed``).

The first ``EXACT`` places are the words of the paragraph's SHA-512: two
fingerprints that agree there stand for the same multiset of paragraphs. The
other ``LIKE`` places are signs, summed over the paragraph's pairs of following
words: the expected product of two texts' places is the number of pairs that
they share, so the angle between the fingerprints tells how alike they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabforge.llm.common import parts_for, table, text_of, words

EXACT, LIKE = 16, 128
WORD = (1 << 32) - 1
#: Two counters, 32 bits apart, in one long: a text has fewer than 2**31 words, so the lower never runs over.
_PAIR = (1 << 32) | 1


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _modulo(c: Column) -> Column:
    return c.bitwiseAND(_long(WORD))


def added(a: Column, b: Column) -> Column:
    """The fingerprint of what ``a`` and ``b`` stand for together."""
    return F.zip_with(a, b, lambda x, y: _modulo(x + y))


def removed(a: Column, b: Column) -> Column:
    """The fingerprint of what ``a`` stands for without what ``b`` stands for."""
    return F.zip_with(a, b, lambda x, y: _modulo(x - y))


def as_text(fingerprint: Column) -> Column:
    """Eight hex digits for each place."""
    return F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints; else the cosine of the angle between their likeness places, 0 at least."""

    def product(x: Column, y: Column) -> Column:
        signed = lambda v: F.when(v > (WORD >> 1), v - (WORD + 1)).otherwise(v).cast("double")
        pairs = F.zip_with(F.slice(x, EXACT + 1, LIKE), F.slice(y, EXACT + 1, LIKE), lambda v, w: signed(v) * signed(w))
        return F.aggregate(pairs, F.lit(0.0), lambda t, v: t + v)

    sizes = F.sqrt(product(a, a)) * F.sqrt(product(b, b))
    cosine = F.when(sizes > 0, product(a, b) / sizes).otherwise(0.0)
    return F.when(a == b, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), cosine)))


def fingerprints(texts: DataFrame, text: str, keys: list[str], key: str = "fingerprint") -> DataFrame:
    """``keys`` and the fingerprint (array of EXACT + LIKE longs below 2**32) of the texts that a combination of ``keys`` has, taken together.

    Paragraphs are what ``\\n`` separates, blank ones too; null counts as empty, and an empty text is one empty paragraph.
    If ``texts`` is already dealt out by some of ``keys``, nothing is shuffled.
    """
    lines = texts.select(*keys, F.explode(F.split(text_of(text), "\n", -1)).alias("_line"))
    parts = lines.select(*keys, F.sha2("_line", 512).alias("_sha"), words(F.col("_line")).alias("_words"))
    # One row for every word and its next one, or for a paragraph without words.
    parts = parts.select("*", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("_words") - 1))).alias("_i"))
    pair = [F.get("_words", "_i"), F.coalesce(F.get("_words", F.col("_i") + 1), F.lit("\n"))]
    blank = F.size("_words") == 0
    hashes = [F.when(blank, _long(0)).otherwise(F.xxhash64(F.lit(seed), *pair)) for seed in range(LIKE // 64)]
    rows = parts.select(*keys, (F.col("_i") == 0).alias("_first"), "_sha", (~blank).cast("long").alias("_n"), *(h.alias(f"_h{s}") for s, h in enumerate(hashes)))

    shares = [F.sum(F.when(F.col("_first"), F.conv(F.substring("_sha", 8 * j + 1, 8), 16, 10).cast("long")).otherwise(_long(0))).alias(f"_e{j}") for j in range(EXACT)]
    ones = [F.sum(F.shiftright(f"_h{s}", j).bitwiseAND(_long(_PAIR))).alias(f"_s{s}_{j}") for s in range(LIKE // 64) for j in range(32)]
    sums = rows.groupBy(*keys).agg(F.sum("_n").alias("_pairs"), *shares, *ones)
    exact = [_modulo(F.col(f"_e{j}")) for j in range(EXACT)]
    like = []
    for s in range(LIKE // 64):
        for j in range(32):
            both = F.col(f"_s{s}_{j}")
            for half in (_modulo(both), F.shiftrightunsigned(both, 32)):
                like.append(_modulo(half * 2 - F.col("_pairs")))
    return sums.select(*keys, F.array(*exact, *like).alias(key))


def followed(docs: DataFrame, blocks: int | None = None) -> DataFrame:
    """The rows of ``docs`` (doc_id, text) with ``next_text`` and where they stand: ``block``, ``place``, and ``extra`` for a copy of the next block's first row.

    Rows are ordered by doc_id, nulls last, then by the text's hash and the
    text; the first follows the last, and rows alike in both follow each other.
    Sampled bounds cut the order into blocks that hold about as many rows each,
    so no task sees the whole of it; a block's first row goes to the block
    before it as well.
    """
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", _long(0)).alias("id"), F.xxhash64("text").alias("h"))
    rows = docs.select(F.col("doc_id").cast("long"), text_of("text").alias("text")).withColumn("at", order)
    blocks = blocks or 2 * parts_for(docs)
    firsts = rows.select("at").repartitionByRange(blocks, "at").groupBy(F.spark_partition_id().alias("part")).agg(F.min("at").alias("at"))
    bounds = sorted({tuple(r["at"]) for r in firsts.collect()})  # one row for each block at most
    if not bounds:
        return rows.select("doc_id", "text", F.lit("").alias("next_text"), F.lit(0).alias("block"), F.lit(0).alias("place"), F.lit(False).alias("extra")).limit(0)
    listed = F.array(*(F.struct(F.lit(a).alias("none"), _long(b).alias("id"), _long(c).alias("h")) for a, b, c in bounds))
    steps = [1 << k for k in reversed(range((len(bounds) - 1).bit_length()))]

    def halve(at: Column, step: Column) -> Column:
        return F.when((at + step < len(bounds)) & (F.get(listed, at + step) <= F.col("at")), at + step).otherwise(at)

    block = F.aggregate(F.array(*map(F.lit, steps)).cast("array<int>"), F.lit(0), halve)
    own = rows.withColumn("block", block)
    before = F.pmod(F.col("block") - 1, F.lit(len(bounds))).cast("int")
    is_first = F.get(listed, "block") == F.col("at")
    copies = F.when(is_first, F.array(F.struct(F.col("block"), F.lit(False).alias("extra")), F.struct(before.alias("block"), F.lit(True).alias("extra"))))
    dealt = own.withColumn("to", F.explode(F.coalesce(copies, F.array(F.struct(F.col("block"), F.lit(False).alias("extra"))))))
    dealt = dealt.select("doc_id", "text", "at", "to.block", "to.extra")
    w = Window.partitionBy("block").orderBy("extra", "at", "text")
    return dealt.select("doc_id", "text", "block", "extra", F.row_number().over(w).alias("place"), F.lead("text").over(w).alias("next_text"))


def edited_fingerprints(docs: DataFrame, blocks: int | None = None) -> DataFrame:
    """Fingerprints of every text and of the text whose later half was replaced by the start of the next document.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next (likeness to the edited and to the next text). Null
    texts count as empty. Documents stand in the order of ``followed``: null
    doc_ids last, rows alike in id and text one after the other, each with a
    result of its own. Further columns are not looked at. Texts without words
    are alike (1) if equal and unlike (0) otherwise.
    """
    rows = followed(docs.select("doc_id", "text"), blocks)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.withColumn("edited", F.when(F.col("extra"), F.lit(None)).otherwise(edited)).select(
        "block", "place", "extra", "doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("body")), F.struct(F.lit(1).alias("which"), F.col("edited").alias("body")))).alias("t"))
    rows = rows.select("block", "place", "extra", "doc_id", "n_chars", "edited_sha256", "t.which", "t.body").where("which = 0 or not extra")
    keys = ["block", "place", "extra", "doc_id", "n_chars", "edited_sha256"]
    found = fingerprints(rows, "body", [*keys, "which"])
    # In a block: a row's own text, its edited text, the next row's own text, and so on.
    w = Window.partitionBy("block").orderBy("place", "which")
    found = found.withColumn("changed", F.lead("fingerprint", 1).over(w)).withColumn("after", F.lead("fingerprint", 2).over(w))
    return found.where("which = 0 and not extra").select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("fingerprint")).alias("fingerprint"), as_text(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("changed")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("after")).alias("near_next"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))
