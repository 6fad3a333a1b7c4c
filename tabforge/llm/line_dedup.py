"""Line dedup by a deletion-neighbourhood join.

Lines are sequences of words. A line goes when an earlier one has the same words
or, for lines of MIN_WORDS words or more, can be turned into it by changing,
adding or removing one word. Two lines within that bound become equal when one
word is deleted from either (or from the longer), so every line emits hashed
variants and equal variants are joined.

A line of n words has n variants, most of which meet nothing. So each line first
emits a few coarse variants with a whole block of words deleted: lines within
the bound differ in one block only. Lines that meet there emit the variants with
one word of such a block deleted. All lines with the same variant are within the
bound of each other, or of the group's shorter line, so a group needs its
earliest line only and no pairs are formed. The edit distance to it is verified
on the words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tabforge.llm.common import LAST_ID, SPACES, bind, broadcast_if_small, table, text_of, words, written

#: Shorter lines are dropped for equal words only.
MIN_WORDS = 10
#: Blocks that a line is cut into for its coarse variants.
BLOCKS = 3


def coarse_variants(plain: Column, n: Column, blocks: int = BLOCKS) -> Column:
    """2 * blocks keys of a line of n words with one space between them.

    The first half: each block of the line deleted, with n and the block's
    number. The second half: what a line of n + 1 words has left when its block
    loses one word more than this line's does, so that a line meets those that
    are one word longer.
    """
    cut = lambda i, length: F.floor(F.lit(i) * length / blocks).cast("int")

    def without(j: int, length: Column, extra: int) -> Column:
        before, after = cut(j, length), n - cut(j + 1, length) + extra
        first = F.call_function("substring_index", plain, F.lit(" "), before)
        last = F.call_function("substring_index", plain, F.lit(" "), -after)
        return F.xxhash64(length, F.lit(j), first, last)

    return F.array(*[without(j, n, 0) for j in range(blocks)], *[without(j, n + 1, 1) for j in range(blocks)])


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc, row, pos, line): every line of every row; ``row`` tells rows of the same doc_id apart."""
    text = text_of("text")
    # The text ends here: a row that is exploded carries two numbers, whatever its length.
    each = docs.select(F.coalesce("doc_id", F.lit(LAST_ID)).alias("doc"), F.xxhash64(text).alias("row"), F.split(text, "\n", -1).alias("lines"))
    return each.select("doc", "row", F.posexplode("lines").alias("pos", "line"))


def within_one_word(a: Column, b: Column) -> Column:
    """Whether two lists of words differ by one changed, added or removed word at most; in time linear in their length."""
    changed = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: ~same))
    differ = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False).cast("int")  # the first place, from 1

    def one_longer(long: Column, short: Column) -> Column:
        return F.slice(long, differ + 1, F.size(long)) == F.slice(short, differ, F.size(long))

    return (F.when(F.size(a) == F.size(b), changed <= 1)
            .when(F.size(a) == F.size(b) + 1, one_longer(a, b)).when(F.size(b) == F.size(a) + 1, one_longer(b, a)).otherwise(False))


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, row, pos, near): the lines of ``docs`` (doc_id, text) that an earlier line makes superfluous.

    Earlier is by doc_id, then position. Blank lines are never listed.
    """
    line = F.col("line")
    solid = lines_of(docs).where(F.btrim("line", F.lit(SPACES)) != "")
    # Most lines have single spaces already, which a few byte searches show.
    uneven = line.startswith(" ") | line.endswith(" ") | line.contains("  ")
    for space in SPACES.replace(" ", ""):
        uneven = uneven | line.contains(space)
    plain = F.when(uneven, F.array_join(words(F.col("line")), " ")).otherwise(F.col("line"))
    split = solid.select("doc", "row", "pos", plain.alias("plain"))
    n = F.length("plain") - F.length(F.replace("plain", F.lit(" "), F.lit(""))) + 1
    split = split.withColumn("n", n)
    keys = F.when(F.col("n") >= min_words, coarse_variants(F.col("plain"), F.col("n")))
    lines = written(split.select("doc", "row", "pos", F.xxhash64("plain").alias("h1"), F.xxhash64(F.lit(1), "plain").alias("h2"), "n", keys.alias("keys")), "lines")
    place = F.struct("doc", "row", "pos")
    firsts = written(lines.groupBy("h1", "h2").agg(F.min_by(F.struct("doc", "row", "pos", "n", "keys"), place).alias("f"), F.count(F.lit(1)).alias("times")).select("h1", "h2", "f.*", "times"), "lines-first")

    # Equal words: all but the first go.
    many = firsts.where("times > 1").select("h1", "h2", F.struct("doc", "row", "pos").alias("first"))
    exact = lines.select("doc", "row", "pos", "h1", "h2").join(many, ["h1", "h2"]).where(place != F.col("first")).select("doc", "row", "pos", F.lit(False).alias("near"))

    # Coarse variants that more than one line has.
    coarse = firsts.where("keys is not null").select("doc", "row", "pos", "h1", "h2", "n", F.posexplode("keys").alias("slot", "key"))
    met = coarse.groupBy("key").agg(F.count(F.lit(1)).alias("lines")).where("lines > 1").select("key")
    slots = coarse.join(met, "key").groupBy("doc", "row", "pos", "h1", "h2", "n").agg(F.collect_set("slot").alias("slots"))  # at most 2 * BLOCKS
    suspects = written(slots, "lines-suspect")
    wanted = broadcast_if_small(written(suspects.select("doc", "row").distinct(), "lines-suspect-rows"), 32)
    again = lines_of(docs.join(wanted, (F.coalesce("doc_id", F.lit(LAST_ID)) == F.col("doc")) & (F.xxhash64(text_of("text")) == F.col("row")), "left_semi"))
    spelt = written(again.join(suspects, ["doc", "row", "pos"]).select("doc", "row", "pos", "n", "slots", words(F.col("line")).alias("w")).dropDuplicates(["doc", "row", "pos"]), "lines-spelt")

    # One word deleted: the rest's hash is that of the words before it and of those after it, each moved up by one.
    each = spelt.select("doc", "row", "pos", "n", "slots", F.posexplode("w").alias("p", "word"))
    of_line = W.partitionBy("doc", "row", "pos")
    upto = of_line.orderBy("p").rowsBetween(W.unboundedPreceding, 0)
    here, moved = F.xxhash64("p", "word"), F.xxhash64(F.col("p") - 1, "word")
    each = each.select("doc", "row", "pos", "n", "slots", "p", here.alias("here"), moved.alias("moved"))
    each = each.withColumn("before", F.bit_xor("here").over(upto).bitwiseXOR(F.col("here"))).withColumn("after", F.bit_xor("moved").over(of_line).bitwiseXOR(F.bit_xor("moved").over(upto)))
    each = each.withColumn("whole", F.bit_xor("here").over(of_line))
    at = lambda j: (F.col("p") >= F.floor(F.lit(j) * F.col("n") / BLOCKS)) & (F.col("p") < F.floor(F.lit(j + 1) * F.col("n") / BLOCKS))
    deleted = F.lit(False)
    for j in range(BLOCKS):
        deleted = deleted | (F.array_contains("slots", j) & at(j))
    rest = F.col("before").bitwiseXOR(F.col("after"))
    line = ["doc", "row", "pos"]
    changed = each.where(deleted).select(*line, F.xxhash64(F.lit("changed"), "n", "p", rest).alias("variant"), F.lit(0).alias("side"))
    shortened = each.where(deleted).select(*line, F.xxhash64(F.lit("added"), F.col("n") - 1, rest).alias("variant"), F.lit(1).alias("side"))
    short = each.where((F.col("p") == 0) & F.exists("slots", lambda s: s >= BLOCKS)).select(*line, F.xxhash64(F.lit("added"), "n", "whole").alias("variant"), F.lit(2).alias("side"))
    variants = written(changed.unionByName(shortened).unionByName(short).distinct(), "lines-variants")

    # Each line against its group's earliest line: of all where a word was changed, else of the other length.
    earliest = lambda side: F.min(F.when(F.col("side") == side, place))
    groups = variants.groupBy("variant").agg(*[earliest(s).alias(f"e{s}") for s in range(3)], F.count(F.lit(1)).alias("lines")).where("lines > 1").drop("lines")
    other = F.when(F.col("side") == 0, F.col("e0")).when(F.col("side") == 1, F.col("e2")).otherwise(F.col("e1"))
    pairs = variants.join(groups, "variant").select(*line, other.alias("e")).where(F.col("e") < place).distinct()
    a = spelt.select(*line, "w")
    b = spelt.select(F.struct(*line).alias("e"), F.col("w").alias("v"))
    near = pairs.join(a, line).join(b, "e").where(within_one_word(F.col("w"), F.col("v"))).select(*line).distinct().withColumn("near", F.lit(True))
    return exact.unionByName(near)


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, counts: bool = False, emptied: bool = True) -> DataFrame:
    """``docs`` without the lines that an earlier line makes superfluous.

    A row keeps its other lines as they are, in order; blank lines stay. Null
    text stays null. n_chars, if there, follows a changed text. A null doc_id
    comes after all others. Rows alike in doc_id and text count as one row: they
    keep and lose the same lines. Without ``emptied``, rows that had lines with
    words and lose them all are left out; rows without any stay in either case.
    ``counts`` adds n_lines, n_exact and n_near. Further columns stay, whatever
    their names.
    """
    gone = repeated_lines(docs.select("doc_id", "text"), min_words).groupBy("doc", "row").agg(
        F.collect_set("pos").alias("gone"), F.sum(F.col("near").cast("long")).alias("near"), F.count(F.lit(1)).alias("n"))  # lines of one row
    gone = broadcast_if_small(written(gone, "lines-gone"), 96)
    own = docs.select(F.struct("*").alias("in"), F.coalesce("doc_id", F.lit(LAST_ID)).alias("doc"), F.xxhash64(text_of("text")).alias("row"))
    kept = bind(F.split("in.text", "\n", -1), lambda x: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col("gone")), lambda i: F.get(x, i)), "\n"))
    out = own.join(gone, ["doc", "row"], "left").withColumn("text", F.when(F.col("gone").isNull(), F.col("in.text")).otherwise(kept))
    if not emptied:
        out = out.where(F.col("gone").isNull() | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    columns = {c: F.col("in").getField(c) for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("gone").isNull(), columns["n_chars"]).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType))
    if counts:
        columns |= {"n_lines": F.size(F.split(text_of("in.text"), "\n", -1)).cast("long"), "n_exact": F.coalesce(F.col("n") - F.col("near"), F.lit(0)), "n_near": F.coalesce("near", F.lit(0))}
    return out.select(*[c.alias(k) for k, c in columns.items()])


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), counts=True)


OP1_SQL = rf"""
WITH l AS (SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
s AS (SELECT doc_id, pos, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w FROM l),
f AS (SELECT w, min((doc_id, pos)) AS first FROM s WHERE len(w) > 0 GROUP BY w),
v AS (SELECT first, w, unnest(range(1, len(w) + 1)) AS p FROM f WHERE len(w) >= {MIN_WORDS}),
d AS (SELECT first, len(w) AS n, p, w[:p - 1] || w[p + 1:] AS rest FROM v),
near AS (SELECT first FROM (SELECT first, min(first) OVER (PARTITION BY n, p, rest) AS e FROM d) WHERE e < first
         UNION SELECT d.first FROM d JOIN f ON f.w = d.rest WHERE len(f.w) >= {MIN_WORDS} AND f.first < d.first
         UNION SELECT f.first FROM d JOIN f ON f.w = d.rest WHERE len(f.w) >= {MIN_WORDS} AND d.first < f.first),
k AS (SELECT s.*, len(s.w) > 0 AND (doc_id, pos) <> f.first AS exact, near.first IS NOT NULL AS near
      FROM s LEFT JOIN f ON s.w = f.w LEFT JOIN near ON near.first = (s.doc_id, s.pos))
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT exact AND NOT near), '') AS text,
       count(*) AS n_lines, count(*) FILTER (exact) AS n_exact, count(*) FILTER (near) AS n_near
FROM k GROUP BY doc_id"""
