"""Phrase collocation mining: Misra-Gries summaries find every frequent phrase, a second pass counts them.

A summary holds at most ``capacity`` phrases with counters. Where the capacity
exceeds the mass (the occurrences that it is told of) divided by the threshold,
every phrase that occurs ``threshold`` times survives, and so it does in the
merge of two summaries. Phrases are dealt by their hash to partitions; every
task summarises what it reads for each partition, and the summaries of one
partition are merged with the capacity that its own whole mass asks for.

A phrase can be frequent only if its parts are, so phrases of one word come
first, then two, then three to five; a filter of bounded size (a bit for each
of 2**FILTER_BITS hashes) keeps out phrases with a part that is not frequent.
It lets some others pass, which costs time only. What survives is counted
exactly in a pass of its own. Phrases go by 64-bit hashes of their words and
language until they are spelt out, a word at a time, from the frequent words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabforge.llm.common import parts_for, table, written
from tabforge.llm.textbytes import _BASE, lowered, mixed, span_hashes, text_chunks

#: A phrase is frequent from this count on, has this many words at most, and the report has this many lines for a language.
THRESHOLD, LONGEST, TOP = 100, 5, 2000
#: The filter of frequent parts has 2**FILTER_BITS bits (16 MB), whatever the input's size.
FILTER_BITS = 27
#: Occurrences that a hash partition is made for, and distinct phrases that a task holds before it hands on its summaries.
PART_MASS, HELD = 1 << 22, 1 << 21
#: Merged summaries have so many times the capacity that the guarantee asks for: a counter is short by a sixteenth of the threshold at most, so few others survive.
ROOM = 16
_ENDS = np.isin(np.arange(256), np.frombuffer(b".,;:!?\n\x0b\x0c\r", np.uint8))


class Summary:
    """A mergeable Misra-Gries summary: sorted keys with counters, at most ``capacity`` of them.

    ``lost``: how much a key's counter may lie below its count, at most.
    """

    def __init__(self, capacity: int):
        self.capacity, self.lost = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Take in counters of distinct keys, in any order."""
        both = np.concatenate([self.keys, keys])
        order = np.argsort(both, kind="stable")
        both, sums = both[order], np.concatenate([self.counts, counts])[order]
        first = np.flatnonzero(np.append(True, both[1:] != both[:-1])) if len(both) else np.zeros(0, np.int64)
        self.keys, self.counts = both[first], np.add.reduceat(sums, first) if len(first) else sums
        if len(self.keys) > self.capacity:
            # Take the (capacity + 1)-th largest counter off all: at most ``capacity`` stay above zero.
            off = int(np.partition(self.counts, len(self.counts) - self.capacity - 1)[len(self.counts) - self.capacity - 1])
            self.counts = self.counts - off
            stay = self.counts > 0
            self.keys, self.counts, self.lost = self.keys[stay], self.counts[stay], self.lost + off

    def frequent(self, threshold: int) -> np.ndarray:
        """The keys that may occur ``threshold`` times; all that do, if the capacity exceeds the mass divided by it."""
        return self.keys[self.counts + self.lost >= threshold]


def packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys and their counts: keys as they are, counts in a byte unless they are larger."""
    large = np.flatnonzero(counts > 255)
    head = np.array([len(keys), len(large)], "<i8")
    small = np.minimum(counts, 255).astype(np.uint8)
    return b"".join(x.tobytes() for x in (head, keys.astype("<u8"), small, large.astype("<i8"), counts[large].astype("<i8")))


def unpacked(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, m = (int(x) for x in np.frombuffer(raw, "<i8", 2))
    counts = np.frombuffer(raw, np.uint8, n, 16 + 8 * n).astype(np.int64)
    counts[np.frombuffer(raw, "<i8", m, 16 + 9 * n)] = np.frombuffer(raw, "<i8", m, 16 + 9 * n + 8 * m)
    return np.frombuffer(raw, "<u8", n, 16), counts


class Phrases:
    """The words of a chunk of texts and the hashes of the phrases that begin at each word.

    ``left`` is how many words the word's piece still has, itself included. A
    phrase's hash depends on its language, so languages share one table.
    """

    def __init__(self, raw: np.ndarray, ends: np.ndarray, salts: np.ndarray):
        self.raw = raw
        stop = _ENDS[raw]
        stop[ends - 1] = True
        solid = ~(stop | (raw == 32) | (raw == 9))
        edge = np.flatnonzero(np.diff(solid.astype(np.int8), prepend=0, append=0))
        self.start, self.end = edge[::2], edge[1::2]
        self.text = np.searchsorted(ends, self.start, "right")
        self.hash = mixed(span_hashes(raw, self.start, self.end) ^ salts[self.text])
        n = len(self.start)
        piece = np.cumsum(stop)[self.start] if n else np.zeros(0, np.int64)
        last = np.flatnonzero(np.append(piece[1:] != piece[:-1], True)) if n else np.zeros(0, np.int64)
        self.left = np.repeat(last, np.diff(last, prepend=-1)) - np.arange(n) + 1

    def longer(self, hashes: np.ndarray, size: int) -> np.ndarray:
        """Hashes of the phrases of ``size`` words, from those of one word less (one for each word that they can begin at; others are noise)."""
        m = len(self.hash) - size + 1
        return mixed(hashes[:m] * np.uint64(_BASE) + self.hash[size - 1 :]) if m > 0 else np.zeros(0, np.uint64)

    def spell(self, at: int, size: int) -> str:
        return b" ".join(self.raw[a:b].tobytes() for a, b in zip(self.start[at : at + size], self.end[at : at + size])).decode()


def phrases(batch: pa.RecordBatch) -> Iterator[tuple[list[str], Phrases]]:
    """Chunks of a batch of (lang, text) with the languages of their texts."""
    langs = batch.column(0).to_pylist()
    numbers: dict[str, np.uint64] = {}
    for lang in set(langs):
        raw = np.frombuffer(lang.encode() + b" ", np.uint8)
        numbers[lang] = mixed(span_hashes(raw, np.zeros(1, np.int64), np.array([len(raw)])))[0]
    for a, b, raw, ends in text_chunks(batch.column(1)):
        yield langs[a:b], Phrases(lowered(raw), ends, np.array([numbers[x] for x in langs[a:b]], np.uint64))


def filter_of(keys: DataFrame, bits: int) -> np.ndarray:
    """2**bits bits, as bytes, with one set for every ``key``: the driver gets no more than these, as longs with their places."""
    place = F.shiftrightunsigned("key", 64 - bits)
    words = keys.groupBy(F.shiftright(place, 6).alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(key, {64 - bits}) & 63 as int))")).alias("word")).toArrow()
    whole = np.zeros(1 << (bits - 6), "<i8")
    whole[words["at"].to_numpy()] = words["word"].to_numpy()
    return whole.view(np.uint8)


def passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the hashes' bits are set: for all that were put in, and for few others while the filter is sparse."""
    place = hashes >> np.uint64(64 - (8 * len(bits) - 1).bit_length())
    return (bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _sized(found: Phrases, sizes: range, part: np.ndarray | None, whole: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(size, places, hashes, hashes without the last word) of the phrases of each size whose parts of ``sizes.start - 1`` words all pass ``part``, and which pass ``whole`` themselves."""
    hashes = shorter = found.hash
    fine, below = None, sizes.start - 1
    for size in range(1, sizes.stop):
        if size > 1:
            hashes, shorter = found.longer(hashes, size), hashes
        if part is not None and size == below:
            fine = passes(part, hashes)
        if size < sizes.start:
            continue
        ok = found.left[: len(hashes)] >= size
        if fine is not None:
            for shift in range(size - below + 1):
                ok = ok & fine[shift : shift + len(hashes)]
        if whole is not None:
            ok = ok & passes(whole, hashes)
        at = np.flatnonzero(ok)
        yield size, at, hashes[at], shorter[at]


def summaries(texts: DataFrame, sizes: range, part, bits: int, held: int) -> DataFrame:
    """(part, mass, summary) for each task and hash partition: the summaries of the phrases that it reads.

    A summary is handed on when the task holds ``held`` distinct phrases, so its
    capacity always exceeds what it was told of and nothing is lost here.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, waiting = Summary(1 << 62), []

        def take_in() -> None:
            if waiting:
                own.merge(*np.unique(np.concatenate(waiting), return_counts=True))
                waiting.clear()

        def hand_on() -> Iterator[pa.RecordBatch]:
            to = (own.keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(own.keys), np.int64)
            cut = np.flatnonzero(np.append(True, to[1:] != to[:-1])) if len(to) else np.zeros(0, np.int64)
            for a, b in zip(cut, np.append(cut[1:], len(to))):
                blob = packed(own.keys[a:b], own.counts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(to[a])] * 2), pa.array([int(own.counts[a:b].sum()), 0]), pa.array([None, blob], pa.binary())], names=["part", "mass", "summary"])
            own.keys, own.counts = own.keys[:0], own.counts[:0]

        known = part.value if part is not None else None
        for batch in batches:
            for _, found in phrases(batch):
                waiting += [hashes for _, _, hashes, _ in _sized(found, sizes, known)]
                if sum(map(len, waiting)) > held:
                    take_in()
                if len(own.keys) > held:
                    yield from hand_on()
        take_in()
        yield from hand_on()

    return texts.mapInArrow(run, "part long, mass long, summary binary")


def merged(parts: DataFrame, threshold: int) -> DataFrame:
    """``key`` of every phrase that may occur ``threshold`` times.

    A hash partition's masses come before its summaries, so the capacity is
    known when the first one is merged: memory is in proportion to the
    partition's mass divided by the threshold, plus one summary.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, mass, whole = None, 0, None

        def over() -> Iterator[pa.RecordBatch]:
            if whole is not None:
                yield pa.RecordBatch.from_arrays([pa.array(whole.frequent(threshold).view(np.int64))], names=["key"])

        for batch in batches:
            for i in range(batch.num_rows):
                number = batch.column(0)[i].as_py()
                if number != at:
                    yield from over()
                    at, mass, whole = number, 0, None
                if not batch.column(2)[i].is_valid:
                    mass += batch.column(1)[i].as_py()
                    continue
                whole = whole or Summary(ROOM * (mass // threshold + 1))
                whole.merge(*unpacked(batch.column(2)[i].as_py()))
        yield from over()

    kind = F.col("summary").isNotNull()
    dealt = parts.repartition(parts_for(parts), "part").sortWithinPartitions("part", kind)
    return dealt.mapInArrow(run, "key long")


def counted_words(texts: DataFrame, whole, bits: int, threshold: int) -> DataFrame:
    """(key, lang, phrase, size, count): exact counts, from ``threshold`` on, of the words that pass the filter; all words of a language under an empty phrase, size 0.

    As with longer phrases, a task hands on one table for each hash partition; words carry their spelling.
    """

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[tuple[str, str], list[int]] = {}  # (lang, word): key, count

        def hand_on() -> Iterator[pa.RecordBatch]:
            parts: dict[int, list] = {}
            for (lang, word), (key, n) in own.items():
                parts.setdefault(key >> (64 - bits) if bits else 0, []).append((key, lang, word, n))
            own.clear()
            kinds = (pa.list_(pa.uint64()), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.int64()))
            for part, rows in parts.items():
                lists = [pa.array([list(column)], kind) for column, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays([pa.array([part]), lists[0].cast(pa.list_(pa.int64()), safe=False), *lists[1:]], names=["part", "keys", "langs", "words", "counts"])

        for batch in batches:
            for langs, found in phrases(batch):
                for text, n in enumerate(np.bincount(found.text, minlength=len(langs)).tolist()):
                    own.setdefault((langs[text], ""), [0, 0])[1] += n
                for size, at, hashes, _ in _sized(found, range(1, 2), None, whole.value):
                    keys, first, counts = np.unique(hashes, return_index=True, return_counts=True)
                    for key, i, n in zip(keys.tolist(), at[first].tolist(), counts.tolist()):
                        own.setdefault((langs[found.text[i]], found.spell(i, size)), [key, 0])[1] += n
                if len(own) > HELD // 8:
                    yield from hand_on()
        yield from hand_on()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, whole = None, {}

        def over() -> Iterator[pa.RecordBatch]:
            rows = [(key, lang, word, min(1, len(word)), n) for (lang, word), (key, n) in whole.items() if n >= threshold or not word]
            if rows:
                kinds = (pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["key", "lang", "phrase", "size", "count"])

        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] != at:
                    yield from over()
                    at, whole = row["part"], {}
                for key, lang, word, n in zip(row["keys"], row["langs"], row["words"], row["counts"]):
                    whole.setdefault((lang, word), [key, 0])[1] += n
        yield from over()

    tables = texts.mapInArrow(tally, "part long, keys array<long>, langs array<string>, words array<string>, counts array<long>")
    return tables.repartition(parts_for(texts), "part").sortWithinPartitions("part").mapInArrow(add, "key long, lang string, phrase string, size int, count long")


#: What is kept of a phrase while it is counted: its hash, its hash without the last word, the last word's, its size and its count.
TALLY = np.dtype([("key", "<u8"), ("head", "<u8"), ("last", "<u8"), ("size", "u1"), ("count", "<i8")])


def added_up(tallies: list[np.ndarray]) -> np.ndarray:
    """One row for each key, in order, with the sum of its counts."""
    rows = np.concatenate([np.zeros(0, TALLY), *tallies])
    rows = rows[np.argsort(rows["key"], kind="stable")]
    first = np.flatnonzero(np.append(True, rows["key"][1:] != rows["key"][:-1])) if len(rows) else np.zeros(0, np.int64)
    out = rows[first]
    if len(first):
        out["count"] = np.add.reduceat(rows["count"], first)
    return out


def counted(texts: DataFrame, sizes: range, part, whole, bits: int, threshold: int) -> DataFrame:
    """(key, head, last, size, count): exact counts, from ``threshold`` on, of the phrases that pass the filters.

    A task hands on one table of counts for each hash partition, and the tables
    of a partition are added up one by one. A phrase is the phrase without its
    last word, ``head``, and that word, ``last``.
    """

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, waiting = np.zeros(0, TALLY), []

        def hand_on() -> Iterator[pa.RecordBatch]:
            to = (own["key"] >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(own), np.int64)
            cut = np.flatnonzero(np.append(True, to[1:] != to[:-1])) if len(to) else np.zeros(0, np.int64)
            for a, b in zip(cut, np.append(cut[1:], len(to))):
                yield pa.RecordBatch.from_arrays([pa.array([int(to[a])]), pa.array([own[a:b].tobytes()], pa.binary())], names=["part", "counts"])

        for batch in batches:
            for _, found in phrases(batch):
                for size, at, hashes, heads in _sized(found, sizes, part.value, whole.value):
                    keys, first, counts = np.unique(hashes, return_index=True, return_counts=True)
                    rows = np.zeros(len(keys), TALLY)
                    rows["key"], rows["head"], rows["last"], rows["size"], rows["count"] = keys, heads[first], found.hash[at[first] + size - 1], size, counts
                    waiting.append(rows)
                if sum(map(len, waiting)) > HELD // 4:
                    own, waiting = added_up([own, *waiting]), []
                if len(own) > HELD // 2:
                    yield from hand_on()
                    own = own[:0]
        own = added_up([own, *waiting])
        yield from hand_on()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, whole = None, np.zeros(0, TALLY)

        def over() -> Iterator[pa.RecordBatch]:
            rows = whole[whole["count"] >= threshold]
            longs = [pa.array(np.ascontiguousarray(rows[c]).view(np.int64)) for c in ("key", "head", "last")]
            yield pa.RecordBatch.from_arrays([*longs, pa.array(rows["size"].astype(np.int32)), pa.array(np.ascontiguousarray(rows["count"]))], names=["key", "head", "last", "size", "count"])

        for batch in batches:
            for number, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                if number != at:
                    yield from over()
                    at, whole = number, np.zeros(0, TALLY)
                whole = added_up([whole, np.frombuffer(raw.as_buffer(), TALLY)])
        yield from over()

    tables = texts.mapInArrow(tally, "part long, counts binary").repartition(parts_for(texts), "part").sortWithinPartitions("part")
    return tables.mapInArrow(add, "key long, head long, last long, size int, count long")


def spelt(counts: DataFrame, heads: DataFrame, words: DataFrame, size: int) -> DataFrame:
    """(key, lang, phrase, size, count) of the phrases of ``size`` words, whose parts are as frequent and so are in ``heads`` and ``words``."""
    front = heads.select(F.col("key").alias("head"), F.col("phrase").alias("front"))
    back = words.select(F.col("key").alias("last"), "lang", F.col("phrase").alias("back"))
    both = counts.where(F.col("size") == size).join(front, "head").join(back, "last")
    return both.select("key", "lang", F.concat_ws(" ", "front", "back").alias("phrase"), "size", "count")


def frequent_phrases(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, part_mass: int = PART_MASS, held: int = HELD, filter_bits: int = FILTER_BITS) -> DataFrame:
    """(lang, phrase, size, count) of every phrase of up to ``longest`` words that occurs ``threshold`` times in a language, and each language's words (size 0).

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends and
    those into words at spaces and tabs; phrases lie within a piece. Null text
    counts as empty, a null lang as ``und``; doc_id and further columns are not
    looked at, and repeated rows count as often as they stand there.
    """
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    sc = docs.sparkSession.sparkContext

    mass = docs.select(F.coalesce(F.sum(F.length("text") / 4), F.lit(0.0)).cast("long").alias("n")).first()["n"]

    def survivors(sizes: range, part, bits: int):
        found = written(merged(summaries(texts, sizes, part, bits, held), threshold), f"phrases-{sizes.start}")
        return sc.broadcast(filter_of(found, filter_bits))

    bits_for = lambda sizes: max(0, (mass * len(sizes) // part_mass).bit_length())
    part = survivors(range(1, 2), None, bits_for(range(1)))
    exact = written(counted_words(texts, part, bits_for(range(1)), threshold), "words")
    words = heads = exact.where("size = 1")
    out = exact
    for sizes in (range(2, min(longest, 2) + 1), range(3, longest + 1)):
        if not sizes:
            continue
        whole = survivors(sizes, part, bits_for(sizes))
        counts = written(counted(texts, sizes, part, whole, bits_for(sizes), threshold), f"phrase-counts-{sizes.start}")
        part = whole
        for size in sizes:
            heads = written(spelt(counts, heads, words, size), f"phrases-of-{size}")
            out = out.unionByName(heads)
    return out.drop("key")


def scored(counts: DataFrame, factor: int = 1000) -> DataFrame:
    """(lang, phrase, a, l, r, n, score, size) of the phrases of two words or more, by their weakest cut.

    Scores are whole numbers, ``factor * a * n / (l * r)`` rounded down; the
    products are decimals of 38 digits (``a * n`` may have 34, beyond which the job fails). Ties go to the earliest cut.
    """
    words = F.split("phrase", " ")
    n = counts.where("size = 0").select("lang", F.col("count").alias("n"))
    whole = counts.where("size > 1").select("lang", "phrase", "size", F.col("count").alias("a"))
    cuts = whole.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    join = lambda a, length: F.array_join(F.slice(words, a, length), " ")
    cuts = cuts.select("lang", "phrase", "size", "a", "cut", join(F.lit(1), F.col("cut")).alias("head"), join(F.col("cut") + 1, F.col("size") - F.col("cut")).alias("tail"))
    known = counts.where("size > 0").select("lang", "phrase", "count")
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("head"), F.col("count").alias("l")), ["lang", "head"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("tail"), F.col("count").alias("r")), ["lang", "tail"])
    cuts = cuts.join(F.broadcast(n), "lang")  # a row for each language
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    cuts = cuts.withColumn("up", (wide("a") * wide("n")).cast("decimal(34,0)") * F.lit(factor).cast("decimal(4,0)")).withColumn("down", wide("l") * wide("r"))
    cuts = cuts.withColumn("score", F.expr("up div down"))
    weakest = cuts.groupBy("lang", "phrase", "size", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("cut"))
    return weakest.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"), "size")


def outermost(found: DataFrame, percent: int = 100) -> DataFrame:
    """The phrases of ``found`` without those that a longer one contains which occurs ``percent`` per cent as often or more."""
    words = F.split("phrase", " ")
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda k: F.transform(F.sequence(F.lit(1), F.col("size") - k + 1), lambda i: F.array_join(F.slice(words, i, k), " "))))
    inner = found.where("size > 2").select("lang", F.explode(spans).alias("phrase"), F.col("a").alias("outer")).groupBy("lang", "phrase").agg(F.max("outer").alias("outer"))
    both = found.join(inner, ["lang", "phrase"], "left")
    return both.where(F.col("outer").isNull() | (100 * F.col("outer") < percent * F.col("a"))).drop("outer")


def collocations(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, top: int = TOP, **how: int) -> DataFrame:
    """The ``top`` phrases of every language by score, count and spelling: lang, rank, phrase, a, l, r, n, score."""
    found = outermost(scored(written(frequent_phrases(docs, threshold, longest, **how), "phrase-table")))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The best of each of many parts first, so that no task sorts all phrases of a language.
    shares = F.pmod(F.xxhash64("phrase"), F.lit(parts_for(docs)))
    for by in (["lang", "share"], ["lang"]):
        found = found.withColumn("share", shares).withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= top)
    return found.select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))


OP13_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, [x FOR x IN string_split_regex(piece, '[\x20\x09]+') IF x <> ''] AS ws FROM pieces),
size AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
grams AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
          FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(ws) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
cuts AS (SELECT lang, k, phrase, a, ws, unnest(range(1, k)) AS cut FROM cand),
scores AS (SELECT c.lang, c.k, c.phrase, c.a, l.f AS l, r.f AS r, n, cut, (1000::HUGEINT * c.a * n) // (l.f::HUGEINT * r.f) AS score
           FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(ws[1:cut], ' ')
           JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(ws[cut + 1:c.k], ' ') JOIN size s ON s.lang = c.lang),
weakest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(a) AS outer_a
           FROM (SELECT lang, ws, a, k, m, unnest(range(1, k - m + 2)) AS i FROM cand, (SELECT unnest([2, 3, 4]) AS m) WHERE m < k) GROUP BY ALL)
SELECT w.lang, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, encode(w.phrase)) AS rank, w.phrase, a, l, r, n, score::BIGINT AS score
FROM weakest w LEFT JOIN inside i ON i.lang = w.lang AND i.phrase = w.phrase
WHERE outer_a IS NULL OR 100 * outer_a < 100 * a
QUALIFY rank <= 2000"""
