"""Exact dedup by counting quotient filters and byte verification.

Every input partition builds a counting quotient filter of the 64-bit
fingerprints of its texts and ships it in slices of the quotient range. Slices
of one range merge without loss, as their remainders are sorted. Only rows with
a fingerprint counted more than once go on: their texts are compared byte by
byte with the text of their group's first row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.llm.common import SPACE_RUN, table, text_of, written

#: Quotient bits within a slice: 2**QUOTIENT_BITS home slots for every slice.
QUOTIENT_BITS = 12


class QuotientFilter:
    """The fingerprints of one slice of the quotient range, with their counts.

    A fingerprint is ``slice | quotient | remainder`` from the high to the low
    bits. Remainders lie in slots ordered by (quotient, remainder). ``occupied``
    has a bit for each quotient that owns slots, ``run_end`` a bit for each slot
    that ends its quotient's run, so quotients need not be stored. A count over
    one is kept as (slot, count).
    """

    def __init__(self, remainder_bits: int, occupied, run_end, remainders, slots, counts):
        self.remainder_bits, self.occupied, self.run_end = remainder_bits, occupied, run_end
        self.remainders, self.slots, self.counts = remainders, slots, counts

    @classmethod
    def build(cls, keys: np.ndarray, counts: np.ndarray, remainder_bits: int) -> QuotientFilter:
        """``keys``: distinct and sorted quotient-and-remainder values."""
        quotient = (keys >> np.uint64(remainder_bits)).astype(np.int64)
        occupied = np.zeros(1 << QUOTIENT_BITS, bool)
        occupied[quotient] = True
        run_end = np.append(quotient[1:] != quotient[:-1], True) if len(keys) else np.zeros(0, bool)
        slots = np.flatnonzero(counts > 1)
        return cls(remainder_bits, occupied, run_end, keys & np.uint64((1 << remainder_bits) - 1), slots, counts[slots])

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        """The sorted keys and their counts."""
        run = np.concatenate([[0], np.cumsum(self.run_end)[:-1]]).astype(np.int64)[: len(self.remainders)]
        quotient = np.flatnonzero(self.occupied)[run].astype(np.uint64)
        counts = np.ones(len(self.remainders), np.int64)
        counts[self.slots] = self.counts
        return (quotient << np.uint64(self.remainder_bits)) | self.remainders, counts

    def merge(self, other: QuotientFilter) -> QuotientFilter:
        (a, m), (b, n) = self.items(), other.items()
        keys, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        counts = np.zeros(len(keys), np.int64)
        np.add.at(counts, at, np.concatenate([m, n]))
        return self.build(keys, counts, self.remainder_bits)

    def dump(self) -> bytes:
        head = np.array([self.remainder_bits, len(self.remainders), len(self.slots)], "<i8")
        bits = np.packbits(self.occupied), np.packbits(self.run_end)
        body = self.remainders.astype("<u8"), self.slots.astype("<i8"), self.counts.astype("<i8")
        return b"".join(x.tobytes() for x in (head, *bits, *body))

    @classmethod
    def load(cls, raw: bytes) -> QuotientFilter:
        remainder_bits, n, m = (int(x) for x in np.frombuffer(raw, "<i8", 3))
        at = 24
        occupied = np.unpackbits(np.frombuffer(raw, np.uint8, (1 << QUOTIENT_BITS) // 8, at)).astype(bool)
        at += (1 << QUOTIENT_BITS) // 8
        run_end = np.unpackbits(np.frombuffer(raw, np.uint8, (n + 7) // 8, at))[:n].astype(bool)
        at += (n + 7) // 8
        remainders = np.frombuffer(raw, "<u8", n, at)
        slots = np.frombuffer(raw, "<i8", m, at + 8 * n)
        return cls(remainder_bits, occupied, run_end, remainders, slots, np.frombuffer(raw, "<i8", m, at + 8 * (n + m)))


def slice_bits(rows: int, per_slice: int) -> int:
    """Bits for the slice number, so that a merged slice holds about ``per_slice`` rows."""
    return max(4, min(40, (max(1, rows // per_slice) - 1).bit_length()))


def repeated_fingerprints(fps: DataFrame, per_slice: int = 250_000) -> DataFrame:
    """``fp``: fingerprints of the one long column of ``fps`` that occur more than once, with ``copies``.

    A partition's filters are bounded by its own rows, a merged slice by
    ``per_slice`` distinct fingerprints on average, whatever the table's size.
    """
    bits = slice_bits(fps.count(), per_slice)
    low = 64 - bits
    remainder_bits = low - QUOTIENT_BITS

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = [b.iloc[:, 0].to_numpy(np.int64) for b in batches]
        keys, counts = np.unique(np.concatenate(got).view(np.uint64) if got else np.zeros(0, np.uint64), return_counts=True)
        part = (keys >> np.uint64(low)).astype(np.int64)
        starts = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, np.int64)
        ends = np.append(starts[1:], len(part))
        mask = np.uint64((1 << low) - 1)
        for a, b in zip(starts, ends):
            blob = QuotientFilter.build(keys[a:b] & mask, counts[a:b], remainder_bits).dump()
            yield pd.DataFrame({"slice": [int(part[a])], "filter": [blob]})

    def merge(key: tuple, slices: pd.DataFrame) -> pd.DataFrame:
        whole = None
        for raw in slices["filter"]:
            one = QuotientFilter.load(raw)
            whole = one if whole is None else whole.merge(one)
        keys, counts = whole.items()
        twice = counts > 1
        fp = (np.uint64(key[0]) << np.uint64(low)) | keys[twice]
        return pd.DataFrame({"fp": fp.view(np.int64), "copies": counts[twice]})

    slices = fps.mapInPandas(build, "slice long, filter binary")
    return slices.groupBy("slice").applyInPandas(merge, "fp long, copies long")


def exact_duplicates(docs: DataFrame, per_slice: int = 250_000) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after every run of white space became one
    space; null counts as empty, and empty texts equal each other. The smallest
    doc_id of a group stays; a null doc_id is smaller than none, and a group
    with null ids only has a null keep_id and keeps its rows. Rows that repeat
    both doc_id and text all get the same answer and all count in group_size.
    Other columns are not looked at.
    """
    text = F.regexp_replace(text_of("text"), SPACE_RUN, " ")
    narrow = written(docs.select("doc_id", F.sha2(text, 256).alias("sha"), F.xxhash64(text).alias("fp")), "exact-rows")
    twice = repeated_fingerprints(narrow.select("fp"), per_slice).select("fp")
    suspects = written(narrow.join(twice, "fp"), "exact-suspects")
    groups = suspects.groupBy("fp", "sha").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))

    # Byte verification: each suspect's text against the text of its group's first row.
    ids = suspects.select("doc_id", "sha").distinct()
    texts = written(
        docs.select("doc_id", text.alias("norm")).withColumn("sha", F.sha2("norm", 256))
        .join(ids.hint("merge"), ["doc_id", "sha"], "left_semi").dropDuplicates(["doc_id", "sha"]), "exact-texts")
    members = suspects.join(groups, ["fp", "sha"]).where(F.col("doc_id") != F.col("keep_id")).select("doc_id", "sha", "keep_id").distinct()
    first = texts.select(F.col("doc_id").alias("keep_id"), "sha", F.col("norm").alias("first_norm"))
    unequal = written(
        members.join(texts, ["doc_id", "sha"]).join(first, ["keep_id", "sha"])
        .where(F.col("norm") != F.col("first_norm")).select("sha").distinct(), "exact-unequal")
    groups = groups.select("sha", "keep_id", "group_size")
    plain = narrow.join(groups, "sha", "left")
    if unequal.isEmpty():
        out = plain
    else:  # one digest for different texts: those groups are formed by the texts themselves
        split = docs.select("doc_id", text.alias("norm")).withColumn("sha", F.sha2("norm", 256)).join(unequal, "sha", "left_semi")
        own = split.groupBy("norm").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        out = plain.join(unequal, "sha", "left_anti").select("doc_id", "sha", "keep_id", "group_size").unionByName(
            split.join(own, "norm").select("doc_id", "sha", "keep_id", "group_size"))
    return out.select(
        "doc_id", F.coalesce("keep_id", "doc_id").alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.coalesce("keep_id", "doc_id")).alias("kept"), F.col("sha").alias("text_sha256"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP4_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d"""
