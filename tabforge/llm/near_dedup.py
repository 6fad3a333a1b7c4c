"""MinHash near-dedup with HyperMinHash registers.

Every text's word shingles are dealt by hash into buckets; a bucket keeps its
smallest hash as a leading-zero count and some mantissa bits. Bands of these
compressed registers find candidates, the collision-corrected Jaccard estimate
drops most of those that fall short, and links are confirmed on full shingle
sets. Texts with the same shingle set stand behind one of them throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tabforge.llm.common import draw, table, written
from tabforge.llm.components import connected
from tabforge.llm.textbytes import Words, lowered, mixed, shingle_hashes, text_chunks

#: A register has 6 bits for the leading zeros of the 57 bits that don't name its bucket, and MANTISSA bits.
BUCKET_BITS, MANTISSA = 7, 10
BUCKETS = 1 << BUCKET_BITS
#: Registers of a band: at similarity 0.8 all 32 bands differ with probability (1 - 0.8 ** 4) ** 32 = 5e-8.
BAND = 4
#: Members that one task compares with each other, and shingles that they have at most together (but for a single
#: member); larger groups are dealt into blocks, each pair of blocks a task.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 22


def registers(hashes: np.ndarray) -> np.ndarray:
    """The HyperMinHash sketch of a set of 64-bit hashes: one 16-bit register a bucket, 0 where it is empty.

    A register is ``zeros + 1`` in its high 6 bits and the MANTISSA bits after
    the leading one below; a smaller hash has a larger zero count, then a
    smaller mantissa, so the mantissa is stored inverted and the maximum wins.
    """
    out = np.zeros(BUCKETS, np.uint16)
    bucket = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    rest = (hashes << np.uint64(BUCKET_BITS)) >> np.uint64(BUCKET_BITS)  # 57 bits
    width = 64 - BUCKET_BITS
    exponent = np.frexp(rest.astype(np.float64))[1]  # bits in use; rounding up to a power of two is put right next
    exponent -= (exponent > 0) & ((np.uint64(1) << np.maximum(exponent - 1, 0).astype(np.uint64)) > rest)
    tail = ((rest << (64 - exponent).clip(0, 63).astype(np.uint64)) << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    value = ((width - exponent + 1) << MANTISSA) | ((1 << MANTISSA) - 1 - tail.astype(np.int64))
    np.maximum.at(out, bucket, value.astype(np.uint16))
    return out


def collision_rate(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Expected share of buckets whose registers agree by chance for disjoint sets of n and m elements.

    The minima of n and m elements have the same place on a logarithmic scale
    with density r / (1 + r)**2, r the ratio of the sizes, and a register's cell
    is 2**-MANTISSA / (2 ln 2) wide there on average.
    """
    r = np.minimum(n, m) / np.maximum(np.maximum(n, m), 1)
    return r / (1 + r) ** 2 * 2.0**-MANTISSA / (2 * np.log(2))


def estimate(a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of every row of registers ``a`` (sets of n elements) with every row of ``b``.

    The share of agreeing buckets among those that either set uses, less what
    agrees by chance.
    """
    if len(a) * len(b) <= 4096:
        same = a[:, None, :] == b[None, :, :]
        equal, empty = same.sum(2), (same & (a[:, None, :] == 0)).sum(2)
    else:
        equal = np.zeros((len(a), len(b)), np.float32)
        empty = np.zeros((len(a), len(b)), np.float32)
        for k in range(BUCKETS):
            same = a[:, k, None] == b[None, :, k]
            equal += same
            empty += same & (a[:, k, None] == 0)
    return corrected(equal, empty, n[:, None], m[None, :])


def corrected(equal: np.ndarray, empty: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The estimate from the counts of agreeing buckets and of those that both sets leave empty."""
    chance = collision_rate(n.astype(float), m.astype(float))
    share = (equal - empty) / np.maximum(BUCKETS - empty, 1)
    return (share - chance) / (1 - chance)


def near_enough(estimated: np.ndarray, n: np.ndarray, m: np.ndarray, used: np.ndarray, similarity: float) -> np.ndarray:
    """What the estimate leaves open: five standard errors for the buckets in use, and sizes that allow the similarity."""
    margin = 5 * np.sqrt(similarity * (1 - similarity) / np.maximum(used, 1))
    return (np.minimum(n, m) >= similarity * np.maximum(n, m) - 1e-9) & (estimated >= similarity - margin)


def may_link(a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray, similarity: float) -> np.ndarray:
    """The open pairs of every row of registers ``a`` with every row of ``b``."""
    used = np.minimum((a > 0).sum(1)[:, None], (b > 0).sum(1)[None, :])
    return near_enough(estimate(a, n, b, m), n[:, None], m[None, :], used, similarity)


def text_key(text: Column) -> Column:
    """Tells the texts of one doc_id apart."""
    return F.xxhash64(text)


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, set_key, registers) for every row of ``docs`` (doc_id, text); an empty text has no set_key."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, keys, regs = [], [], []
            for _, _, raw, ends in text_chunks(batch.column("text")):
                w = Words(lowered(raw), ends)
                for a, b in zip(w.of[:-1], w.of[1:]):
                    s = np.unique(shingle_hashes(w.hash[a:b], words))
                    n.append(len(s))
                    keys.append(np.array([len(s), s.sum(dtype=np.uint64), mixed(s ^ np.uint64(0xA5A5A5A5)).sum(dtype=np.uint64)], "<u8").tobytes() if len(s) else None)
                    regs.append(registers(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("text_key"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(regs, pa.binary())],
                names=["doc_id", "text_key", "n_shingles", "set_key", "registers"])

    return docs.select("doc_id", "text", text_key(F.col("text")).alias("text_key")).mapInArrow(sign, "doc_id long, text_key long, n_shingles long, set_key binary, registers binary")


class Forest:
    """Union-find over 0..n-1 whose roots are the smallest members."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        a, b = sorted((self.root(x), self.root(y)))
        self.up[b] = a
        return a != b

    def join_all(self, open_pairs: np.ndarray, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[int, int]]:
        """The pairs of a boolean matrix that join two trees; rows are members ``left``, columns members ``right``."""
        for i, x in enumerate(left):
            hits = right[open_pairs[i]]
            if len(hits):
                roots = np.array([self.root(int(y)) for y in hits]) if len(hits) < 64 else self.roots()[hits]
                for y in hits[np.unique(roots, return_index=True)[1]]:
                    if self.join(int(x), int(y)):
                        yield int(x), int(y)

    def roots(self) -> np.ndarray:
        while True:
            up = self.up[self.up]
            if (up == self.up).all():
                return up
            self.up = up


def in_blocks(members: DataFrame, sizes: DataFrame, group: str, by: str) -> DataFrame:
    """``members`` with ``task`` and ``side``: groups of few enough rows are one task; larger ones are dealt into
    blocks, and a row goes to the task of every pair of blocks that has its own. ``sizes`` has (group, _n, _blocks) of
    the groups that are wanted."""
    rows = members.join(sizes, group)
    rows = rows.withColumn("_own", F.pmod(draw("block", F.col(by)), F.col("_blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    rows = rows.withColumn("_other", other)
    pair = F.struct(F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"))
    return rows.withColumn("task", F.xxhash64(F.col(group), pair)).drop("_n", "_blocks", "_other").withColumnRenamed("_own", "side")


def candidate_links(sets: DataFrame, similarity: float) -> DataFrame:
    """(a, b): links between sets (id, n, registers) with a band in common and a high enough estimate.

    A band's group yields a spanning forest of its open pairs, never all of
    them: what matters is which sets may hang together.
    """
    bands = BUCKETS // BAND

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, n = batch.column("id").to_numpy(zero_copy_only=False), batch.column("n").to_numpy(zero_copy_only=False)
            regs = np.frombuffer(b"".join(batch.column("registers").to_pylist()), "<u2").reshape(len(ids), bands, BAND)
            key = regs[:, :, 0].astype(np.uint64)
            for i in range(1, BAND):
                key = (key << np.uint64(16)) | regs[:, :, i]
            row, band = np.nonzero(key)  # a band of empty buckets only tells nothing
            keys = mixed(key[row, band] ^ mixed(band.astype(np.uint64)))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(ids[row]), pa.array(n[row])], names=["band", "id", "n"])

    banded = written(sets.mapInArrow(cut, "band long, id long, n long"), "near-bands")
    of_group = [F.count(F.lit(1)).alias("members"), F.min("id").alias("lo"), F.max("id").alias("hi"), F.bit_xor(F.xxhash64("id")).alias("who")]
    shared = banded.groupBy("band").agg(*of_group).where("members > 1")
    # Groups that many bands find alike are looked at once.
    shared = written(shared.groupBy("members", "lo", "hi", "who").agg(F.min("band").alias("band")), "near-groups")
    pairs = shared.where("members = 2").select(F.col("lo").alias("a"), F.col("hi").alias("b"))
    large = banded.select("band", "id")
    full = sets.select("id", "n", "registers")
    sizes = shared.where("members > 2").select("band", F.col("members").alias("_n"), F.ceil(F.col("members") / BLOCK).cast("int").alias("_blocks"))
    tasks = in_blocks(large, sizes, "band", "id").join(full, "id")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id")
        ids, n = frame["id"].to_numpy(), frame["n"].to_numpy()
        regs = np.frombuffer(b"".join(frame["registers"]), "<u2").reshape(len(ids), BUCKETS)
        forest, at, side = Forest(len(ids)), np.arange(len(ids)), frame["side"].to_numpy()
        got = []
        sides = np.unique(side)
        left = at[side == sides[0]] if len(sides) > 1 else at
        right = at[side == sides[1]] if len(sides) > 1 else at
        for s in range(0, len(left), 256):
            rows = left[s : s + 256]
            ok = may_link(regs[rows], n[rows], regs[right], n[right], similarity)
            got += list(forest.join_all(ok & (rows[:, None] != right[None, :]), rows, right))
        return pd.DataFrame({"a": [ids[x] for x, _ in got], "b": [ids[y] for _, y in got]}, dtype=np.int64)

    grouped = tasks.groupBy("task").applyInPandas(compare, "a long, b long")

    def pairwise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            a, b = (np.frombuffer(b"".join(x[k]), "<u2").reshape(-1, BUCKETS) for k in ("ra", "rb"))
            n, m = x["na"].to_numpy(), x["nb"].to_numpy()
            guess = corrected((a == b).sum(1), ((a == b) & (a == 0)).sum(1), n, m)
            yield x.loc[near_enough(guess, n, m, np.minimum((a > 0).sum(1), (b > 0).sum(1)), similarity), ["a", "b"]]

    ra, rb = (full.select(F.col("id").alias(k), F.col("n").alias(f"n{k}"), F.col("registers").alias(f"r{k}")) for k in "ab")
    two = pairs.join(ra, "a").join(rb, "b").select("a", "b", "na", "nb", "ra", "rb").mapInPandas(pairwise, "a long, b long")
    return two.union(grouped)


def confirmed_links(docs: DataFrame, clusters: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b): links confirmed on full sets, enough of them to keep what hangs together; from clusters (id, label, n shingles) of ids of ``docs`` (id, text)."""

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = []
            for _, _, raw, ends in text_chunks(batch.column("text")):
                w = Words(lowered(raw), ends)
                sets += [np.unique(shingle_hashes(w.hash[a:b], words)).tobytes() for a, b in zip(w.of[:-1], w.of[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(sets, pa.binary())], names=["id", "label", "shingles"])

    members = docs.join(clusters, "id").select("id", "label", "text").mapInArrow(shingled, "id long, label long, shingles binary")
    need = F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / BLOCK_SHINGLES)
    sizes = clusters.groupBy("label").agg(F.count(F.lit(1)).alias("_n"), F.ceil(need).cast("int").alias("_blocks"))
    tasks = in_blocks(members, sizes, "label", "id")

    def confirm(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id")
        ids, side = frame["id"].to_numpy(), frame["side"].to_numpy()
        sets = [np.frombuffer(x, "<u8") for x in frame["shingles"]]
        n = np.array([len(s) for s in sets])
        elements, column = np.unique(np.concatenate(sets), return_inverse=True)
        row = np.repeat(np.arange(len(sets)), n)
        forest, got, at = Forest(len(sets)), [], np.arange(len(sets))
        sides = np.unique(side)
        left = at[side == sides[0]] if len(sides) > 1 else at
        right = at[side == sides[1]] if len(sides) > 1 else at
        both = np.zeros((len(left), len(right)), np.float32)  # sizes of the intersections
        place = np.full((2, len(sets)), -1)
        place[0, left], place[1, right] = np.arange(len(left)), np.arange(len(right))
        order = np.argsort(column, kind="stable")
        column, row = column[order], row[order]
        step = 4096
        bounds = np.searchsorted(column, np.arange(0, len(elements) + step, step))
        for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
            c, r = column[a:b] - k * step, row[a:b]
            dense = [np.zeros((size, step), np.float32) for size in (len(left), len(right))]
            for d, p in zip(dense, place):
                here = p[r] >= 0
                d[p[r[here]], c[here]] = 1
            both += dense[0] @ dense[1].T
        union = n[left][:, None] + n[right][None, :] - both
        linked = (100 * both >= percent * union) & (left[:, None] != right[None, :])
        got = list(forest.join_all(linked, left, right))
        return pd.DataFrame({"a": [ids[x] for x, _ in got], "b": [ids[y] for _, y in got]}, dtype=np.int64)

    return tasks.groupBy("task").applyInPandas(confirm, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Texts are linked when their sets of ``words``-word shingles (A-Z lowered)
    have 100 * intersection >= percent * union; component_id is the smallest
    doc_id that links lead to. A shorter text is one shingle; null, empty and
    blank texts have none and stand alone. Rows that repeat a doc_id share its
    answers for each text of theirs; a null doc_id is linked with nothing.
    """
    return near_rows(docs, words, percent).drop("text_key")


def near_rows(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``near_duplicates`` with the text_key of each row. Sets have ids of their own, as one doc_id may stand for several."""
    signed = written(signatures(docs, words), "near-signatures")
    named = signed.where("set_key is not null and doc_id is not null")
    sets = written(named.groupBy("set_key").agg(F.min(F.struct("doc_id", "text_key")).alias("of"), F.first("n_shingles").alias("n"), F.first("registers").alias("registers"))
                   .select(F.monotonically_increasing_id().alias("id"), "set_key", "of.doc_id", "of.text_key", "n", "registers"), "near-sets")
    links = written(candidate_links(sets.select("id", "n", "registers"), percent / 100), "near-candidates")
    clusters = connected(links, "near-clusters").join(sets.select("id", "n"), "id")
    clusters = written(clusters, "near-clusters")
    owners = sets.join(clusters.select("id"), "id", "left_semi").select("id", "doc_id", "text_key")
    texts = docs.select("doc_id", "text", text_key(F.col("text")).alias("text_key")).join(owners, ["doc_id", "text_key"]).select("id", "text").dropDuplicates(["id"])
    confirmed = written(confirmed_links(texts, clusters, words, percent), "near-links")
    labels = connected(confirmed, "near-components")
    named = labels.join(sets.select("id", "doc_id"), "id").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    labels = labels.join(named, "label").select("id", "component_id")
    of_set = sets.join(labels, "id", "left").select("set_key", F.coalesce("component_id", "doc_id").alias("component_id"))
    out = signed.join(of_set, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "text_key", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), words=4)
