"""Runs: stretches of words that repeat with a period, found while the words arrive, and texts with the repeats taken out.

Every completed block of 2**k words is a catcher for the periods from
2**(k+1) - 1 to 2**(k+2) - 2: the first half of any square with such a period
holds a whole block of that size, so the same words stand one period later.
When a word arrives it completes one window of each size, and two blocks lie at
the right distance; the window is compared with both. Matches of following
blocks at the same period chain up, a chain's ends are settled word by word,
and the squares in it are one run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.llm.common import bind, table, text_of, words
from tabforge.llm.textbytes import _BASE, Words, is_space, mixed, text_chunks

#: A run has this many words and this many periods at least.
LEAST_WORDS, LEAST_TIMES = 24, 3
RUNS = "doc_id long, n_words long, runs array<struct<start: long, period: long, length: long>>, collapsed string"


class Growing:
    """An array that grows at its end."""

    def __init__(self, kind):
        self.data, self.n = np.zeros(16, kind), 0

    def extend(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.data):
            bigger = np.zeros(max(2 * len(self.data), self.n + len(more)), self.data.dtype)
            bigger[: self.n] = self.data[: self.n]
            self.data = bigger
        self.data[self.n : self.n + len(more)] = more
        self.n += len(more)


class SquareCatchers:
    """The runs of a sequence of 64-bit words that arrive in pieces of any size; how they are cut up changes nothing.

    ``longest``: periods above it are not looked for. ``times`` is 2 at least.
    """

    def __init__(self, longest: int, least: int = LEAST_WORDS, times: int = LEAST_TIMES):
        self.longest, self.least, self.times = longest, least, times
        self.words = Growing(np.uint64)
        self.windows = [Growing(np.uint64) for k in range(64) if (2 << k) - 1 <= longest]
        self.open = [np.zeros((3, 0), np.int64) for _ in self.windows]
        self.found: list[tuple[int, int, int]] = []
        self.owner = Growing(np.int32)  # the number of a run that covers the word, from 1

    def append(self, new: np.ndarray) -> None:
        before = self.words.n
        self.words.extend(new)
        self.owner.extend(np.zeros(len(new), np.int32))
        for k in range(len(self.windows)):
            if self.words.n < 1 << k:
                break
            self._settle(k, self._matches(k, before), False)

    def finish(self) -> list[tuple[int, int, int]]:
        """(start, period, length) of every run with its smallest period, by start, then period."""
        for k in range(len(self.windows)):
            self._settle(k, np.zeros((3, 0), np.int64), True)
        smallest: dict[tuple[int, int], int] = {}
        for start, period, length in self.found:
            smallest[start, length] = min(period, smallest.get((start, length), period))
        return sorted((start, period, length) for (start, length), period in smallest.items())

    def _matches(self, k: int, before: int) -> np.ndarray:
        """(period, start, end) of the blocks that the newly completed windows of 2**k words equal."""
        size, n = 1 << k, self.words.n
        first, end = max(0, before - size + 1), n - size + 1
        if k:
            half = self.windows[k - 1].data
            self.windows[k].extend(mixed(half[first:end] * np.uint64(_BASE) + half[first + size // 2 : end + size // 2]))
        else:
            self.windows[0].extend(self.words.data[first:end])
        own = self.windows[k].data
        first = max(first, 2 * size - 1)
        if first >= end:
            return np.zeros((3, 0), np.int64)
        at = np.arange(first, end)
        got = []
        block = (at - (2 * size - 1)) & -size
        for far in (0, size):
            b = block - far
            hit = np.flatnonzero(own[at] == own[np.maximum(b, 0)])
            hit = hit[b[hit] >= 0]
            got.append(np.stack([at[hit] - b[hit], b[hit], b[hit] + size]))
        got = np.concatenate(got, 1)
        return got[:, got[0] <= self.longest]

    def _settle(self, k: int, new: np.ndarray, last: bool) -> None:
        """Chain matches of following blocks; chains that cannot go on become runs."""
        size, n = 1 << k, self.words.n
        chains = np.concatenate([self.open[k], new], 1)
        if not chains.shape[1]:
            return
        period, start, end = chains[:, np.lexsort((chains[1], chains[0]))]
        fresh = np.append(True, (period[1:] != period[:-1]) | (start[1:] != end[:-1]))
        tail = np.append(fresh[1:], True)
        period, start, end = period[fresh], start[fresh], end[tail]
        over = np.full(len(period), True) if last else end + period + size <= n
        self.open[k] = np.stack([period, start, end])[:, ~over]
        need = np.maximum(self.least - period, (self.times - 1) * period)
        over &= end - start + 2 * (size - 1) >= need
        period, start, end, need = period[over], start[over], end[over], need[over]
        again = self._in_known_run(period, start, end)
        period, start, end, need = period[~again], start[~again], end[~again], need[~again]
        for p, a, b, least in zip(period.tolist(), start.tolist(), end.tolist(), need.tolist()):
            if self._in_known_run(*np.array([[p], [a], [b]]))[0]:  # found since
                continue
            lo, hi = max(0, a - size), min(n - p, b + size)
            same = self.words.data[lo:hi] == self.words.data[lo + p : hi + p]
            edge = np.flatnonzero(np.diff(same.astype(np.int8), prepend=0, append=0))
            for x, y in zip(edge[::2].tolist(), edge[1::2].tolist()):
                if y - x >= least:
                    self.found.append((lo + x, p, y - x + p))
                    self.owner.data[lo + x : lo + y + p] = len(self.found)

    def _in_known_run(self, period: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Whether a chain lies in a known run whose period divides its own: then it is that run again."""
        if not self.found or not len(period):
            return np.zeros(len(period), bool)
        own = self.owner.data[start] - 1
        numbers, at = np.unique(np.maximum(own, 0), return_inverse=True)
        run_start, run_period, run_length = np.array([self.found[i] for i in numbers], np.int64)[at].T
        return (own >= 0) & (period % run_period == 0) & (start >= run_start) & (end + period <= run_start + run_length)


def runs_of(of: np.ndarray, hashes: np.ndarray, least: int, times: int) -> list[list[tuple[int, int, int]]]:
    """The runs of each text; ``of`` has where its words begin in ``hashes``, with the total last.

    The texts go through one set of catchers with a word of its own after each, which equals no other.
    """
    texts = len(of) - 1
    longest = int(np.diff(of).max(initial=0)) // times
    if not longest:
        return [[] for _ in range(texts)]
    fences = mixed(np.arange(1, texts + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
    catchers = SquareCatchers(longest, least, times)
    catchers.append(np.insert(hashes, of[1:], fences))
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(texts)]
    begins = of[:-1] + np.arange(texts)
    for start, period, length in catchers.finish():
        text = int(np.searchsorted(begins, start, "right")) - 1
        out[text].append((start - int(begins[text]), period, length))
    return out


def checked_runs(raw: np.ndarray, found: Words, least: int, times: int) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, with the words of every run compared byte by byte; a text with a false one is done again with exact numbers for its words."""
    out = runs_of(found.of, found.hash, least, times)
    for text, runs in enumerate(out):
        first, end = int(found.of[text]), int(found.of[text + 1])
        spell = lambda i: raw[found.start[first + i] : found.stop[first + i]].tobytes()  # noqa: E731, B023
        for start, period, length in runs:
            cycle = [spell(start + i) for i in range(period)]
            if any(spell(i) != cycle[(i - start) % period] for i in range(start + period, start + length)):
                numbers: dict[bytes, int] = {}
                exact = np.array([numbers.setdefault(spell(i), len(numbers)) for i in range(end - first)], np.uint64)
                out[text] = runs_of(np.array([0, end - first]), exact, least, times)[0]
                break
    return out


def collapsed_texts(raw: np.ndarray, ends: np.ndarray, found: Words, runs: list[list[tuple[int, int, int]]]) -> pa.Array:
    """The texts without the words that a run repeats, one space between words."""
    gone = np.zeros(len(found.start), bool)
    for text, own in enumerate(runs):
        for start, period, length in own:
            gone[found.of[text] + start + period : found.of[text] + start + length] = True
    out, keep = raw.copy(), ~is_space(raw)
    out[found.stop] = 32
    edge = np.zeros(len(raw) + 1, np.int32)
    edge[found.start[gone]] += 1
    edge[found.stop[gone]] -= 1
    keep &= np.cumsum(edge[:-1]) == 0
    kept = np.flatnonzero(~gone)
    text = np.searchsorted(found.of, kept, "right") - 1
    follows = np.append(text[1:] == text[:-1], False) if len(kept) else np.zeros(0, bool)
    keep[found.stop[kept[follows]]] = True
    offsets = np.concatenate([[0], np.cumsum(keep)[ends - 1]]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(ends), pa.py_buffer(offsets), pa.py_buffer(out[keep])).cast(pa.string())


def find_runs(docs: DataFrame, least: int = LEAST_WORDS, times: int = LEAST_TIMES) -> DataFrame:
    """doc_id, n_words, ``runs`` (start, period, length in words from 0; by start, then period) and the ``collapsed`` text of every row.

    A run is a stretch with smallest period q, of ``least`` words and ``times``
    periods at least, that no neighbouring word extends. A word goes if a run
    holds it after the run's first q words; what stays is joined by one space.
    Null, empty and blank texts have no words, no runs and an empty text. Rows
    are answered one by one, so a null or repeated doc_id, repeated rows and
    further columns change nothing. A text is taken whole; the memory is in
    proportion to the longest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for a, b, raw, ends in text_chunks(batch.column(1)):
                found = Words(raw, ends)
                runs = checked_runs(raw, found, least, times)
                flat = np.array([r for own in runs for r in own], np.int64).reshape(-1, 3)
                offsets = np.concatenate([[0], np.cumsum([len(own) for own in runs])]).astype(np.int32)
                fields = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], names=["start", "period", "length"])
                lists = pa.ListArray.from_arrays(pa.array(offsets), fields)
                yield pa.RecordBatch.from_arrays([ids[a:b], pa.array(np.diff(found.of)), lists, collapsed_texts(raw, ends, found, runs)], names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, RUNS)


def looped(text: Column, key: Column) -> Column:
    """Of a tenth of the texts, by the key's checksum, the rest from some word on repeats what stands there first."""
    h = F.crc32(key.cast("string"))
    g = F.floor(h / 10).cast("long")

    def loop(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8)))).cast("long")
        place = lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int")
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(w, place(i))), " ")).otherwise(text)

    return F.when(h % 10 == 0, bind(words(text), loop)).otherwise(text)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", looped(text_of("text"), F.col("doc_id")).alias("text"))
    by_times = lambda a, b: (
        F.when(a["length"] * b["period"] != b["length"] * a["period"], F.when(a["length"] * b["period"] > b["length"] * a["period"], -1).otherwise(1))
        .when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1))
        .otherwise(F.when(a["period"] < b["period"], -1).when(a["period"] > b["period"], 1).otherwise(0)))
    best = F.get(F.array_sort("runs", by_times), F.lit(0))
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    return find_runs(docs).withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
