"""Mixture-controlled packing of token sequences.

Every source's documents form a queue of tokens. Rounds of deficit round-robin
serve the queues: a round credits each source with its share of a window of
tokens, what is owed in whole tokens is taken, and the fraction is carried as
the source's deficit into the next round. The deficits have a closed form, so
each task knows the state of every queue at any round, whichever partition the
rounds before ran in. Sequences are cut from the resulting stream every
``length`` tokens; documents are cut wherever a window or a sequence ends.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tabforge.llm.common import table, written
from tabforge.llm.textbytes import is_space, span_hashes, text_chunks

VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
LENGTH = 1024
#: Tokens that a round of all queues aims at: 64 sequences.
WINDOW = 64 * LENGTH
#: Rows of queue offsets (partitions times sources) up to which they are broadcast; beyond, they are joined.
BROADCAST_ROWS = 200_000
#: Distinct pieces whose ids a task keeps, and the rows and bytes of text it works on at once: an executor runs a worker for every core.
KEEP, ROWS, BYTES = 250_000, 1000, 1 << 19


class Chunks:
    """Token ids of texts by way of their distinct pieces.

    A single space before an ASCII or two-byte letter, digit or sign always
    begins a token of its own in a byte-level vocabulary's pre-tokenisation, so
    a text may be cut there and its pieces tokenised apart, or strung together
    with others of that kind. Distinct pieces are few against all pieces; their
    ids are kept for later batches, up to about ``keep`` of them. ``ranks`` is the
    same vocabulary for a faster library, which gives the same ids; texts with
    the spelling of a special token go to the tokenizer itself.
    """

    def __init__(self, vocabulary: str, ranks: str, keep: int = KEEP):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer, self.keep = Tokenizer.from_file(vocabulary), keep
        self.specials = [x.content.encode() for x in self.tokenizer.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.spelt = np.zeros(max(table.values()) + 1, np.int64)  # bytes of each id
        self.spelt[list(table.values())] = [len(k) for k in table]
        self.forget()

    def forget(self) -> None:
        self.known, self.where = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.ids, self.first = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def learn(self, hashes: np.ndarray, raw: np.ndarray, start: np.ndarray, stop: np.ndarray, strung: np.ndarray, special: np.ndarray) -> None:
        """Pieces by their sorted hashes: those ``strung`` are tokenised in one string, the others one by one."""
        ids, sizes, slot = [], np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        alone, together = np.flatnonzero(~strung), np.flatnonzero(strung)
        for i in alone:
            text = raw[start[i] : stop[i]].tobytes().decode("utf-8", "replace")
            ids.append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids if special[i] else self.fast.encode_ordinary(text), np.uint32))
            sizes[i] = len(ids[-1])
        for part in np.array_split(together, len(together) // 8192 + 1):
            spans = stop[part] - start[part]
            ends = np.cumsum(spans)
            blob = raw[np.repeat(start[part] - ends + spans, spans) + np.arange(spans.sum())].tobytes()
            got = np.array(self.fast.encode_ordinary(blob.decode("utf-8", "replace")), np.uint32)
            sizes[part] = np.diff(np.searchsorted(np.cumsum(self.spelt[got]), ends) + 1, prepend=0)
            ids.append(got)
        order = np.concatenate([alone, together])
        slot[order] = len(self.first) - 1 + np.arange(len(order))
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(sizes[order])])
        self.ids = np.concatenate([self.ids, *ids])
        self.known, self.where = np.concatenate([self.known, hashes]), np.concatenate([self.where, slot])
        by_hash = np.argsort(self.known, kind="stable")  # two sorted runs
        self.known, self.where = self.known[by_hash], self.where[by_hash]

    def encode(self, raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in ``raw`` (as text_chunks gives them), and where each text's ids end."""
        blob = raw.tobytes()
        begins = np.concatenate([[0], ends[:-1]])
        after = np.append(raw[1:], 32)
        safe = (raw == 32) & ~is_space(after) & ((after < 0x80) & (after > 32) | (after > 0xC2) & (after < 0xE0))
        whole = np.zeros(len(ends), bool)  # a text that holds a special token's spelling is not cut
        for special in self.specials:
            at = blob.find(special)
            while at >= 0:
                row = int(np.searchsorted(ends, at, "right"))
                whole[row] = True
                safe[begins[row] : ends[row]] = False
                at = blob.find(special, int(ends[row]))
        cut = safe.copy()
        cut[begins] = True
        cut[ends - 1] = True  # a text's own space begins a piece that is left out
        start = np.flatnonzero(cut)
        stop = np.append(start[1:], len(raw))
        own = np.ones(len(start), bool)
        own[np.searchsorted(start, ends - 1)] = False
        start, stop = start[own], stop[own]
        distinct, sample, which = np.unique(span_hashes(raw, start, stop), return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, distinct)
        new = at >= len(self.known)
        new[~new] = self.known[at[~new]] != distinct[~new]
        if new.any():
            if len(self.known) > self.keep:
                self.forget()
                new[:] = True
            a, b = start[sample[new]], stop[sample[new]]
            self.learn(distinct[new], raw, a, b, safe[a], whole[np.searchsorted(ends, a, "right")])
            at = np.searchsorted(self.known, distinct)
        slot = self.where[at][which]
        size = self.first[slot + 1] - self.first[slot]
        total = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.repeat(self.first[slot] - total[:-1], size) + np.arange(total[-1])]
        return ids, total[np.searchsorted(start, ends - 1)]


class Rounds:
    """The schedule of the queues: how many tokens of each source the first w rounds take.

    Without weights a source's share of every window is its share of all tokens,
    and all queues end together. With weights the shares hold as long as every
    queue lasts; when one ends, the rest share its part by their weights.
    """

    def __init__(self, totals: list[int], window: int, weights: list[float] | None = None):
        left, taken, first = [int(t) for t in totals], [0] * len(totals), 0
        self.phases: list[tuple[int, int, list[int], list[int]]] = []  # first round, tokens, taken before, taken in it
        while sum(left):
            part = list(left)
            if weights is not None:
                share = [w if n else 0.0 for w, n in zip(weights, left)]
                share = share if any(share) else [float(n > 0) for n in left]
                ends = min(n * sum(share) / w for n, w in zip(left, share) if w)  # tokens until a queue ends
                part = [min(n, int(ends * w / sum(share) + 0.5)) for n, w in zip(left, share)]
            self.phases.append((first, sum(part), list(taken), part))
            first += -(-sum(part) // window)
            taken, left = [a + b for a, b in zip(taken, part)], [a - b for a, b in zip(left, part)]
        self.rounds, self.window, self.totals = first, window, np.array(taken, np.int64)
        self._state: dict[int, np.ndarray] = {}

    def _phase(self, w: int) -> tuple[int, int, list[int], list[int]]:
        return next(p for p in reversed(self.phases) if p[0] <= w)

    def taken(self, w: int) -> np.ndarray:
        """Tokens taken from each source before round w: the fraction that the division drops is the deficit carried."""
        if w >= self.rounds:
            return self.totals
        if w not in self._state:
            if len(self._state) > 100_000:
                self._state.clear()
            first, tokens, before, part = self._phase(w)
            served = min((w - first) * self.window, tokens)
            self._state[w] = np.array([a + n * served // tokens for a, n in zip(before, part)], np.int64)
        return self._state[w]

    def round_of(self, source: int, token: int) -> int:
        """The round that takes a source's token."""
        first, tokens, before, part = next(p for p in reversed(self.phases) if p[2][source] <= token and p[3][source])
        served = -(-(token - before[source] + 1) * tokens // part[source])  # as many tokens of all sources include it
        return first + -(-served // self.window) - 1

    def pieces(self, source: int, token: int, count: int, length: int) -> Iterator[tuple[int, int, int, int]]:
        """(start, size, sequence, offset) of the pieces of ``count`` tokens of a queue from ``token`` on."""
        done, w = 0, self.round_of(source, token) if count else 0
        while done < count:
            here, after = self.taken(w), self.taken(w + 1)
            if after[source] <= token + done:
                w += 1
                continue
            place = int(here.sum()) + int((after - here)[:source].sum()) + token + done - int(here[source])
            size = min(count - done, int(after[source]) - token - done, length - place % length)
            yield done, size, place // length, place % length
            done += size


def id_type(vocabulary: str) -> str:
    """Two bytes an id where the vocabulary allows it."""
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(vocabulary).get_vocab_size() <= 1 << 16 else "<u4"


def tokenised(docs: DataFrame, vocabulary: str, ranks: str) -> DataFrame:
    """``docs`` (doc_id, source, text) as token rows: ids (in id_type), n, the partition
    and how many tokens of the same source stand before the row in it."""

    kind = id_type(vocabulary)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, before = Chunks(vocabulary, ranks), {}
        part = TaskContext.get().partitionId()
        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            sources = batch.column("source").to_pylist()
            for first, end, raw, ends in text_chunks(batch.column("text"), BYTES):
                ids, stops = chunks.encode(raw, ends)
                size = np.diff(stops, prepend=0) + 1  # with the end token
                stops = np.cumsum(size)
                out = np.zeros(stops[-1], kind)
                keep = np.ones(len(out), bool)
                keep[stops - 1] = False
                out[keep] = ids
                ahead = []
                for s, n in zip(sources[first:end], size.tolist()):
                    ahead.append(before.get(s, 0))
                    before[s] = ahead[-1] + n
                blob, at = out.tobytes(), np.concatenate([[0], stops]) * out.itemsize
                own = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays(
                    [own.column("doc_id").cast(pa.int64()), own.column("source").cast(pa.string()), pa.array([part] * (end - first), pa.int32()), pa.array(ahead, pa.int64()),
                     pa.array(size, pa.int64()), pa.array([blob[a:b] for a, b in zip(at[:-1], at[1:])], pa.binary())],
                    names=["doc_id", "source", "part", "ahead", "n", "ids"])

    return docs.select("doc_id", "source", "text").mapInArrow(encode, "doc_id long, source string, part int, ahead long, n long, ids binary")


def pack(docs: DataFrame, vocabulary: str, ranks: str, length: int = LENGTH, window: int = WINDOW, weights: dict[str | None, float] | None = None, with_ids: bool = False) -> DataFrame:
    """The pieces of all rows of ``docs`` (doc_id, source, text): where each lies in which sequence.

    A row's tokens are its text's ids and one end token 0; null text is empty
    and still has its end token. ``start`` and ``length`` count the row's tokens,
    ``sequence_id`` and ``offset`` tell the place; ids_crc32 is over the piece's
    ids as unsigned 32-bit little-endian numbers. Every sequence is full but the
    last. ``weights`` are target shares by source, each source's share of all
    tokens by default. Null is a source like others; rows that repeat are packed
    each; further columns are not looked at. The schedule holds one number per
    source and phase, so sources are assumed to be as few as a mixture has.
    """
    rows = written(tokenised(docs, vocabulary, ranks), "pack-tokens")
    kind = id_type(vocabulary)
    counts = written(rows.groupBy("source", "part").agg(F.sum("n").alias("tokens")), "pack-counts")
    totals = {r["source"]: r["tokens"] for r in counts.groupBy("source").agg(F.sum("tokens").alias("tokens")).collect()}  # one row per source
    order = sorted(totals, key=lambda s: (s is None, s or ""))
    schedule = Rounds([totals[s] for s in order], window, None if weights is None else [float(weights.get(s, 0.0)) for s in order])
    index = {s: i for i, s in enumerate(order)}

    before = F.sum("tokens").over(W.partitionBy("source").orderBy("part")) - F.col("tokens")
    offsets = counts.select(F.col("source").alias("q_source"), F.col("part").alias("q_part"), before.alias("base"))
    if counts.count() <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    placed = rows.join(offsets, F.col("source").eqNullSafe(F.col("q_source")) & (F.col("part") == F.col("q_part")))
    placed = placed.select("doc_id", "source", "n", (F.col("base") + F.col("ahead")).alias("token"), "ids")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, source, n, token = (batch.column(k).to_pylist() for k in ("doc_id", "source", "n", "token"))
            out: list[tuple] = []
            for d, s, m, t, raw in zip(doc, source, n, token, batch.column("ids")):
                ids = np.frombuffer(raw.as_buffer(), kind).astype("<u4").tobytes()
                for start, size, sequence, offset in schedule.pieces(index[s], t, m, length):
                    piece = ids[4 * start : 4 * (start + size)]
                    out.append((d, s, start, size, zlib.crc32(piece), m, sequence, offset, *([piece] if with_ids else [])))
            columns = list(zip(*out)) if out else [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    long = [(k, pa.int64()) for k in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    schema = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), *long, *([("ids", pa.binary())] if with_ids else [])])
    return placed.mapInArrow(cut, "doc_id long, source string, " + ", ".join(f"{k} long" for k, _ in long) + (", ids binary" if with_ids else ""))


def vocabulary_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY), public_tokenizers.path(RANKS)


def op3_pack_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), *vocabulary_paths())
