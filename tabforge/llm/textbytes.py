"""Words of a batch of texts as NumPy arrays over their UTF-8 bytes, for operators that work in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: An odd multiplier for polynomial hashes modulo 2**64, and its inverse.
_BASE = 0x9E3779B97F4A7C55
_BACK = pow(_BASE, -1, 1 << 64)
#: Bytes of text that are worked on at once; a longer text is taken alone.
CHUNK = 1 << 20


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the SplitMix64 finaliser)."""
    h = h.astype(np.uint64, copy=True)
    for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h ^= h >> np.uint64(shift)
        h *= np.uint64(times)
    return h ^ (h >> np.uint64(31))


class _Tables(dict):
    """Powers by (base, size); a task starts with none."""

    def __reduce__(self):
        return _Tables, ()


_TABLES = _Tables()


def _powers(base: int, n: int) -> np.ndarray:
    size = 1 << max(16, (n - 1).bit_length())
    if (base, size) not in _TABLES:
        if len(_TABLES) > 3:
            _TABLES.clear()
        p = np.full(size, base, np.uint64)
        p[0] = 1
        _TABLES[base, size] = np.multiply.accumulate(p)
    return _TABLES[base, size]


def text_chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, ends): the texts of some rows, each followed by one space; null is empty.

    ``ends`` has the place just after each text's own space.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, 8 * column.offset) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        own = offsets[row : end + 1] - offsets[row]
        raw = np.insert(data[offsets[row] : offsets[end]], own[1:], 32)
        yield row, end, raw, own[1:] + np.arange(1, end - row + 1)
        row = end


def lowered(raw: np.ndarray) -> np.ndarray:
    return np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)


def is_space(raw: np.ndarray) -> np.ndarray:
    return (raw == 32) | ((raw >= 9) & (raw <= 13))


class Words:
    """``start`` and ``stop`` of every word, ``hash`` of its bytes, and ``of``: where each text's words begin, with the total last."""

    def __init__(self, raw: np.ndarray, ends: np.ndarray):
        solid = ~is_space(raw)
        edge = np.flatnonzero(np.diff(solid.astype(np.int8), prepend=0, append=0))
        self.start, self.stop = edge[::2], edge[1::2]
        self.hash = span_hashes(raw, self.start, self.stop)
        self.of = np.concatenate([[0], np.searchsorted(self.start, ends)])


def span_hashes(raw: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans: equal spans have equal hashes wherever they lie."""
    if not len(start):
        return np.zeros(0, np.uint64)
    run = np.empty(len(raw) + 1, np.uint64)
    run[0] = 0
    np.cumsum((raw + np.uint64(1)) * _powers(_BASE, len(raw))[: len(raw)], out=run[1:])
    h = (run[stop] - run[start]) * _powers(_BACK, len(raw))[start]
    return mixed(h + (stop - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the ``size``-word windows of a sequence of word hashes; of the whole sequence where it is shorter."""
    if not len(words):
        return words
    n = max(1, len(words) - size + 1)
    h = np.zeros(n, np.uint64)
    for i in range(min(size, len(words))):
        h = mixed(h + words[i : i + n]) * np.uint64(_BASE)
    return mixed(h + np.uint64(min(size, len(words))))
