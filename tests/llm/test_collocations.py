import collections
import random
import re

import numpy as np
import pytest

from tabforge.llm import collocations as co
from tests.llm.conftest import CLASHING, ODD


def test_summaries_keep_every_frequent_key_in_any_merge_order():
    rng = np.random.default_rng(2)
    stream = (rng.zipf(1.2, 40_000) % 5000).astype(np.uint64)
    counts = collections.Counter(stream.tolist())
    for threshold in (50, 100, 400):
        capacity = len(stream) // threshold + 1
        parts = []
        for piece in np.array_split(stream, 13):
            one = co.Summary(capacity)
            for bit in np.array_split(piece, 5):
                one.merge(*np.unique(bit, return_counts=True))
                assert len(one.keys) <= capacity
            parts.append(one)
        whole = co.Summary(capacity)
        for one in rng.permutation(np.array(parts, object)):
            whole.lost += one.lost
            whole.merge(*co.unpacked(co.packed(one.keys, one.counts)))
        assert len(whole.keys) <= capacity and whole.lost <= len(stream) / (capacity + 1)
        kept = dict(zip(whole.keys.tolist(), whole.counts.tolist()))
        assert all(counts[k] - whole.lost <= n <= counts[k] for k, n in kept.items())
        assert {k for k, n in counts.items() if n >= threshold} <= set(whole.frequent(threshold).tolist())


def test_filter_holds_what_was_put_in(spark):
    keys = [(-(2**63),), (2**63 - 1,), (0,), (-1,), (12345678901234567,)]
    bits = co.filter_of(spark.createDataFrame(keys, "key long"), 12)
    assert len(bits) == 512 and int(np.unpackbits(bits).sum()) == len(keys)
    assert co.passes(bits, np.array([k[0] for k in keys], np.int64).view(np.uint64)).all()
    assert not co.passes(bits, np.array([1 << 61], np.uint64)).any()


def plain(rows, threshold, longest=5, top=2000, percent=100):
    """(lang, rank, phrase, a, l, r, n, score) by counting everything."""
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    f[lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if a >= threshold and len(p) > 1}
        outer = collections.Counter()
        for p, a in cand.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    outer[p[i : i + size]] = max(a, outer[p[i : i + size]])
        lines = []
        for p, a in cand.items():
            if 100 * outer[p] >= percent * a:
                continue
            score, _, left, right = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            lines.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(lines)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def rows_of(frame):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in frame.collect())


def made(seed, rows=60):
    rng = random.Random(seed)
    vocabulary = ["The", "the", "of", "ÉTÉ", "été", "x-ray", "new", "york", "city", "b#"] + [f"w{i}" for i in range(30)]
    ends = [" ", " ", "  ", "\t", ". ", ", ", "\n", "!"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    return [("".join(w + rng.choice(ends) for w in rng.choices(vocabulary, weights, k=rng.randint(0, 150))) + "new york city hall. " * rng.randint(0, 3), rng.choice(["en", "de", None])) for _ in range(rows)]


@pytest.mark.parametrize("how", [{}, {"part_mass": 50, "held": 300, "filter_bits": 8}, {"part_mass": 1 << 40, "held": 1, "filter_bits": 6}])
def test_against_brute_force(docs_of, how):
    rows = made(3)
    docs = docs_of([(i, t, lang) for i, (t, lang) in enumerate(rows)], extra=CLASHING).repartition(5)
    got = rows_of(co.collocations(docs, threshold=7, **how))
    assert got == plain(rows, 7) and len(got) > 40


def test_top_lines_and_shorter_phrases(docs_of):
    rows = made(5)
    docs = docs_of([(i, t, lang) for i, (t, lang) in enumerate(rows)])
    assert rows_of(co.collocations(docs, threshold=5, longest=3, top=9)) == plain(rows, 5, 3, 9)


def test_odd_rows_and_a_text_longer_than_a_chunk(docs_of):
    rows = [(r[1], r[2] if len(r) > 2 else "en") for r in ODD] + [("a b c d e f. " * 100_000, "fr"), (None, None)]
    docs = docs_of([(None, t, lang) for t, lang in rows])
    assert rows_of(co.collocations(docs)) == plain(rows, 100)


def test_empty_table(docs_of):
    assert co.collocations(docs_of([])).collect() == []
    assert co.collocations(docs_of([(1, None), (2, " . ")])).collect() == []


def test_scores_past_64_bits(spark):
    big = 3 * 10**14
    counts = spark.createDataFrame([("en", "", 0, 9 * 10**17), ("en", "a", 1, big), ("en", "b", 1, big + 7), ("en", "a b", 2, big - 1)], "lang string, phrase string, size int, count long")
    row, = co.scored(counts).collect()
    assert row.score == 1000 * (big - 1) * 9 * 10**17 // (big * (big + 7))
