import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.llm import periodic_runs
from tabforge.llm.periodic_runs import SquareCatchers, checked_runs, find_runs, looped
from tabforge.llm.textbytes import Words, text_chunks
from tests.llm.conftest import CLASHING, ODD


def plain_runs(words, least=24, times=3):
    """Every period tried at every word."""
    n, smallest = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, times * q):
                smallest.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((start, q, length) for (start, length), q in smallest.items())


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_collapse(words, runs):
    gone = {i for start, q, length in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def repetitive(rng, words):
    out = []
    while len(out) < words:
        out += [rng.randint(0, rng.choice([1, 2, 5])) for _ in range(rng.randint(1, 25))] * rng.randint(1, 6)
        if rng.random() < 0.3:
            out += out[-rng.randint(1, len(out)) :]
    return out


@pytest.mark.parametrize("least,times", [(24, 3), (6, 3), (4, 2), (1, 2)])
def test_catchers_find_all_runs_however_the_words_arrive(least, times):
    rng = random.Random(least)
    for _ in range(25):
        seq = repetitive(rng, rng.randint(1, 150))
        want = plain_runs(seq, least, times)
        for most in (len(seq), 1, 30):
            catchers, i = SquareCatchers(len(seq) // times, least, times), 0
            while i < len(seq):
                step = rng.randint(1, most) if most < len(seq) else most
                catchers.append(np.array(seq[i : i + step], np.uint64))
                i += step
            assert catchers.finish() == want


def test_one_word_a_hundred_thousand_times():
    catchers = SquareCatchers(33_333)
    catchers.append(np.full(100_000, 7, np.uint64))
    assert catchers.finish() == [(0, 1, 100_000)]


def test_equal_hashes_of_different_words_are_noticed():
    import pyarrow as pa

    text = " ".join(["one", "two"] * 6 + ["one", "other"] * 6)
    (_, _, raw, ends), = text_chunks(pa.array([text]))
    found = Words(raw, ends)
    found.hash[:] = 5  # every word looks alike
    assert checked_runs(raw, found, 6, 3) == [plain_runs(split(text), 6, 3)]


def test_find_runs_on_odd_rows(docs_of):
    rng = random.Random(4)
    rows = ODD + [(20 + i, " \n".join(f"w{w}" for w in repetitive(rng, 120))) for i in range(12)]
    rows += [(40, "a b c " * 9 + "\ttail"), (41, "é\x0bç " * 40), (42, "x " * 23), (43, "x " * 24), (44, "head " + "long phrase of five words " * 3 + "end")]
    got = find_runs(docs_of(rows, extra=CLASHING)).collect()
    want = []
    for r in rows:
        words = split(r[1])
        runs = plain_runs(words) if len(words) < 20_000 else [(0, 1, len(words))]
        want.append((str(r[0]), len(words), runs, plain_collapse(words, runs)))
    assert sorted((str(r.doc_id), r.n_words, [(x.start, x.period, x.length) for x in r.runs], r.collapsed) for r in got) == sorted(want)


def test_a_text_longer_than_a_chunk(docs_of):
    rng = random.Random(9)
    cycle = [f"word{rng.randint(0, 10**6)}" for _ in range(1000)]
    text = " ".join([f"head{i}" for i in range(200_000)] + cycle * 30)
    assert len(text) > 1 << 20
    row, = find_runs(docs_of([(1, text)])).collect()
    assert [(r.start, r.period, r.length) for r in row.runs] == [(200_000, 1000, 30_000)]
    assert row.collapsed == " ".join(text.split(" ")[:201_000])


def test_empty_table(docs_of):
    assert find_runs(docs_of([])).collect() == []


def test_looped_texts(docs_of):
    rows = [(i, " ".join(f"w{j}" for j in range(i % 37))) for i in range(200)] + [(None, "a b")]
    for r in docs_of(rows).select("doc_id", looped(F.col("text"), F.col("doc_id")).alias("text")).collect():
        if r.doc_id is None:
            assert r.text == "a b"
            continue
        assert split(r.text) == looped_words(r.doc_id, split(rows[r.doc_id][1]))


def looped_words(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_query_against_brute_force(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in periodic_runs.op11_periodic_runs(spark, sf_small).collect()}
    assert len(got) == len(docs)
    some = 0
    for d in docs:
        words = looped_words(d.doc_id, split(d.text))
        r = got[d.doc_id]
        if len(words) > 1500:
            continue  # the plain search is quadratic; long texts are tested above
        runs = plain_runs(words)
        some += bool(runs)
        best = min(runs, key=lambda x: (-x[2] * 10**12 // x[1], x[0], x[1]), default=(None, None, None))
        lines = "".join(f"{s},{n},{q}\n" for s, q, n in runs)
        assert (r.n_runs, r.start, r.period, r.length) == (len(runs), *best)
        assert r.exponent_milli == (None if best[0] is None else 1000 * best[2] // best[1])
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(plain_collapse(words, runs).encode()).hexdigest()
    assert some > 3
