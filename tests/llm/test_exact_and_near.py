import collections
import hashlib
import re

import numpy as np
import pytest

import corpus_pipeline
from tabforge.llm import near_dedup
from tabforge.llm.components import connected
from tabforge.llm.exact_dedup import QuotientFilter, exact_duplicates, repeated_fingerprints
from tests.llm.conftest import ODD


def test_quotient_filters_merge_without_loss():
    rng = np.random.default_rng(3)
    parts = [rng.integers(0, 1 << 20, 5000).astype(np.uint64) for _ in range(4)]
    whole = None
    for p in parts:
        one = QuotientFilter.load(QuotientFilter.build(*np.unique(p, return_counts=True), 8).dump())
        whole = one if whole is None else whole.merge(one)
    keys, counts = QuotientFilter.load(whole.dump()).items()
    assert dict(zip(keys.tolist(), counts.tolist())) == collections.Counter(np.concatenate(parts).tolist())


def test_empty_quotient_filter():
    none = QuotientFilter.build(np.zeros(0, np.uint64), np.zeros(0, np.int64), 8)
    assert len(QuotientFilter.load(none.dump()).items()[0]) == 0


def test_repeated_fingerprints_over_slices(spark):
    rows = [(i % 700 - 350,) for i in range(1000)]
    got = {r.fp: r.copies for r in repeated_fingerprints(spark.createDataFrame(rows, "fp long").repartition(5), per_slice=50).collect()}
    assert got == {k: n for k, n in collections.Counter(r[0] for r in rows).items() if n > 1}


def test_exact_duplicates_on_odd_rows(docs_of):
    rows = ODD + [(9, "one  two\tthree four\nfive six seven"), (10, "first text")]
    got = exact_duplicates(docs_of(rows, extra=("sha", "fp", "norm"))).collect()
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    size = collections.Counter(norm(r[1]) for r in rows)
    first = {}
    for r in rows:
        if r[0] is not None:
            first[norm(r[1])] = min(first.get(norm(r[1]), r[0]), r[0])
    want = sorted((str(r[0]), first.get(norm(r[1])), size[norm(r[1])], hashlib.sha256(norm(r[1]).encode()).hexdigest()) for r in rows)
    assert sorted((str(r.doc_id), r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


@pytest.mark.parametrize("call", [exact_duplicates, near_dedup.near_duplicates])
def test_empty_table(docs_of, call):
    assert call(docs_of([])).collect() == []


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7)]
    got = {r.id: r.label for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(60)}


def brute_force(rows, words, percent):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        sets[d] = {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {d: (len(sets[d]), root(d), root(d) == d) for d in ids}


def near_copies(seed, groups=12, copies=9):
    rng = np.random.default_rng(seed)
    vocabulary = [f"W{i}" for i in range(3000)]
    rows, d = [], 0
    for g in range(groups):
        base = list(rng.choice(vocabulary, rng.integers(3, 160)))
        for c in range(copies):
            text = list(base)
            for _ in range(rng.integers(0, 1 + len(base) // 25)):
                text[rng.integers(len(text))] = str(rng.choice(vocabulary))
            rows.append((d, " ".join(text).upper() if c % 3 else "  ".join(text)))
            d += 1
    return rows + [(d, None), (d + 1, ""), (d + 2, "solo"), (d + 3, "SOLO"), (d + 4, "solo solo")]


@pytest.mark.parametrize("words", [4, 5])
def test_near_duplicates_match_brute_force(spark, words):
    rows = near_copies(words)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(df, words=words).collect()}
    assert got == brute_force(rows, words, 80)


@pytest.mark.parametrize(("limit", "most"), [("BLOCK", 5), ("BLOCK_SHINGLES", 300)])
def test_large_groups_are_dealt_into_blocks(spark, monkeypatch, limit, most):
    monkeypatch.setattr(near_dedup, limit, most)
    rows = near_copies(11, groups=3, copies=25)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(df).collect()}
    assert got == brute_force(rows, 5, 80)


def test_op10_matches_brute_force_on_the_small_table(spark, sf_small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.op10_near_dedup(spark, sf_small).collect()}
    assert got == brute_force(rows, 4, 80)


def test_an_id_with_two_texts_is_linked_by_both(docs_of):
    text = lambda name, edit="": " ".join(f"{name}{k}" for k in range(60)) + edit
    # Id 5 holds a near copy of 2's text and one of 3's, and a text of its own; 1's two texts have near copies in 7 and 8.
    rows = [(2, text("a")), (3, text("b")), (5, text("a", " x")), (5, text("b", " x")), (5, text("c")), (1, text("d")), (1, text("e")), (7, text("d", " x")), (8, text("e", " x"))]
    for order in (rows, rows[::-1]):
        df = docs_of(order)
        got = sorted((r.doc_id, r.component_id) for r in near_dedup.near_duplicates(df).collect())
        assert got == [(1, 1), (1, 1), (2, 2), (3, 3), (5, 2), (5, 3), (5, 5), (7, 1), (8, 1)]
        left = sorted((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(df.sparkSession, df, "").collect())
        assert left == sorted([rows[0], rows[1], rows[4], rows[5], rows[6]])


def test_near_duplicates_on_odd_rows(docs_of):
    got = near_dedup.near_duplicates(docs_of(ODD, extra=("set_key", "registers", "id"))).collect()
    assert len(got) == len(ODD)
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    assert all(r.kept for r in got)


@pytest.mark.parametrize("n", [5, 60, 3000])
def test_hyperminhash_estimate(n):
    rng = np.random.default_rng(n)
    off = []
    for _ in range(40):
        u = rng.integers(0, 2**64, size=n, dtype=np.uint64)
        c = round(0.8 * n)
        half = c + (n - c) // 2
        a, b = u[:half], np.concatenate([u[:c], u[half:]])
        got = near_dedup.estimate(near_dedup.registers(a)[None], np.array([len(a)]), near_dedup.registers(b)[None], np.array([len(b)]))[0, 0]
        off.append(got - c / n)
    assert abs(np.mean(off)) < 0.03 and np.std(off) < 0.07


def test_registers_of_extreme_hashes():
    r = near_dedup.registers(np.array([0, 1, 2**57 - 1, 2**64 - 1], np.uint64))
    assert r[0] >> near_dedup.MANTISSA == 58 and r[-1] >> near_dedup.MANTISSA == 1 and (r[1:-1] == 0).all()
