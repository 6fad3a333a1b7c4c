import collections
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabforge.llm import mixing, packing
from tabforge.llm.textbytes import text_chunks
from tests.llm.conftest import CLASHING, ODD


def water_fill(sizes, share=1.5, most=2.0, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    left = share * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not full:
            return target | {s: level * weight[s] for s in open_}
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= full
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": rng.choice((0, 1, 10, 1000, 40_000)) * rng.randint(1, 9) for i in range(9)} | {None: 500}
    got = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    want = water_fill(sizes)
    for r in got:
        assert r.target == pytest.approx(want[r.source], abs=0.01)


def test_mix_takes_the_targets_and_repeats(spark, docs_of):
    rng = random.Random(5)
    rows = [(i, "w " * rng.randint(0, 60), "en", rng.choice(("a", "a", "a", "b", "c", None))) for i in range(400)]
    docs = docs_of(rows)
    sized = docs.select("doc_id", "source", F.size(F.array_remove(F.split("text", " "), "")).cast("long").alias("size"))
    got = mixing.mix(sized).collect()
    assert len(got) == 400
    taken, target, size = collections.Counter(), {}, collections.Counter()
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and r.taken == sum(d.words for d in r.draws)
        taken[r.source] += r.taken
        size[r.source] += r.size
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 1 for s in target) and target == pytest.approx(water_fill(size), abs=0.01)
    again = {r.doc_id: r.draws for r in mixing.mix(sized.repartition(7)).collect()}
    assert again == {r.doc_id: r.draws for r in got}


def test_splitting_tree_is_exact_and_fair(spark):
    quotas = {"a": 900, "b": 300, None: 37, "none": 0}
    df = spark.createDataFrame(list(quotas.items()), "source string, quota long")
    total = collections.Counter()
    for seed in ("x", "y", "z"):
        got = mixing.split_quotas(df, 11, seed).collect()
        by = {s: sorted((r.shard, r.first, r.last) for r in got if r.source == s) for s in quotas}
        for s, spans in by.items():
            assert [k for k, _, _ in spans] == list(range(11)) and spans[0][1] == 0 and spans[-1][2] == quotas[s]
            assert all(a[2] == b[1] for a, b in zip(spans, spans[1:]))
        slots = [sum(x[i][2] - x[i][1] for x in by.values()) for i in range(11)]
        assert max(slots) - min(slots) <= 1
        total.update({i: by["a"][i][2] - by["a"][i][1] for i in range(11)})
    expected = 3 * 900 / 11
    assert all(abs(n - expected) < 5 * (expected * (1 - 900 / 1237)) ** 0.5 + 3 for n in total.values())


@pytest.mark.parametrize(("total", "marked", "drawn"), [(20, 7, 9), (5, 5, 2), (5, 0, 2), (0, 0, 0), (400, 100, 40)])
def test_hypergeometric_follows_its_law(spark, total, marked, drawn):
    from math import comb

    n = 400
    us = spark.range(n).select(((F.col("id") + 0.5) / n).alias("u"))
    got = sorted(r[0] for r in us.select(mixing.hypergeometric(F.lit(total), F.lit(marked), F.lit(drawn), F.col("u"))).collect())
    law, at, want = 0.0, max(0, drawn + marked - total) - 1, []
    for u in ((i + 0.5) / n for i in range(n)):
        while law < u - 1e-9:
            at += 1
            law += comb(marked, at) * comb(total - marked, drawn - at) / comb(total, drawn)
        want.append(at)
    assert got == want


def test_mixed_documents_on_odd_rows(docs_of):
    df = docs_of(ODD, extra=CLASHING)
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    words = collections.Counter()
    for r in out.collect():
        words[r.source] += len(r.text.split())
        assert r.n_chars == len(r.text)
    size = collections.Counter()
    for r in ODD:
        size[r[3] if len(r) > 3 else "src0"] += len((r[1] or "").split())
    want = water_fill(size)
    assert all(abs(words[s] - want[s]) <= 1 for s in want)
    assert mixing.mixed_documents(docs_of([])).collect() == [] and mixing.mix(docs_of([]).select("doc_id", "source", F.lit(0).cast("long").alias("size"))).collect() == []


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.vocabulary_paths()[0])


def test_pieces_give_the_tokenizers_ids(tokenizer):
    rng = random.Random(1)
    alphabet = list("ab1!'  \n\t\r\x0b\x1c\u00a0\u2003\u3000\x85é漢ß'll.,😀") + ["<|endoftext|>", " the", "  x", " <|endoftext|> "]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(3000)] + ["", None, " ", "  ", "word " * 5000]
    chunks, got = packing.Chunks(*packing.vocabulary_paths(), keep=500), []
    for _, _, raw, ends in text_chunks(pa.array(texts, pa.string()), limit=4000):
        ids, stops = chunks.encode(raw, ends)
        stops = np.concatenate([[0], stops])
        got += [ids[a:b].tolist() for a, b in zip(stops[:-1], stops[1:])]
    assert got == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_what_a_worker_keeps_of_pieces_is_bounded():
    rng = random.Random(2)
    chunks, most = packing.Chunks(*packing.vocabulary_paths()), 0
    for _ in range(8):  # 600,000 distinct pieces
        texts = pa.array([" ".join(f"w{rng.getrandbits(40):x}" for _ in range(750)) for _ in range(100)])
        for _, _, raw, ends in text_chunks(texts, packing.BYTES):
            chunks.encode(raw, ends)
            most = max(most, len(chunks.known))
    assert most < 400_000


@pytest.mark.parametrize("weights", [None, [5, 2, 1, 1], [0, 0, 0, 1]])
def test_rounds_take_every_token_once_at_the_shares(weights):
    totals = [1000, 50, 0, 700]
    r = packing.Rounds(totals, 100, weights)
    seen = collections.Counter()
    for s, n in enumerate(totals):
        at = 0
        while at < n:
            for _, size, sequence, offset in r.pieces(s, at, min(37, n - at), 16):
                seen.update(range(sequence * 16 + offset, sequence * 16 + offset + size))
            at += 37
    assert seen == collections.Counter(range(sum(totals)))
    first = r.taken(1) - r.taken(0)
    share = np.array([t / sum(totals) for t in totals] if weights is None else [w * (t > 0) for w, t in zip(weights, totals)], float)
    assert abs(first - 100 * share / share.sum()).max() <= 1


def check_packing(rows, pieces, tokenizer, length=1024):
    ids = collections.defaultdict(list)
    for d, t in rows:
        ids[d].append(np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4"))
    places = collections.defaultdict(list)
    got = collections.defaultdict(list)
    for p in pieces:
        places[p.sequence_id].append((p.offset, p.length))
        got[p.doc_id].append(p)
    assert sorted(places) == list(range(len(places)))
    for s, spans in places.items():
        end = 0
        for offset, size in sorted(spans):
            assert offset == end
            end += size
        assert end == length or s == len(places) - 1
    assert set(got) == set(ids)
    for d, texts in ids.items():
        left = collections.Counter((p.start, p.length, p.ids_crc32, p.doc_tokens) for p in got[d])
        for t in texts if len(texts) == 1 else []:
            at = 0
            for start, size, crc, n in sorted(left):
                assert start == at and n == len(t) and crc == zlib.crc32(t[at : at + size].tobytes())
                at += size
            assert at == len(t)
        assert sum(p.length for p in got[d]) == sum(map(len, texts))


def test_op3_covers_every_token_of_the_small_table(spark, sf_small, tokenizer):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    check_packing(rows, packing.op3_pack_mixture(spark, sf_small).collect(), tokenizer)


def test_windows_have_the_target_shares(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = packing.pack(docs, *packing.vocabulary_paths(), length=256, window=4096).collect()
    total, window = collections.Counter(), collections.defaultdict(collections.Counter)
    for r in rows:
        total[r.source] += r.length
        window[r.sequence_id // 16][r.source] += r.length
    for w, got in window.items():
        if w < max(window) - 1:
            assert all(abs(got[s] - 4096 * n / total.total()) <= 1 + len(total) for s, n in total.items())


def test_packing_odd_rows_and_empty_table(docs_of, tokenizer):
    df = docs_of(ODD, extra=CLASHING)
    check_packing([(r[0], r[1]) for r in ODD], packing.pack(df.repartition(3), *packing.vocabulary_paths()).collect(), tokenizer)
    assert packing.pack(docs_of([]), *packing.vocabulary_paths()).collect() == []
    with_ids = packing.pack(df.where("doc_id = 5"), *packing.vocabulary_paths(), with_ids=True).collect()
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in with_ids)


def test_offsets_are_joined_when_too_many_to_broadcast(docs_of, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "BROADCAST_ROWS", 0)
    rows = [(i, re.sub("x", "ab ", "x" * i), "en", f"s{i % 3}") for i in range(40)]
    check_packing([r[:2] for r in rows], packing.pack(docs_of(rows).repartition(4), *packing.vocabulary_paths()).collect(), tokenizer)
