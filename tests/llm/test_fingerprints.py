import hashlib
import math
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tabforge.llm import fingerprints as fp
from tests.llm.conftest import CLASHING, ODD

MOD = 1 << 32


def plain_vector(paragraph):
    digest = hashlib.sha512(paragraph.encode()).hexdigest()
    words = re.findall(r"[^\x20\x09-\x0D]+", paragraph)
    out = [int(digest[8 * j : 8 * j + 8], 16) for j in range(fp.EXACT)]
    signs = [0] * fp.LIKE
    for pair in zip(words, [*words[1:], "\n"]):
        for seed in range(fp.LIKE // 64):
            h = xxhash.xxh64(seed.to_bytes(4, "little"), 42).intdigest()
            for w in pair:
                h = xxhash.xxh64(w.encode(), h).intdigest()
            for j in range(32):
                signs[64 * seed + 2 * j] += 1 if h >> j & 1 else -1
                signs[64 * seed + 2 * j + 1] += 1 if h >> (j + 32) & 1 else -1
    return [*out, *(x % MOD for x in signs)]


def plain_fingerprint(text):
    total = [0] * (fp.EXACT + fp.LIKE)
    for paragraph in (text or "").split("\n"):
        total = [(a + b) % MOD for a, b in zip(total, plain_vector(paragraph))]
    return total


def plain_likeness(a, b):
    if a == b:
        return 1.0
    x, y = ([v - MOD if v >= MOD // 2 else v for v in f[fp.EXACT :]] for f in (a, b))
    dot = lambda p, q: float(sum(i * j for i, j in zip(p, q)))
    size = math.sqrt(dot(x, x)) * math.sqrt(dot(y, y))
    return min(1.0, max(0.0, dot(x, y) / size)) if size else 0.0


def hexed(f):
    return "".join(f"{v:08x}" for v in f)


def plain_rows(rows):
    """Rows with different (doc_id, text), or alike ones where it makes no difference which comes first."""
    h = lambda t: (xxhash.xxh64(t.encode(), 42).intdigest() ^ 1 << 63) - (1 << 63)
    order = sorted(((r[0] is None, r[0] or 0, h(r[1] or ""), r[1] or "") for r in rows))
    out = []
    for here, after in zip(order, order[1:] + order[:1]):
        text, half = here[3], len(here[3]) // 2
        edited = text[: len(text) - half] + after[3][:half]
        own, changed, following = (plain_fingerprint(t) for t in (text, edited, after[3]))
        out.append((str(None if here[0] else here[1]), len(text), hashlib.sha256(edited.encode()).hexdigest(), hexed(own), hexed(changed),
                    round(plain_likeness(own, changed), 9), round(plain_likeness(own, following), 9)))
    return sorted(out)


def found(frame):
    return sorted((str(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in frame.collect())


@pytest.mark.parametrize("blocks", [1, 3, 40])
def test_against_brute_force_on_odd_rows(docs_of, blocks):
    rows = [r if len(r[1] or "") < 9999 else (r[0], "word " * 300) for r in ODD]
    rows += [(50, "é à\U0001f600 ü\nzwei Zeilen"), (51, "same\n\nparagraphs here"), (52, "paragraphs here\nsame\n"), (-3, "below zero"), (60, "x"), (None, "")]
    got = found(fp.edited_fingerprints(docs_of(rows, extra=CLASHING), blocks))
    assert got == plain_rows(rows)


def test_one_row_follows_itself_and_no_rows(docs_of):
    row, = fp.edited_fingerprints(docs_of([(7, "abcdef")])).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and row.near_next == 1.0
    assert fp.edited_fingerprints(docs_of([])).collect() == []


def test_query_against_brute_force(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert found(fp.op12_fingerprints(spark, sf_small)) == plain_rows(rows)


def test_order_insertion_and_deletion(spark):
    rng = random.Random(1)
    paragraphs = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 4) for _ in range(rng.randint(0, 12))) for _ in range(40)]
    shuffled = rng.sample(paragraphs, 40)
    texts = {"whole": paragraphs, "shuffled": shuffled, "first": paragraphs[:13], "rest": paragraphs[13:], "other": paragraphs[:-1] + ["new"]}
    frame = spark.createDataFrame([(k, "\n".join(v)) for k, v in texts.items()], "name string, text string")
    got = {r["name"]: r["fingerprint"] for r in fp.fingerprints(frame, "text", ["name"]).collect()}
    assert got["whole"] == got["shuffled"] != got["other"]
    row = spark.createDataFrame([(got["whole"], got["first"], got["rest"])], "w array<long>, f array<long>, r array<long>")
    out = row.select(fp.added(F.col("f"), F.col("r")).alias("sum"), fp.removed(F.col("w"), F.col("r")).alias("left")).first()
    assert out["sum"] == got["whole"] and out["left"] == got["first"]


def test_likeness_follows_the_share_of_common_words(spark, docs_of):
    rng = random.Random(2)
    words = lambda n: " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(n))
    rows = [(i, words(200)) for i in range(60)]
    got = fp.edited_fingerprints(docs_of(rows)).collect()
    assert all(0.25 < r.near_edited < 0.75 for r in got) and all(r.near_next < 0.4 for r in got)
    assert sum(r.near_edited for r in got) / 60 == pytest.approx(0.5, abs=0.05)


def test_plan_has_no_python_and_no_single_partition(spark, sf_small):
    plan = fp.op12_fingerprints(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "SinglePartition" not in plan and "ArrowEval" not in plan


def test_a_text_of_many_megabytes(docs_of):
    text = "ab cd\n" * 500_000
    row, = fp.edited_fingerprints(docs_of([(1, text)])).collect()
    assert row.n_chars == len(text)
    one, last = plain_vector("ab cd"), plain_vector("")
    assert row.fingerprint == hexed([(500_000 * a + b) % MOD for a, b in zip(one, last)])
