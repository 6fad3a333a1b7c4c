import collections
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabforge.llm import context_tree, quality_classifier, quality_rules, url_filters
from tests.llm.conftest import CLASHING, ODD


@pytest.fixture
def con():
    return duckdb.connect()


def in_duckdb(con, df, name, sql):
    con.register(name, df.toArrow())
    res = con.execute(sql)
    return [d[0] for d in res.description], res.fetchall()


def same_rows(df, names, rows):
    key = lambda r: str(r)
    got = [tuple(r[n] for n in sorted(names)) for r in df.collect()]
    order = [names.index(n) for n in sorted(names)]
    assert sorted(got, key=key) == sorted((tuple(r[i] for i in order) for r in rows), key=key)


def test_rules_match_sql_on_random_texts(docs_of, con):
    rng = random.Random(4)
    def text():
        w = [rng.choice("abcde") * rng.randint(1, 3) + rng.choice(("", "", "#", "|")) for _ in range(rng.randint(0, 120))]
        return "".join(x + rng.choice((" ", " ", "\n", "\t ", "\n\n")) for x in w)
    rows = [(i, text(), rng.choice(("en", "de")), rng.choice(("a", "b"))) for i in range(150)] + [(200, None), (201, "")]
    docs = docs_of(rows)
    same_rows(quality_rules.judge(docs), *in_duckdb(con, docs, "documents", quality_rules.OP8_SQL))


def test_repeated_words_by_brute_force(spark):
    rng = random.Random(8)
    rows = [(i, [rng.choice("ab") if rng.random() < 0.4 else str(rng.randint(0, 30)) for _ in range(rng.randint(0, 40))]) for i in range(200)]
    got = spark.createDataFrame(rows, "i int, w array<string>").select("i", quality_rules.repeated_words(F.col("w"))).collect()
    for i, n in got:
        w = rows[i][1]
        windows = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        count = collections.Counter(windows)
        assert n == len({p for k, x in enumerate(windows) if count[x] > 1 for p in (k, k + 1, k + 2)})


def test_rules_on_odd_rows(docs_of):
    got = quality_rules.judge(docs_of(ODD, extra=CLASHING)).collect()
    assert len(got) == len(ODD) and all(r.base_failed and not r.kept for r in got)
    assert quality_rules.judge(docs_of([])).collect() == []


def test_thresholds_adapt_to_the_group(docs_of):
    # Words of 12 letters are usual in one source and far out in the other.
    rows = [(i, " ".join(f"{'x' * (12 if s == 'long' else 4)}{i}{k}" for k in range(60)), "en", s) for s, at in (("long", 0), ("short", 100)) for i in range(at, at + 80)]
    rows.append((999, " ".join(f"{'x' * 40}{k}" for k in range(60)), "en", "short"))
    got = {r.doc_id: r for r in quality_rules.judge(docs_of(rows)).collect()}
    assert all(r.kept for k, r in got.items() if k != 999) and got[999].failed_rules == "word_length"


URLS = [(1, "http://a.example.com/en/1"), (2, "https://www.example.com/en/x"), (3, "http://WWW.Example.COM"), (4, "http://b.net/es/5?x=/fr/"), (5, "//no-scheme/es/"), (6, None), (7, ""),
        (8, "http://b.net/fr#top"), (9, "http://evilnet/es/1"), (10, "x://y://z.net/es/"), (11, "http://c.net/a//b/" + "d/" * 500), (1, "http://a.example.com/en/1"), (None, "http://q.org/?a")]


def test_urls_match_sql(spark, con):
    rng = random.Random(2)
    many = [(100 + i, f"http://{rng.choice(('h.example.net', 'k.example.org'))}/{rng.choice(('es', 'fr', 'de', 'shop'))}/{rng.choice((str(i), f'title-{i}', 'index.html', 'deadbeefdeadbeef00'))}") for i in range(300)]
    pages = spark.createDataFrame(URLS + many, "page_id long, url string").withColumn("rule", F.lit("x"))
    same_rows(url_filters.filter_urls(pages), *in_duckdb(con, pages.select("page_id", "url"), "pages", url_filters.OP5_SQL))


def test_url_rules(spark):
    got = {r.page_id: r for r in url_filters.filter_urls(spark.createDataFrame(URLS, "page_id long, url string")).collect()}
    assert (got[1].rule, got[1].verdict) == ("example.com/en/", "block") and (got[2].rule, got[2].verdict) == ("www.example.com/en/", "allow")
    assert (got[3].host, got[3].path, got[3].rule) == ("www.example.com", "", None) and got[4].rule == "net/es/"
    assert (got[5].host, got[5].path, got[6].verdict) == ("", "", "allow") and got[8].rule is None and got[9].rule is None and (got[10].host, got[10].path) == ("y:", "//z.net/es/")
    assert url_filters.filter_urls(spark.createDataFrame([], "page_id long, url string")).collect() == []


def test_templates_generalise_and_reject(spark):
    rows = [("h", f"/spam/item-{i}", 1, 1) for i in range(40)] + [("h", f"/news/{i}", 0, 1) for i in range(40)] + [("h", f"/spam/other-{i}", None, 1) for i in range(10)]
    df = spark.createDataFrame(rows, "host string, path string, blocked int, pages long")
    tree = url_filters.templates(df.select("host", "path"))
    by = {r.path: r.template for r in tree.collect()}
    assert by["/spam/item-3"] == by["/spam/other-1"] == "/spam/*" and by["/news/5"] == "/news/{n}"
    verdict = {r.template: r.reject for r in url_filters.judged(df.join(tree, ["host", "path"])).collect()}
    assert verdict == {"/spam/*": True, "/news/{n}": False}


def held_out_accuracy(spark, path, share):
    docs, labels = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")
    got = quality_classifier.op9_quality_classifier(spark, path).join(labels, "doc_id").where("held_out").collect()
    assert docs.count() and len(got) > 10
    good = [r for r in got if r.quality == 1]
    bad = [r for r in got if r.quality == 0]
    assert np.mean([r.predicted == 1 for r in good]) >= share and np.mean([r.predicted == 0 for r in bad]) >= share


def test_classifier_on_held_out_rows(spark):
    held_out_accuracy(spark, "/root/testdata/sf0.01", 0.95)


def test_classifier_edge_cases(spark, docs_of):
    bad, good = [(f"{i}", "!! %%% ## " * (5 + i), 0) for i in range(20)], [(f"{i}", f"the cat number {i} sat here " * 3, 1) for i in range(20, 60)]
    training = spark.createDataFrame([(int(a), b, c) for a, b, c in bad + good] + [(900, None, 1), (901, "", 0), (902, "odd label", None), (903, "odd label", 7)], "doc_id long, text string, quality int")
    known = quality_classifier.training_labels(training)
    model = quality_classifier.fit(training, known)
    out = quality_classifier.classify(docs_of(ODD + [(50, "%%% !! ## %%% !! ##")], extra=CLASHING), model).select("row.doc_id", "score", "predicted").collect()
    assert len(out) == len(ODD) + 1 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out)
    assert [r.predicted for r in out if r.doc_id == 50] == [0]
    assert quality_classifier.fit(training, known.where("quality = 1")) is None and quality_classifier.fit(training.where("false"), known) is None
    assert {r.predicted for r in quality_classifier.classify(docs_of(ODD), None).collect()} == {1}
    assert quality_classifier.classify(docs_of([]), model).collect() == []


def test_dual_coordinate_descent_separates():
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 50, 8) + (50 if k % 2 else 0)) for k in range(80)]
    y = np.array([1.0 if k % 2 else -1.0 for k in range(80)])
    ratio = np.ones(1 << quality_classifier.BITS)
    w = quality_classifier.dual_coordinate_descent(rows, y, ratio)
    assert all((w[r].sum() + w[-1]) * t > 0 for r, t in zip(rows, y))


def test_features_count_repeats_only_by_presence():
    once, = quality_classifier.features(pa.array(["abc abd"]))
    assert set(once[: len("abc abd")].tolist()) == set(b"abc abd")


def tokens(t):
    return re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def tree_by_hand(train, tests, depth):
    count = collections.defaultdict(lambda: [0, 0])

    def steps(t):
        s = " ".join(tokens(t)).encode() + b"\n"
        h = b"\n" * depth + s
        for j, x in enumerate(s):
            p = 1
            for i in range(8):
                bit = (x >> (7 - i)) & 1
                yield h[j : j + depth], p, bit
                p = 2 * p + bit

    for t in train:
        for context, p, bit in steps(t):
            for k in range(depth + 1):
                count[context[depth - k :], p][bit] += 1
    children = collections.defaultdict(set)
    for s, p in count:
        if s:
            children[s[1:], p].add((s, p))
    kt = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(n):
        own = kt(*count[n])
        return own if len(n[0]) == depth else np.logaddexp(own, sum(map(weighted, children[n]))) - math.log(2)

    def one(context, p, k=0):
        n = (context[depth - k :], p)
        a, b = count.get(n, (0, 0))
        if k == depth:
            return (b + 0.5) / (a + b + 1)
        w = 0.5 * math.exp(kt(a, b) - (weighted(n) if n in count else 0.0))
        return w * (b + 0.5) / (a + b + 1) + (1 - w) * one(context, p, k + 1)

    return [sum(math.log10(one(c, p) if bit else 1 - one(c, p)) for c, p, bit in steps(t)) for t in tests]


def base_by_hand(train, tests):
    count = collections.Counter(x for t in train for x in [*tokens(t), "\n"])
    n, v = count.total(), len(count)
    return [(len(tokens(t)) + 1, sum(count[x] > 0 for x in [*tokens(t), "\n"]), n, sum(math.log10((count[x] + 1) / (n + v + 1)) for x in [*tokens(t), "\n"])) for t in tests]


@pytest.mark.parametrize("block_bytes", [1, 30, 1 << 20])
def test_context_tree_by_hand(spark, block_bytes):
    rows = [(1, "The cat sat on the mat", True), (2, "the cat  ate\tthe rat", True), (3, "a new xyzzy cat ü", False), (4, None, False), (5, "", True), (5, "", True), (None, "cat", False)]
    got = context_tree.score(spark.createDataFrame(rows, "doc_id long, text string, train boolean").repartition(3), depth=3, block_bytes=block_bytes).collect()
    train, tests = [t for _, t, k in rows if k], [t for _, t, _ in rows]
    want = sorted((str(r[0]), s, *b) for r, s, b in zip(rows, tree_by_hand(train, tests, 3), base_by_hand(train, tests)))
    for g, w in zip(sorted((str(r.doc_id), r.score, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), want, strict=True):
        assert g == (w[0], pytest.approx(w[1], abs=1e-5), *w[2:5], pytest.approx(w[5], abs=1e-9))


def test_context_tree_edges(spark, docs_of):
    odd = context_tree.score(docs_of(ODD, extra=CLASHING).withColumn("train", F.lit(True))).collect()
    assert len(odd) == len(ODD) and all(r.score < 0 and r.n_tokens >= 1 for r in odd)
    none = context_tree.score(docs_of(ODD).withColumn("train", F.lit(False))).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.bits_per_byte == pytest.approx(8) for r in none)
    assert context_tree.score(docs_of([]).withColumn("train", F.lit(True))).collect() == []


def test_sealed_numbers_open_again():
    n = np.sort(np.random.default_rng(1).integers(0, 2**64, 1000, dtype=np.uint64))
    assert (context_tree.opened(context_tree.sealed(n, True), 1000, True) == n).all() and (context_tree.opened(context_tree.sealed(n), 1000) == n).all()


def test_op6_baseline_on_the_small_table(spark, sf_small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    want = base_by_hand([t for d, t in rows if zlib.crc32(str(d).encode()) % 7 != 2], [t for _, t in rows])
    got = {r.doc_id: r for r in context_tree.op6_context_tree(spark, sf_small).collect()}
    for (d, _), w in zip(rows, want):
        r = got[d]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (*w[:3], zlib.crc32(str(d).encode()) % 7 == 2) and r.base_score == pytest.approx(w[3], rel=1e-10)
    assert sum(r.score for r in got.values() if r.held_out) / sum(r.n_bytes for r in got.values() if r.held_out) > -1
