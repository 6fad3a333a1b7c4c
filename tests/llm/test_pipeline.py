import re

import corpus_pipeline
from tabforge.llm import packing
from tabforge.llm.common import written
from tests.llm.conftest import CLASHING, ODD
from tests.llm.test_exact_and_near import brute_force as near_by_hand
from tests.llm.test_lines_and_pii import brute_force as lines_by_hand
from tests.llm.test_mixing_and_packing import check_packing, water_fill


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_on_the_small_table(spark, sf_small):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, sf_small), "test-stage")
        kept[name] = docs
        if name != "pack":
            assert docs.columns == columns
        if name == "quality_classifier":
            gone = before.join(docs, "doc_id", "left_anti").join(spark.read.parquet(f"{sf_small}/labels.parquet"), "doc_id").collect()
            assert not [r for r in gone if r.quality == 1]
        if name == "line_dedup":
            want = {d: t for d, t in lines_by_hand([(r.doc_id, r.text) for r in before.collect()], 10).items() if re.search(r"\S", t)}
            assert {d: r.text for d, r in rows_of(docs).items()} == want
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        if name == "minhash_near_dedup":
            by_hand = near_by_hand([(r.doc_id, r.text) for r in before.collect()], 5, 80)
            assert set(rows_of(docs)) == {d for d, (_, _, stays) in by_hand.items() if stays}
        if name == "mix_sources":
            count = lambda df: {s: sum(len(r.text.split()) for r in df.collect() if r.source == s) for s in {r.source for r in df.collect()}}
            got, want = count(docs), water_fill(count(before))
            assert all(abs(got[s] - want[s]) <= 1 for s in want)
        if name == "pack":
            check_packing([(r.doc_id, r.text) for r in before.collect()], docs.collect(), Tokenizer.from_file(packing.vocabulary_paths()[0]))


def test_stages_take_odd_rows_and_clashing_columns(spark, docs_of, sf_small):
    for rows in (ODD, []):
        docs = docs_of(rows, extra=CLASHING)
        for name, stage in corpus_pipeline.STAGES[1:]:
            docs, columns = written(stage(spark, docs, sf_small), "test-stage"), docs.columns
            assert name == "pack" or docs.columns == columns
        assert bool(docs.count()) == bool(rows)
