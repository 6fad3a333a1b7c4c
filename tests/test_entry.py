"""Driver contract and the DuckDB oracle at sf0.001 for every SQL twin."""

import sys

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
SLOW = {"train_select_best", "feature_importance", "save_load_score", "stream_score"}


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["event_type", "rows", "mean_value"]
    assert df.count() == 3


def test_every_sql_has_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_without_the_text_operators(monkeypatch):
    for name in ("tabforge.llm", "corpus_pipeline"):  # None: cannot be imported
        monkeypatch.setitem(sys.modules, name, None)
    assert "flagship" in entry.queries() and not [k for k in entry.queries() if k.startswith("op") or k == "pipeline"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return c


def _canon(rows, names):
    import datetime as dt

    def norm(v):
        if v is None:
            return (0, "")
        if isinstance(v, bool):
            return (3, str(v))
        if isinstance(v, (int, float)):
            return (2, f"{float(v):.9g}")
        if isinstance(v, dt.datetime):
            return (4, v.isoformat())
        return (5, str(v))

    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_oracle(spark, con, sf_small, name):
    df = entry.queries()[name](spark, sf_small)
    res = con.execute(entry.oracle_sql()[name])
    onames = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(onames)
    assert _canon([tuple(r) for r in df.collect()], df.columns) == _canon(res.fetchall(), onames)
