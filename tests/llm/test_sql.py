"""Queries with SQL against DuckDB, over awkward and over empty tables."""

import duckdb
import pytest

from tidecast.llm.queries import QUERIES, SQL

from . import edge

TABLES = {"documents": edge.documents, "pages": edge.pages, "conversations": edge.conversations}


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    root = {}
    for kind in ("full", "empty"):
        root[kind] = str(tmp_path_factory.mktemp(kind))
        for name, make in TABLES.items():
            df = make(spark) if kind == "full" else edge.empty(make(spark))
            df.coalesce(2).write.parquet(f"{root[kind]}/{name}.parquet")
    return root


def check(spark, key, root, glob):
    df = QUERIES[key](spark, root)
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{root}/{name}.parquet{glob}'")
    want = con.execute(SQL[key])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(df.columns)
    rows = lambda xs: sorted(([repr(x[c]) for c in sorted(names)] for x in xs))
    got = rows(df.collect())
    assert got == rows([dict(zip(names, r)) for r in want.fetchall()])
    return got


@pytest.mark.parametrize("key", sorted(SQL))
def test_awkward(spark, awkward, key):
    assert check(spark, key, awkward["full"], "/*.parquet")


@pytest.mark.parametrize("key", sorted(SQL))
def test_empty(spark, awkward, key):
    assert check(spark, key, awkward["empty"], "/*.parquet") == []


@pytest.mark.parametrize("key", sorted(SQL))
def test_given_tables(spark, sf, key):
    assert check(spark, key, sf, "")
