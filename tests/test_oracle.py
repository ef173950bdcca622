"""Every query with a SQL counterpart, side by side on the smallest tables."""

import math
import os
from functools import lru_cache

import duckdb
import pytest

import __spark_entry__ as contract
from leadtime.checks.registry import QUERIES, SQL  # the corpus operators have tests of their own

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


#: Models need more rows than the smallest tables have: below twice a leaf's least rows no tree splits.
LEARNING = ("ml_4", "ml_5", "ml_7", "ml_8", "ml_9", "ml_10", "ml_11")
MIDDLE = "/root/testdata/sf0.01"


@lru_cache
def duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        if os.path.exists(f"{sf}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def _plain(v):
    return None if isinstance(v, float) and math.isnan(v) else v


def _sorted(columns, rows):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows),
                  key=lambda row: tuple((v is None, str(v)) for v in row))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf, name):
    sf = MIDDLE if name.startswith(tuple(f"{n}_" for n in LEARNING)) else sf
    df = QUERIES[name](spark, sf)
    ours = _sorted(df.columns, [tuple(r) for r in df.collect()])
    cur = duck(sf).execute(SQL[name])
    columns = [d[0] for d in cur.description]
    theirs = _sorted(columns, cur.fetchall())
    assert sorted(df.columns) == sorted(columns)
    assert len(ours) == len(theirs)
    for a, b in zip(ours, theirs):
        for x, y in zip(a, b):
            if isinstance(x, float) and isinstance(y, float):
                assert math.isclose(x, y, rel_tol=1e-6, abs_tol=2e-6), (name, a, b)
            else:
                assert x == y, (name, a, b)


def test_sql_only_for_existing_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).count() == 4


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_queries_without_sql_run(spark, name):
    """These have no counterpart in SQL."""
    assert QUERIES[name](spark, "/root/testdata/sf0.01").count() > 0
