"""The registered queries beside their SQL, and the pipeline stage by stage."""

import math
import random

import duckdb
import pytest

import corpus_pipeline
from leadtime.llm.queries import QUERIES, SQL
from leadtime.plans.lineage import materialize
from tests.llm.data import frame, hostile, sentence, words
from tests.llm.test_decontaminate import _expected as contamination
from tests.llm.test_near_dedup import _expected as near


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = QUERIES[name](spark, sf)
    cur = con.execute(SQL[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    ours = sorted((tuple(r[c] for c in sorted(columns)) for r in df.collect()), key=str)
    order = [columns.index(c) for c in sorted(columns)]
    theirs = sorted((tuple(row[i] for i in order) for row in cur.fetchall()), key=str)
    assert len(ours) == len(theirs)
    for a, b in zip(ours, theirs):
        assert all(math.isclose(x, y, rel_tol=1e-9) if isinstance(x, float) else x == y for x, y in zip(a, b)), (a, b)


def test_names_and_stages():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_pipeline_on_given_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    given = {r.doc_id: r for r in docs.collect()}
    columns = docs.columns
    kept = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        docs = materialize(stage(spark, docs, sf), name)
        kept.append(docs.count())
        if i < 4:
            assert docs.columns == columns
        if name == "quality_classifier":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
            left = {r.doc_id for r in docs.collect()}
            right = [(d in left) == bool(q) for d, q in labels.items()]
            assert sum(right) / len(right) >= 0.97
        if name == "minhash_near_dedup":
            want = near([tuple(r) for r in before], corpus_pipeline.SHINGLE, corpus_pipeline.PERCENT)
            assert {r.doc_id for r in docs.collect()} == {i for i, (_, c) in want.items() if i == c}
        if name == "benchmark_decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
            want = contamination([tuple(r) for r in before], items)
            assert {r.doc_id for r in docs.collect()} == {i for i, x in want.items() if not x[4]}
        if name == "source_mixing":
            total = sum(len(words(r.text)) for r in before)
            taken = sum(len(words(r.text)) for r in docs.collect())
            assert total - 20 <= taken <= total and all(given[r.doc_id].text.startswith(r.text) for r in docs.collect())
    assert kept[-1] == kept[-2] > 0 and docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    rows = sorted(tuple(r) for r in docs.select("start", "n_tokens").collect())
    assert all(a[0] + a[1] == b[0] for a, b in zip(rows, rows[1:]))


@pytest.mark.parametrize("empty", [False, True])
def test_stages_take_hostile_documents(spark, sf, empty):
    rng = random.Random(1)
    docs = frame(spark, [] if empty else hostile() + [(1, sentence(rng, 20), None, None, None, *[None] * 16), (None, "x y", "en", None, 3, *["c"] * 16)])
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf), name)
    assert (docs.count() == 0) == empty
