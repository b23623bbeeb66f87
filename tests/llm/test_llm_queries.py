"""Registered queries of the training-data operators against their SQL, and the pipeline's stages on the small tables."""

import pytest

import corpus_pipeline
from palimpsest.llm import queries
from tests.oracle_compare import duck_connect

SMALL = "/root/testdata/sf0.001"


def test_thirteen_queries():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    got = queries.QUERIES[name](spark, SMALL)
    con = duck_connect(SMALL)
    cur = con.execute(queries.ORACLE_SQL[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(got.columns)
    assert sorted(map(repr, cur.fetchall())) == sorted(repr(tuple(r[c] for c in cols)) for r in got.collect())


def test_pipeline(spark):
    out = corpus_pipeline.run(spark, SMALL).collect()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    ids = [r.doc_id for r in out]
    assert len(ids) == len(set(ids)) and set(ids) <= {r.doc_id for r in docs.select("doc_id").collect()}
    bench = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    assert not any(b in r.text for b in bench for r in out)
    toxic = {r.doc_id for r in queries.QUERIES["op10_toxicity"](spark, SMALL).where("predicted = 1").collect()}
    assert not toxic & set(ids)
    total = sum(len(r.text.split()) for r in out)
    assert 0.5 * total < sum(r.taken for r in out) <= 2 * total
