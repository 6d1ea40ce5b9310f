"""Registered queries against DuckDB, and the pipeline step by step."""

import hashlib

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as spark_entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from lossledger.llm import queries  # noqa: E402
from lossledger.llm.common import stored  # noqa: E402
from lossledger.llm.oracle import ORACLES  # noqa: E402
from tests.llm.test_stage_near_copies import kept_expected  # noqa: E402
from tools.check_oracles import TABLES, table_rows, type_differences  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return connection


def test_all_are_registered():
    names = {f"op{n}" for n in range(1, 14)}
    assert names == {q.split("_")[0] for q in queries.QUERIES}
    assert set(queries.QUERIES) | {"pipeline"} <= set(spark_entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, db, name):
    df = queries.QUERIES[name](spark, SMALL)
    result = db.execute(ORACLES[name])
    description = result.description
    assert not type_differences(df, description)
    got = table_rows(df.columns, [tuple(r) for r in df.collect()])
    assert got == table_rows([d[0] for d in description], result.fetchall()) and got[1]


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, expected = docs.columns, None
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
        docs = stored(stage(spark, docs, SMALL))
        if name == "sentencepiece":
            rows = docs.collect()
            assert all(r["round_trip"] for r in rows)
            assert {r["doc_id"]: r["decoded_sha256"] for r in rows} == {
                i: hashlib.sha256(t.encode()).hexdigest() for i, t in before.items()
            }
            break
        assert docs.columns == columns
        after = {r["doc_id"] for r in docs.collect()}
        if name == "quality classifier":
            good = {r["doc_id"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").filter("quality = 1").collect()}
            assert after <= set(before) and len(good - after) <= 0.02 * len(good) and len(after) < len(before)
        elif name == "exact dedup":
            expected = {}
            for i, t in before.items():
                expected[t] = max(i, expected.get(t, i))
            assert after == set(expected.values())
        elif name == "near dedup":
            assert after == kept_expected(list(before.items()), corpus_pipeline.NEAR_WORDS, corpus_pipeline.NEAR_PERCENT)
        else:
            assert after == set(before)
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(spark, SMALL).select("doc_id").collect()) == sorted(before)
