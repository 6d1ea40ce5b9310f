"""All registered queries with SQL against DuckDB on the smallest testdata."""

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as spark_entry  # noqa: E402
from lossledger.plans.catalog import QUERIES  # noqa: E402
from tools.check_oracles import TABLES, table_rows, type_differences  # noqa: E402

SMALL = "/root/testdata/sf0.001"
# Training takes minutes: the model checks run with tools/check_oracles.py.
CHECKED = sorted(n for n, query in QUERIES.items() if query.oracle and not n.endswith("_model_checks"))


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_oracle(spark, db, name):
    df = spark_entry.queries()[name](spark, SMALL)
    result = db.execute(spark_entry.oracle_sql()[name])
    description = result.description
    assert not type_differences(df, description)
    got = table_rows(df.columns, [tuple(r) for r in df.collect()])
    assert got == table_rows([d[0] for d in description], result.fetchall())
    assert got[1], "no rows"
