"""Every query of the engine runs; those with a DuckDB counterpart give its rows."""

import pytest

from lontar import queries as core
from tests.oracle import connect, rows

QUERIES, SQL = core.queries(), core.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    found = QUERIES[name](spark, sf_dir).toPandas()
    if name in SQL:
        expected = con.execute(SQL[name]).fetchdf()
        assert sorted(found.columns) == sorted(expected.columns)
        assert rows(found) == rows(expected)


def test_scores_are_of_all_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id")
    assert docs.exceptAll(QUERIES["class_scores"](spark, sf_dir).select("doc_id")).isEmpty()


def test_entry(spark, sf_dir):
    import __spark_entry__ as entry

    assert set(core.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
