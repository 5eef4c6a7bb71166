"""Queries of the training-data operators run over whole small tables; those that SQL can say give its rows."""

import pytest

from lontar.llm import queries as llm
from tests.oracle import connect, rows

QUERIES, SQL = llm.queries(), llm.oracle_sql()
COLUMNS = {
    "p1_found": ["id", "subject"], "p2_found": ["table_name", "record_id"], "p3_found": ["site", "line"], "p4_found": ["page_id", "line_no"], "p5_found": ["table_name", "record_id"],
    "p6_found": ["table_name", "record_id", "pii_type", "start_pos"], "p7_found": ["id"], "p8_found": ["doc_id", "item_id"], "p10_found": ["doc_id_a", "doc_id_b"],
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    found = df.toPandas()
    assert len(found)
    if name in COLUMNS:
        assert df.columns == COLUMNS[name] and not found.duplicated().any() and not found.isna().any().any()
    if name in SQL:
        assert rows(found) == rows(connect(sf_dir).execute(SQL[name]).fetchdf())
