"""Every query of the text operators on the smallest tables: columns, distinct rows."""

import pytest

from folioloom.llm import queries

COLUMNS = {
    "p1_found": [("form_a", "bigint"), ("form_b", "bigint")], "p5_found": [("ingest_pos", "bigint")], "p6_found": [("ingest_pos", "bigint"), ("field_name", "string")], "p7_found": [("ingest_pos", "bigint"), ("field_name", "string")], "p10_found": [("doc_id", "bigint")],
}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, sf, name):
    df = queries.QUERIES[name](spark, sf).cache()
    assert df.count() > 0
    if name in COLUMNS:
        assert df.dtypes == COLUMNS[name] and df.distinct().count() == df.count()
