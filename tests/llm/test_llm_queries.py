from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from tests.test_queries import canonical
from tidemark.llm import queries

COLUMNS = {
    "p1_found": {"notice_id", "agency_canonical"}, "p4_found": {"notice_id", "field_name", "pii_type", "pii_text"}, "p5_found": {"notice_id", "job_family"},
    "p6_found": {"notice_id", "line_key"}, "p10_found": {"doc_id", "reading_level"},
}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, folder, name):
    df = queries.QUERIES[name](spark, folder)
    rows = [tuple(r) for r in df.collect()]
    assert name in __spark_entry__.queries()
    if name in COLUMNS:
        assert set(df.columns) == COLUMNS[name] and len(rows) == len(set(rows))
    if name in queries.ORACLE:
        con = duckdb.connect()
        for p in Path(folder).glob("*.parquet"):
            con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
        found = con.execute(queries.ORACLE[name])
        columns = [c[0] for c in found.description]
        assert canonical(rows, df.columns) == canonical(found.fetchall(), columns)
