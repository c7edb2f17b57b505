from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from tidemark.plans import catalogue


@pytest.fixture(scope="module")
def duck(folder):
    con = duckdb.connect()
    for p in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p / '*.parquet' if p.is_dir() else p}')")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: None if v is None else f"{v:.6f}" if isinstance(v, float) else str(v)
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((x is None, x or "") for x in r))


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, folder, duck, name):
    df = catalogue.QUERIES[name](spark, folder)
    rows = [tuple(r) for r in df.collect()]
    if name in catalogue.ORACLE:
        found = duck.execute(catalogue.ORACLE[name])
        columns = [c[0] for c in found.description]
        assert sorted(columns) == sorted(df.columns)
        assert canonical(rows, df.columns) == canonical(found.fetchall(), columns)


def test_entry(spark, folder):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
