import os

import pytest

pytest.importorskip("fieldmosaic.llm.queries")
from fieldmosaic.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    """The registered queries that SQL can express, against it, on the smallest tables."""
    duckdb = pytest.importorskip("duckdb")
    sf, con = "/root/testdata/sf0.001", duckdb.connect()
    for f in os.listdir(sf):
        con.execute(f"create view {f.split('.')[0]} as select * from '{sf}/{f}'")
    df = queries.QUERIES[name](spark, sf)
    cursor = con.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    key = lambda r: tuple((x is None, x if x is not None else 0) for x in r)
    assert sorted((tuple(r) for r in df.select(*columns).collect()), key=key) == sorted(cursor.fetchall(), key=key)
