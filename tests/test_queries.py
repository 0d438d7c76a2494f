"""Every registered query that has SQL must agree with it."""

import duckdb
import pytest

from checks.registry import ORACLE, QUERIES
from checks.run import TABLES, compare


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    described = {row[0]: row[1] for row in con.execute("DESCRIBE " + ORACLE[name]).fetchall()}
    assert {column: TYPES[kind] for column, kind in df.dtypes} == described
    result = con.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert compare(df.columns, rows, columns, result.fetchall()) == ""


def test_every_inventory_id_is_registered():
    sizes = {"src": 17, "snk": 5, "prj": 25, "flt": 11, "set": 6, "jn": 6, "fea": 16, "txt": 10, "rul": 14, "agg": 11, "spl": 8,
             "wgt": 4, "mod": 10, "evl": 14, "win": 3, "srt": 2, "str": 3}
    have = {"_".join(name.split("_")[:2]) for name in QUERIES}
    missing = [f"{k}_{i:02d}" for k, n in sizes.items() for i in range(1, n + 1) if f"{k}_{i:02d}" not in have]
    assert missing == []
