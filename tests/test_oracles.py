"""Every query with SQL gives the SQL's rows, in Spark and in DuckDB."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    return str(v) if hasattr(v, "isoformat") else int(v) if isinstance(v, bool) else v


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(columns[i] for i in order)), sorted((tuple(plain(r[i]) for i in order) for r in values), key=repr)


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) & set(entry.queries())))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for p in glob.glob(f"{DATA}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(p).removesuffix('.parquet')} AS SELECT * FROM '{p}'")
    told = db.execute(entry.oracle_sql()[name])
    expected = rows([d[0] for d in told.description], told.fetchall())
    df = entry.queries()[name](spark, DATA)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == expected


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["z", "x", "y", "row", "col", "elev", "prov", "r", "g", "b"]
    assert df.count() > 0
