"""Every registered query against its oracle, on the smallest driver tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return con


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    return value


def table_of(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(entry_point.queries()))
def test_query(spark, oracle, name):
    df = entry_point.queries()[name](spark, SF)
    rows = df.collect()
    assert rows
    sql = entry_point.oracle_sql().get(name)
    if sql is None:
        return
    cursor = oracle.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert table_of(rows, df.columns) == table_of(cursor.fetchall(), names)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_oracles_belong_to_queries():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
