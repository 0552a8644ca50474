"""Every query against its SQL twin on the smallest tables."""

import decimal

import duckdb
import pytest

import __spark_entry__ as driver
from tests.conftest import SF

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(value):
    return int(value) if isinstance(value, decimal.Decimal) else value


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = driver.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(v) for v in r) for r in df.select(*cols).collect()), key=repr)
    cur = duck.execute(driver.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    want = sorted((tuple(plain(r[i]) for i in at) for r in cur.fetchall()), key=repr)
    assert got == want and got


def test_all_queries_of_the_packet_jobs_have_sql():
    assert all(n in driver.oracle_sql() for n in driver.queries() if n.startswith("q_"))
