"""Queries on tables where one key, and one group of copies, holds a third of the rows."""

import duckdb
import pytest

from checks.compare import connect, differences
from checks.oracles import ORACLES
from loanlake.plans.catalog import QUERIES, run_query

SOURCE = "/root/testdata/sf0.01"

# Every third order belongs to one customer. A sixth of the line items belong to
# one order as they are, another sixth are exact copies of each other.
SKEW = {
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey)",
    "lineitem": """
        SELECT * REPLACE (
          CASE WHEN rowid % 3 = 0 THEN 11 ELSE l_orderkey END AS l_orderkey,
          CASE WHEN rowid % 6 = 0 THEN 1 ELSE l_linenumber END AS l_linenumber,
          CASE WHEN rowid % 6 = 0 THEN 40 ELSE l_quantity END AS l_quantity,
          CASE WHEN rowid % 6 = 0 THEN 900 ELSE l_extendedprice END AS l_extendedprice,
          CASE WHEN rowid % 6 = 0 THEN 'N' ELSE l_returnflag END AS l_returnflag,
          CASE WHEN rowid % 6 = 0 THEN TIMESTAMP '1999-01-01' ELSE l_shipdate END AS l_shipdate)""",
    "customer": "SELECT *",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for table, select in SKEW.items():
        source = f"(SELECT *, file_row_number AS rowid FROM read_parquet('{SOURCE}/{table}.parquet', file_row_number = true))"
        drop = "SELECT * EXCLUDE (rowid, file_row_number)"
        con.execute(
            f"COPY ({drop} FROM ({select} FROM {source})) TO '{path}/{table}.parquet' (FORMAT parquet)"
        )
    return str(path)


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


def test_the_tables_are_skewed(con):
    for table, key in (("orders", "o_custkey"), ("lineitem", "l_orderkey")):
        top, rows = con.execute(
            f"SELECT max(n), sum(n) FROM (SELECT count(*) AS n FROM {table} GROUP BY {key})"
        ).fetchone()
        assert top / rows > 0.32


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql_on_skewed_tables(spark, con, folder, name):
    assert differences(run_query(name, spark, folder), con, ORACLES[name]) == []
