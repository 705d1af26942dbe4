"""Every registered query against its SQL on whole tables."""

import pytest

import __spark_entry__ as entry_point
from checks.compare import connect, differences
from checks.oracles import ORACLES
from loanlake.plans.catalog import QUERIES, run_query

SMALLEST = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SMALLEST)


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(QUERIES) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, con, name):
    assert differences(run_query(name, spark, SMALLEST), con, ORACLES[name]) == []


def test_entry(spark):
    df = entry_point.entry(spark)
    assert len(df.columns) == 21
    assert df.count() > 0


def test_known_figures(spark):
    """Measured once on the driver's tables, in another engine as well."""
    folder = "/root/testdata/sf0.01"
    counts = {r.table_name: r.row_count for r in run_query("pipeline_row_counts", spark, folder).collect()}
    assert counts["raw_loan_applications"] == 15300
    assert counts["fact_loans"] == 14845
    assert counts["dim_applicants"] == 1500
    bad = run_query("dq_loan_amounts", spark, folder).first()
    assert (bad.invalid_rows, bad.passed) == (167, True)
    segments = run_query("loan_performance_mart", spark, folder).groupBy("loan_segment").count()
    assert {r.loan_segment: r["count"] for r in segments.collect()} == {
        "LARGE": 4337, "MEDIUM": 5704, "SMALL": 3217, "MICRO": 1587,
    }
