"""Sources, sinks and whole runs."""

import re
import uuid

import pytest
from conftest import text_frame
from pyspark.errors import AnalysisException

from loanlake.plans import pipeline
from loanlake.plans.gate import ValidationError
from loanlake.sources.files import read_csv, read_parquet, read_sources
from loanlake.sources.tables import (
    LoadError,
    land_csv,
    load_all,
    read_table,
    register_views,
    row_counts,
    write_csv,
    write_table,
)


def fresh(prefix="t"):
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def test_csv_is_text_with_tokens_as_nulls(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('Id,Full Name,Amount\n007,"Smith, ""Al""",1.50\n008,NA,\n009,null,nan\n010,n/a ,-\n')
    rows = [tuple(r) for r in read_csv(spark, str(path)).collect()]
    assert rows == [
        ("007", 'Smith, "Al"', "1.50"), ("008", None, None), ("009", None, None), ("010", "n/a ", "-"),
    ]


def test_quoted_line_breaks_need_multi_line(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('a,b\n1,"x\ny"\n')
    assert [tuple(r) for r in read_csv(spark, str(path), multi_line=True).collect()] == [("1", "x\ny")]


def test_missing_path_fails_at_once(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_csv(spark, str(tmp_path / "absent.csv"))


def test_csv_round_trip(spark, tmp_path):
    df = spark.sql(
        """select * from values
           ('a "q", b', true, 1.5D, timestamp_ntz'2024-01-05 00:00:00'),
           ('line\nbreak', false, null, timestamp_ntz'2024-01-05 10:30:00'),
           ('  outer \t', true, 12345678.0D, null), ('cr\rlf\r\nend', false, 0.00001D, null),
           ('large', null, 12345678901.25D, null), ('huge', null, 1.5E300D, null),
           (null, null, 2.0D, null) as t(s, f, x, ts)"""
    )
    out = write_csv(df, str(tmp_path / "out.csv"))
    got = read_csv(spark, out, multi_line=True).collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [
            ('a "q", b', "True", "1.5", "2024-01-05"),
            ("line\nbreak", "False", None, "2024-01-05 10:30:00"),
            ("  outer \t", "True", "12345678.0", None), ("cr\rlf\r\nend", "False", "0.00001", None),
            ("large", None, "12345678901.25", None), ("huge", None, "1.5E300", None),
            (None, None, "2.0", None),
        ],
        key=str,
    )


def test_csv_sink_takes_any_column_name(spark, tmp_path):
    df = spark.createDataFrame([(1, True)], "`a.b (c)` int, f boolean")
    got = read_csv(spark, write_csv(df, str(tmp_path / "out.csv")))
    assert got.columns == ["a.b (c)", "f"]
    assert [tuple(r) for r in got.collect()] == [("1", "True")]


def test_table_overwrite_append_and_switch(spark, tmp_path):
    df = spark.range(5).toDF("n")
    name = fresh()
    options = {"location": str(tmp_path)}
    assert write_table(df, name, **options) == 5
    assert write_table(df, name, mode="WRITE_APPEND", **options) == 10
    assert write_table(df, name, mode="WRITE_TRUNCATE", **options) == 5
    assert write_table(df, name, enabled=False) == 0
    assert read_table(spark, name).count() == 5
    assert read_parquet(spark, f"{tmp_path}/{name}").count() == 5


def test_load_all_goes_on_and_lists_every_error(spark, tmp_path):
    good, bad = spark.range(3).toDF("n"), spark.range(3).selectExpr("raise_error('no') as n")
    first, second, third = fresh("a"), fresh("b"), fresh("c")
    tables = {first: bad, second: good, third: bad}
    with pytest.raises(LoadError, match="2 table") as found:
        load_all(tables, location=str(tmp_path))
    assert first in str(found.value) and third in str(found.value)
    assert read_table(spark, second).count() == 3
    again = {first: bad, fresh("d"): good}
    assert list(load_all(again, on_error="continue", location=str(tmp_path)).values()) == [3]


def test_views_and_counts(spark):
    name = fresh()
    tables = {name: spark.range(4).toDF("n")}
    register_views(tables)
    assert spark.sql(f"select count(*) from {name}").first()[0] == 4
    assert row_counts(tables) == {name: 4}


OUTPUTS = {
    "fact_loans": 3, "dim_applicants": 3, "dim_employment": 3, "dim_contact_info": 3,
    "dim_next_of_kin": 3, "fact_repayments": 3, "dim_credit_bureau": 3,
}


@pytest.fixture
def raw(loans, repayments, credit):
    return {
        "loan_applications": loans.replace("not_a_number", "7000"),
        "loan_repayments": repayments.withColumnRenamed("application_id", "loan_application_id"),
        "credit_bureau": credit,
    }


def stored(spark, database):
    return [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]


@pytest.fixture
def database(spark, tmp_path):
    name = fresh("db")
    spark.sql(f"create database {name} location '{tmp_path}/{name}'")
    return name


def test_run_writes_tables_and_csv(spark, raw, database, tmp_path):
    landing = str(tmp_path / "cleaned")
    result = pipeline.run(raw, landing=landing, database=database)
    assert {k: type(v) for k, v in result.items()} == {
        "status": str, "run_id": str, "mode": str, "dry_run": bool, "elapsed_seconds": float,
        "tables_loaded": dict,
    }
    assert re.fullmatch(r"run-\d{8}-\d{6}", result["run_id"])
    assert result["tables_loaded"] == OUTPUTS
    for name, rows in OUTPUTS.items():
        assert spark.table(f"{database}.{name}").count() == rows
        assert read_csv(spark, f"{landing}/{name}.csv").count() == rows
    second = pipeline.run(raw, database=database, write_mode="WRITE_APPEND")
    assert second["tables_loaded"] == {k: 2 * v for k, v in OUTPUTS.items()}


def test_landed_sources_can_be_read_back(spark, raw, tmp_path):
    land_csv(raw, str(tmp_path))
    files = {name: f"{name}.csv" for name in raw}
    again = read_sources(spark, str(tmp_path), files)
    assert pipeline.run(again, dry_run=True)["tables_loaded"] == OUTPUTS


def test_dry_run_counts_and_writes_nothing(spark, raw, database, tmp_path):
    landing = tmp_path / "cleaned"
    result = pipeline.run(raw, landing=str(landing), database=database, dry_run=True)
    assert (result["dry_run"], result["tables_loaded"]) == (True, OUTPUTS)
    assert stored(spark, database) == []
    assert not landing.exists()


def test_local_mode_lands_but_loads_nothing(spark, raw, database, tmp_path):
    landing = tmp_path / "cleaned"
    result = pipeline.run(raw, landing=str(landing), database=database, mode="local")
    assert set(result["tables_loaded"].values()) == {0}
    assert (landing / "fact_loans.csv").exists()
    assert stored(spark, database) == []


MARTS = {"stg_loans": 3, "fact_loan_performance": 3, "fact_loan_segments": 3}


def test_run_loads_the_marts_and_reports(spark, raw, database):
    result = pipeline.run(raw, database=database, marts=True, report=True, id_length=64)
    assert result["tables_loaded"] == OUTPUTS | MARTS
    assert result["report"] == {
        "raw_rows": {"loan_applications": 4, "loan_repayments": 4, "credit_bureau": 3},
        "dropped_applications": 0,
        "future_dated_repayments": 0,
        "credit_bands": {"Good": 2, "Fair": 1},
    }
    loaded = spark.table(f"{database}.fact_loan_performance")
    scores = {r.application_id: r.credit_score for r in loaded.collect()}
    assert scores == {"APP001": 731.0, "APP002": 604.0, "APP003": 688.0}
    assert {len(r.applicant_id) for r in loaded.collect()} == {len("APP-") + 64}


def test_a_failed_critical_check_stops_the_marts(spark, raw, database):
    apps = raw["loan_applications"].replace("Auto", "Boat")
    with pytest.raises(ValidationError, match="accepted_values"):
        pipeline.run({**raw, "loan_applications": apps}, database=database, marts=True)
    assert stored(spark, database) == []
    result = pipeline.run(
        {**raw, "loan_applications": apps}, database=database, marts=True, on_failed_checks="report"
    )
    assert result["tables_loaded"] == OUTPUTS | MARTS


def test_run_takes_date_formats(spark, raw, database):
    apps = raw["loan_applications"].replace("2024-01-09", "09/01/2024 10:30")
    formats = ("iso", "dd/MM/yyyy HH:mm")
    pipeline.run({**raw, "loan_applications": apps}, database=database, date_formats=formats)
    dates = {r.application_id: str(r.application_date) for r in spark.table(f"{database}.fact_loans").collect()}
    assert dates == {
        "APP001": "2024-01-09 10:30:00", "APP002": "2024-02-12 00:00:00", "APP003": "2024-03-21 00:00:00",
    }


def test_gate_stops_before_any_write(spark, raw, database, tmp_path):
    landing = tmp_path / "cleaned"
    bad = text_frame(spark, ["application_id", "credit_score"], [("APP001", "299")])
    with pytest.raises(ValidationError):
        pipeline.run({**raw, "credit_bureau": bad}, landing=str(landing), database=database)
    assert stored(spark, database) == []
    assert not landing.exists()


def test_run_without_ssn_column(raw, database):
    plain = {**raw, "loan_applications": raw["loan_applications"].drop("applicant_ssn")}
    assert pipeline.run(plain, dry_run=True)["tables_loaded"] == OUTPUTS


def test_legacy_run(spark, raw, database, tmp_path):
    result = pipeline.run_legacy(raw, landing=str(tmp_path / "cleaned"), database=database)
    assert result["tables_processed"] == {
        "loan_repayments": 3, "loan_applications": 2, "applicant": 2, "employment": 2,
        "contact_info": 2, "next_of_kin": 2, "loan_application_fact": 2, "credit_bureau": 3,
    }
    assert spark.table(f"{database}.loan_application_fact").count() == 2
