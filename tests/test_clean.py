"""Cleaners, current and older rules."""

import datetime as dt

import pytest
from conftest import INES, LOAN_COLUMNS, text_frame
from pyspark.sql import Observation
from pyspark.sql import functions as F

from loanlake.operators import clean
from loanlake.operators.rows import distinct_rows, keep_one


def by_id(df, key="application_id"):
    return {r[key]: r for r in df.collect()}


def test_copies_collapse_and_names_are_normalised(loans):
    df = clean.clean_applications(loans)
    assert df.count() == 3
    assert "applicant_full_name" in df.columns


def test_values_are_parsed_and_bad_ones_become_null(loans):
    rows = by_id(clean.clean_applications(loans))
    assert rows["APP001"].loan_amount_requested_usd == 14200.0
    assert rows["APP001"].applicant_date_of_birth == dt.datetime(1979, 11, 2)
    assert rows["APP001"].applicant_phone_number == "+31205550188"
    assert rows["APP002"].applicant_phone_number == "0205550142"
    assert rows["APP003"].loan_amount_requested_usd is None
    assert rows["APP003"].applicant_date_of_birth is None
    assert rows["APP003"].applicant_phone_number is None


def test_missing_key_is_dropped_and_counted(spark):
    df = text_frame(
        spark,
        ["application_id", "loan_amount_requested_usd"],
        [("APP001", "10000"), (None, "5000"), (None, "6000")],
    )
    seen = Observation("applications")
    assert clean.clean_applications(df, dropped=seen).count() == 1
    assert seen.get == {"dropped": 2}


def test_a_missing_optional_value_keeps_the_row(spark):
    df = text_frame(
        spark,
        ["application_id", "repayment_date", "amount_paid_usd", "notes"],
        [("APP001", "2024-02-15", "500.0", None)],
    )
    row = clean.clean_repayments(df).first()
    assert row.amount_paid_usd == 500.0
    assert row.is_delinquent is False


def test_copies_are_compared_before_parsing(spark):
    rows = [("A", "10000"), ("A", "10000.0"), ("A", "10000")]
    df = text_frame(spark, ["application_id", "loan_amount_requested_usd"], rows)
    assert clean.clean_applications(df).count() == 2


def test_null_equals_null_in_copies(spark):
    df = text_frame(spark, ["a", "b"], [("x", None), ("x", None), (None, None), (None, None)])
    assert distinct_rows(df).count() == 2


def test_repayments(repayments):
    df = clean.clean_repayments(repayments.unionByName(repayments))
    assert df.count() == 3
    flags = sorted((r.application_id, r.is_delinquent) for r in df.collect())
    assert flags == [("APP001", False), ("APP001", False), ("APP002", True)]


def test_repayment_key_prefers_the_loan_column(spark):
    df = text_frame(
        spark,
        ["loan_application_id", "application_id", "repayment_date"],
        [("L1", "A1", "2024-01-01"), (None, "A2", "2024-01-01")],
    )
    rows = clean.clean_repayments(df).collect()
    assert [(r.application_id, r.loan_application_id) for r in rows] == [("L1", "L1")]


def test_repayments_without_key_column(spark):
    with pytest.raises(KeyError):
        clean.clean_repayments(text_frame(spark, ["repayment_date"], [("2024-01-01",)]))


def test_unreadable_date_stays_and_is_not_in_the_future(spark):
    df = text_frame(
        spark,
        ["application_id", "repayment_date", "days_overdue"],
        [("A", "soon", None), ("B", None, "1"), ("C", "2999-01-01", "31")],
    )
    rows = by_id(clean.clean_repayments(df))
    assert set(rows) == {"A", "C"}
    assert (rows["A"].repayment_date, rows["A"].is_future_dated) == (None, False)
    assert (rows["A"].days_overdue, rows["A"].is_delinquent) == (0.0, False)
    assert (rows["C"].is_future_dated, rows["C"].is_delinquent) == (True, True)


def test_as_of_is_a_parameter(spark):
    df = text_frame(spark, ["application_id", "repayment_date"], [("A", "2024-01-02")])
    for day, expected in (("2024-01-01", True), ("2024-01-02", False)):
        as_of = F.lit(day).cast("timestamp_ntz")
        assert clean.clean_repayments(df, as_of=as_of).first().is_future_dated is expected


def test_credit(credit):
    rows = by_id(clean.clean_credit(credit))
    assert rows["APP001"].credit_band == "Good"
    assert rows["APP002"].credit_band == "Fair"
    assert rows["APP003"].bureau_pull_date is None
    assert rows["APP001"].applicant_ssn == "APP001"


def test_credit_keys_fill_each_other(spark):
    rows = [("1", "700"), (None, "600"), ("1", "700")]
    by_ssn = clean.clean_credit(text_frame(spark, ["applicant_ssn", "credit_score"], rows))
    assert [(r.application_id, r.applicant_ssn) for r in by_ssn.collect()] == [("1", "1")]
    with pytest.raises(ValueError, match="credit_score"):
        clean.clean_credit(text_frame(spark, ["credit_score"], [("1",)]))


def test_optional_bureau_value_keeps_the_row(spark):
    df = text_frame(
        spark, ["application_id", "credit_score", "bankruptcy_flag"], [("A", "700", None)]
    )
    assert clean.clean_credit(df).count() == 1


def test_band_distribution_leaves_unknown_out(spark):
    rows = [("1", "720"), ("2", "721"), ("3", "100"), ("4", None)]
    df = clean.clean_credit(text_frame(spark, ["applicant_ssn", "credit_score"], rows))
    found = clean.credit_band_distribution(df).collect()
    assert [tuple(r) for r in found] == [("Good", 2)]


def test_keep_one_takes_the_smallest_row_nulls_first(spark):
    df = spark.createDataFrame(
        [("a", 2, "x"), ("a", None, "z"), ("a", 1, "y"), ("b", 5, "q"), ("b", 5, None)],
        "k string, n int, t string",
    )
    assert sorted(tuple(r) for r in keep_one(df, "k").collect()) == [
        ("a", None, "z"), ("b", 5, None),
    ]


def test_legacy_drops_rows_with_any_gap(loans):
    df = clean.legacy_clean_applications(loans)
    assert sorted(r.application_id for r in df.collect()) == ["APP001", "APP002"]
    assert df.where("application_id = 'APP001'").first().applicant_phone_number == "31205550188"


def test_legacy_sources_keep_text_amounts(spark, repayments, credit):
    paid = clean.legacy_clean_repayments(repayments).where("application_id = 'APP002'").first()
    assert (paid.amount_paid_usd, paid.repayment_date) == ("615", dt.datetime(2024, 3, 28))
    assert clean.legacy_clean_credit(credit).count() == 3


def test_legacy_dates_are_strict(spark):
    row = list(INES)
    row[4] = "15/01/2024"
    df = text_frame(spark, LOAN_COLUMNS, [tuple(row)])
    assert clean.legacy_clean_applications(df).first().application_date is None


def test_distinct_applications_with_the_wanted_columns_only(spark):
    columns = ["application_id", "applicant_ssn", "Loan Type", "employer_name", "City"]
    rows = [
        ("A1", "S1", "Auto", "Mill", "Oslo"),
        ("A1", "S1", "Auto", "Mill", "Oslo"),
        ("A1", "S1", "Auto", "Mill", None),
        ("A1", "S1", "Auto", None, "Mill"),
        ("A1", "S1", "Auto", "", "Oslo"),
        (None, "S2", "Auto", "Mill", "Oslo"),
        ("A2", None, None, None, None),
        ("A2", None, None, None, None),
    ]
    raw = text_frame(spark, columns, rows)
    wanted = ["application_id", "applicant_ssn", "loan_type", "interest_rate"]
    some = clean.clean_applications(raw, columns=wanted)
    whole = clean.clean_applications(raw).select(*wanted[:3])
    assert some.columns == wanted[:3]
    assert sorted(map(repr, some.collect())) == sorted(map(repr, whole.collect()))
    assert some.count() == 5
    bare = clean.clean_applications(raw, columns=wanted, distinct=False)
    assert bare.columns == wanted[:3] and bare.count() == 7
