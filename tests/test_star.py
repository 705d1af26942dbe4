"""Dimensions, fact, marts and reports on small frames."""

import random

import pytest
from conftest import text_frame
from pyspark.sql import functions as F

from loanlake import schema
from loanlake.operators import clean
from loanlake.plans import legacy, mart, reports, star


@pytest.fixture(scope="module")
def apps(loans):
    return clean.clean_applications(loans)


def test_applicant_ids_are_stable_and_distinct(apps):
    first = {r.applicant_ssn: r.applicant_id for r in star.applicant_dim(apps).collect()}
    again = {r.applicant_ssn: r.applicant_id for r in star.applicant_dim(apps).collect()}
    assert first == again
    assert len(set(first.values())) == 3
    assert all(i.startswith("APP-") for i in first.values())


def test_applicants_without_ssn_share_an_id_and_a_row(spark):
    df = text_frame(
        spark,
        ["application_id", "applicant_ssn", "applicant_full_name"],
        [("1", None, "X"), ("2", None, "X"), ("3", None, "Y"), ("4", "s", "X")],
    )
    dim = star.applicant_dim(df)
    assert sorted((r.applicant_full_name, r.applicant_id) for r in dim.collect())[1:] == [
        ("X", "APP-UNKNOWN"), ("Y", "APP-UNKNOWN"),
    ]
    assert star.loan_fact(df, dim).count() == 4


def test_dim_grain_is_the_attribute_set(spark):
    df = text_frame(
        spark,
        ["application_id", "applicant_ssn", "applicant_full_name"],
        [("1", "s", "Old"), ("2", "s", "New")],
    )
    dim = star.applicant_dim(df)
    assert dim.count() == 2
    assert dim.select("applicant_id").distinct().count() == 1
    assert star.loan_fact(df, dim).count() == 2


def test_sequential_ids_without_ssn_column(apps):
    plain = apps.drop("applicant_ssn")
    dim = star.applicant_dim(plain)
    assert sorted(r.applicant_id for r in dim.collect()) == [
        "APP-000000", "APP-000001", "APP-000002",
    ]
    fact = star.loan_fact(plain, dim)
    assert {r.application_id: r.applicant_id for r in fact.collect()} == {
        "APP001": "APP-000000", "APP002": "APP-000002", "APP003": "APP-000001",
    }
    with pytest.raises(ValueError, match="dimension"):
        star.loan_fact(plain)


def test_without_attributes_there_is_no_dim(spark):
    df = text_frame(spark, ["application_id"], [("1",)])
    with pytest.raises(ValueError, match="attribute"):
        star.applicant_dim(df)


def test_fact_payment(apps):
    rows = {r.application_id: r for r in star.loan_fact(apps).collect()}
    assert rows["APP001"].estimated_monthly_payment_usd == 432.64
    assert rows["APP002"].estimated_monthly_payment_usd == 644.75
    assert rows["APP003"].estimated_monthly_payment_usd is None


def test_fact_without_terms_has_no_payment(apps):
    fact = star.loan_fact(apps.drop("interest_rate"))
    assert "estimated_monthly_payment_usd" not in fact.columns


def test_hashed_and_joined_fact_agree(apps):
    joined = star.loan_fact(apps, star.applicant_dim(apps))
    hashed = sorted(map(tuple, star.loan_fact(apps).collect()), key=str)
    assert sorted(map(tuple, joined.collect()), key=str) == hashed


def test_dimensions_hold_one_row_per_application(spark):
    df = text_frame(
        spark,
        ["application_id", "employment_type", "applicant_state", "next_of_kin_name"],
        [("1", "b", "S2", "k"), ("1", "a", "S1", None), ("2", None, "S1", "m")],
    )
    assert sorted(map(tuple, star.employment_dim(df).collect())) == [("1", "a"), ("2", None)]
    assert sorted(map(tuple, star.contact_dim(df).collect())) == [("1", "S1"), ("2", "S1")]
    assert sorted(map(tuple, star.kin_dim(df).collect())) == [("1", None), ("2", "m")]


def test_id_collisions(spark):
    df = text_frame(
        spark, ["applicant_ssn"], [(f"s{i}",) for i in range(300)]
    )
    dim = star.applicant_dim(df, id_length=2)
    found = star.id_collisions(dim)
    assert found.agg(F.sum("ssn_count")).first()[0] + (
        dim.groupBy("applicant_id").count().where("count = 1").count()
    ) == 300
    assert star.id_collisions(star.applicant_dim(df, id_length=32)).count() == 0


@pytest.fixture(scope="module")
def marts(spark, apps, repayments, credit):
    fact = star.loan_fact(apps)
    paid = clean.clean_repayments(repayments)
    bureau = clean.clean_credit(credit)
    return mart.loan_performance(mart.stage_loans(fact), paid, bureau)


def test_staging_columns(apps):
    staged = mart.stage_loans(star.loan_fact(apps))
    assert staged.columns == [*schema.STAGING_TYPES, "application_date", "_loaded_at"]
    assert dict(staged.dtypes)["application_date"] == "date"
    assert dict(staged.dtypes)["_loaded_at"] == "timestamp"
    assert staged.first().loan_purpose is None


def test_mart_rows(marts):
    assert len(marts.columns) == 21
    rows = {r.application_id: r for r in marts.collect()}
    one, two, three = rows["APP001"], rows["APP002"], rows["APP003"]
    assert (one.total_payments_made, one.total_amount_paid_usd) == (2, 820.0)
    assert (one.outstanding_balance_usd, one.loan_segment) == (13380.0, "MEDIUM")
    assert (one.credit_band, one.is_high_risk, one.has_defaulted) == ("Good", False, False)
    assert (two.delinquent_payment_count, two.is_high_risk) == (1, True)
    assert (two.loan_segment, two.delinquent_accounts) == ("MEDIUM", 2.0)
    assert (three.total_payments_made, three.last_payment_date) == (0, None)
    assert (three.outstanding_balance_usd, three.loan_segment) == (None, "MICRO")


def test_defaulted_and_unknown_risk(spark):
    loans = spark.createDataFrame(
        [("L1", "A", 100.0), ("L2", "A", 100.0)],
        "application_id string, applicant_id string, loan_amount_requested_usd double",
    ).withColumn("application_date", F.lit(None).cast("timestamp_ntz"))
    paid = clean.clean_repayments(
        text_frame(
            spark,
            ["application_id", "repayment_date", "amount_paid_usd", "payment_status"],
            [("L1", "2024-01-01", "150", "Defaulted"), ("L1", "2024-01-02", None, None)],
        )
    )
    bureau = clean.clean_credit(
        text_frame(spark, ["application_id", "credit_score"], [("L9", "700")])
    )
    rows = {
        r.application_id: r
        for r in mart.loan_performance(mart.stage_loans(loans), paid, bureau).collect()
    }
    assert rows["L1"].has_defaulted is True
    assert rows["L1"].outstanding_balance_usd == -50.0
    assert rows["L1"].is_high_risk is None
    assert (rows["L2"].has_defaulted, rows["L2"].is_high_risk) == (False, None)


def test_mart_refuses_unknown_keys(marts, apps, repayments, credit):
    staged = mart.stage_loans(star.loan_fact(apps))
    paid, bureau = clean.clean_repayments(repayments), clean.clean_credit(credit)
    with pytest.raises(ValueError, match="needs that column"):
        mart.loan_performance(staged, paid, bureau, credit_key="applicant_ssn")
    with pytest.raises(ValueError, match="unknown"):
        mart.loan_performance(staged, paid, bureau, credit_key="name")


def test_mart_with_many_bureau_rows_of_one_key(spark, apps, repayments):
    bureau = clean.clean_credit(
        text_frame(
            spark,
            ["application_id", "credit_score"],
            [("APP001", str(300 + i)) for i in range(60)] + [("APP002", "700"), ("LX", "600")],
        )
    )
    staged = mart.stage_loans(star.loan_fact(apps))
    assert mart.loan_performance(staged, clean.clean_repayments(repayments), bureau).count() == 62


def test_colliding_ids_keep_their_own_scores(spark):
    """Two SSNs whose eight-digit ids are the same."""
    apps = clean.clean_applications(
        text_frame(
            spark,
            ["application_id", "applicant_ssn", "application_date", "loan_amount_requested_usd"],
            [("L1", "S8597", "2024-01-05", "100"), ("L2", "S18230", "2024-01-05", "200")],
        )
    )
    fact = star.loan_fact(apps, carry=["applicant_ssn"])
    assert fact.select("applicant_id").distinct().count() == 1
    bureau = clean.clean_credit(
        text_frame(spark, ["applicant_ssn", "credit_score"], [("S8597", "500"), ("S18230", "800")])
    )
    paid = clean.clean_repayments(
        text_frame(
            spark,
            ["application_id", "repayment_date", "amount_paid_usd", "payment_status"],
            [("L1", "2024-02-01", "0.1", "Late"), ("L1", "2024-02-02", "0.2", "Paid")],
        )
    )
    staged = mart.stage_loans(fact, carry=["applicant_ssn"])
    rows = mart.loan_performance(staged, paid, bureau, credit_key="applicant_ssn").collect()
    assert {(r.application_id, r.credit_score, r.is_high_risk) for r in rows} == {
        ("L1", 500.0, True), ("L2", 800.0, False),
    }
    assert len(rows) == 2
    assert {r.application_id: r.outstanding_balance_usd for r in rows} == {"L1": 99.7, "L2": 200.0}
    dim = star.applicant_dim(apps)
    found = reports.default_by_band(bureau, dim, fact, paid).collect()
    assert [tuple(r) for r in found] == [("Poor", 1, 1)]


def random_tables(spark, seed):
    """Tables with repeated keys on every side, gaps included."""
    rng = random.Random(seed)
    ssns = [f"s{i}" for i in range(8)] + [None]
    apps = [f"L{i}" for i in range(12)]
    ids = dict(zip(ssns, ["A", "A", "B", "C", "D", "E", "F", "G", "APP-UNKNOWN"], strict=True))
    credit = [(rng.choice(ssns), rng.choice([None, 500.0, 600.0, 700.0, 750.0, 900.0])) for _ in range(20)]
    dim = [(s, f"n{rng.randint(0, 3)}", ids[s]) for s in rng.choices(ssns, k=20)]
    fact = [
        (rng.choice(apps), rng.choice(ssns), rng.choice([None, 10.0, 20.0])) for _ in range(25)
    ]
    paid = [
        (rng.choice([*apps, "LX"]), rng.choice(["Paid", "Late", None]), rng.choice([None, 1.0, 2.0]))
        for _ in range(60)
    ]
    jobs = [(a, rng.choice([None, 100.0, 200.0])) for a in apps[:10]]
    tables = {
        "credit": spark.createDataFrame(credit, "applicant_ssn string, credit_score double"),
        "dim": spark.createDataFrame(
            dim, "applicant_ssn string, applicant_full_name string, applicant_id string"
        ),
        "fact": spark.createDataFrame(
            fact, "application_id string, applicant_ssn string, loan_amount_requested_usd double"
        ),
        "paid": spark.createDataFrame(
            paid, "application_id string, payment_status string, amount_paid_usd double"
        ),
        "jobs": spark.createDataFrame(jobs, "application_id string, monthly_income_usd double"),
    }
    for name, df in tables.items():
        df.createOrReplaceTempView(f"t_{name}")
    return tables


@pytest.mark.parametrize("seed", range(3))
def test_default_report_equals_the_raw_join(spark, seed):
    t = random_tables(spark, seed)
    expected = spark.sql(
        """
        select case when c.credit_score < 580 then 'Poor'
                    when c.credit_score between 580 and 669 then 'Fair'
                    when c.credit_score between 670 and 739 then 'Good'
                    when c.credit_score between 740 and 799 then 'Very Good'
                    else 'Excellent' end as credit_band,
               count(distinct l.application_id) as total_loans,
               sum(case when r.payment_status != 'Paid' then 1 else 0 end) as defaults
        from t_credit c join t_dim a on c.applicant_ssn = a.applicant_ssn
        join t_fact l on a.applicant_ssn = l.applicant_ssn
        join t_paid r on l.application_id = r.application_id
        group by 1
        """
    )
    expected = sorted(map(tuple, expected.collect()))
    sides = (t["credit"], t["dim"], t["fact"], t["paid"])
    assert sorted(map(tuple, reports.default_by_band(*sides).collect())) == expected


@pytest.mark.parametrize("seed", range(3))
def test_income_report_equals_the_raw_join(spark, seed):
    t = random_tables(spark, seed)
    expected = spark.sql(
        """
        select e.monthly_income_usd, sum(r.amount_paid_usd) as total_repaid
        from t_jobs e join t_fact l on e.application_id = l.application_id
        join t_paid r on l.application_id = r.application_id
        group by 1
        """
    )
    got = reports.repaid_by_income(t["jobs"], t["fact"], t["paid"])
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        map(tuple, expected.collect()), key=str
    )


def test_simple_reports(spark):
    fact = spark.createDataFrame(
        [(f"L{i:02}", float(i % 11), f"2024-{1 + i % 3:02}-05") for i in range(22)],
        "application_id string, loan_amount_requested_usd double, d string",
    ).withColumn("application_date", F.col("d").cast("date"))
    top = reports.total_by_application(fact).collect()
    assert [r.application_id for r in top][:4] == ["L10", "L21", "L09", "L20"]
    assert len(top) == 10
    months = reports.applications_per_month(fact).collect()
    assert [tuple(r) for r in months] == [(2024, 1, 8), (2024, 2, 7), (2024, 3, 7)]
    people = spark.createDataFrame(
        [("PhD", "S1", "x", "Full-time", 10.0), ("PhD", "S2", "x", "Full-time", None),
         (None, "S1", "y", None, 30.0)],
        "applicant_level_of_education string, applicant_state string,"
        " next_of_kin_relationship string, employment_type string, monthly_income_usd double",
    )
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(reports.applicants_by_education(people)) == [("PhD", 2), (None, 1)]
    assert rows(reports.income_by_employment(people)) == [("Full-time", 10.0), (None, 30.0)]
    assert [tuple(r) for r in reports.applicants_by_state(people).collect()] == [("S1", 2), ("S2", 1)]
    assert [tuple(r) for r in reports.kin_relationships(people).collect()] == [("x", 2), ("y", 1)]


def test_legacy_star(loans):
    apps = clean.legacy_clean_applications(loans)
    people = legacy.legacy_applicants(apps)
    keyed = legacy.with_applicant(apps)
    looked_up = legacy.with_applicant(apps, people)
    ids = {r.application_id: r.applicant_id for r in keyed.collect()}
    assert ids == {r.application_id: r.applicant_id for r in looked_up.collect()}
    assert len(set(ids.values())) == 2
    jobs = legacy.legacy_employment(keyed)
    assert jobs.columns[:2] == ["applicant_id", "employment_id"]
    contacts = legacy.legacy_contact_info(keyed)
    assert contacts.columns == ["contact_info_id", "applicant_id", "applicant_phone_number"]
    assert legacy.legacy_loan_fact(keyed).columns == [
        "application_id", "applicant_id", "application_date", "loan_type",
        "loan_amount_requested_usd",
    ]
