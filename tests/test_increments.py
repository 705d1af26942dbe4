"""Tables that are kept up load by load: the applicant registry, loan states, the mart."""

import random
import uuid
from datetime import date, datetime
from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from loanlake.plans import deltas, mart, registry, star
from loanlake.session import shared_dir

DAYS = [date(2024, 5, d) for d in (1, 2, 3)]
REPAYMENTS = (
    "application_id string, amount_paid_usd double, repayment_date timestamp_ntz,"
    " is_delinquent boolean, payment_status string"
)


def fresh(prefix="t"):
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def people(spark, *rows):
    return spark.createDataFrame(
        rows, "applicant_full_name string, applicant_gender string, application_id string"
    )


def ids(spark, table):
    rows = spark.table(table).collect()
    return {(r.applicant_full_name, r.applicant_gender): r.applicant_id for r in rows}


def repaid(spark, rows):
    return spark.createDataFrame(rows, REPAYMENTS)


def some_rows(seed, loans=30, rows=200):
    dice = random.Random(seed)
    return [
        (
            f"L{dice.randrange(loans)}",
            dice.choice([None, dice.randrange(100000) / 100, 1e30]) if dice.random() < 0.2
            else dice.randrange(100000) / 100,
            dice.choice([None, datetime(2024, 5, dice.randrange(1, 28))]),
            dice.random() < 0.2,
            dice.choice(["Paid", "Late", "Defaulted", None]),
        )
        for _ in range(rows)
    ]


def summary(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[0])


@pytest.fixture
def state_table(spark, tmp_path):
    name = fresh("states")
    yield name, {"location": str(tmp_path), "buckets": 8}
    for table in (name, f"{name}_mart"):
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_registered_ids_stay(spark, tmp_path):
    name = fresh("registry")
    first = people(spark, ("Ana", "F", "1"), ("Bo", None, "2"), ("Ana", "F", "3"))
    more = people(spark, ("Aaron", "M", "4"), ("Bo", None, "5"), ("Bo", "M", "6"), (None, None, "7"))
    one = registry.register_applicants(first, name, location=str(tmp_path))
    assert (one.rows, one.total) == (2, 2)
    before = ids(spark, name)
    assert sorted(before.values()) == ["APP-000000", "APP-000001"]
    two = registry.register_applicants(first.unionByName(more), name, location=str(tmp_path))
    assert (two.rows, two.total) == (3, 5)
    after = ids(spark, name)
    assert before.items() <= after.items()
    assert sorted(after.values()) == [f"APP-{n:06d}" for n in range(5)]
    again = registry.register_applicants(more, name, location=str(tmp_path))
    assert (again.rows, again.total) == (0, 5)
    assert ids(spark, name) == after
    spark.sql(f"DROP TABLE {name}")


def test_registry_without_rows_and_with_other_attributes(spark, tmp_path):
    name = fresh("registry")
    nobody = people(spark, ("Ana", "F", "1")).where("false")
    assert registry.register_applicants(nobody, name, location=str(tmp_path)).total == 0
    registry.register_applicants(people(spark, ("Ana", "F", "1")), name, location=str(tmp_path))
    assert ids(spark, name) == {("Ana", "F"): "APP-000000"}
    with pytest.raises(ValueError, match="applicant_gender"):
        registry.new_applicants(
            people(spark, ("Ana", "F", "1")).drop("applicant_gender"), spark.table(name)
        )
    with pytest.raises(ValueError, match="no applicant attribute"):
        registry.new_applicants(spark.range(1))
    spark.sql(f"DROP TABLE {name}")


def test_numbers_are_dense_and_in_the_order_of_the_key(spark):
    rows = spark.range(5000).selectExpr("sha2(cast(id as string), 256) as k").repartition(7)
    for digits in (1, 3):
        found = registry.number_by_key(rows, "k", "n", digits).orderBy("n").collect()
        assert [r.n for r in found] == list(range(5000))
        assert [r.k for r in found] == sorted(r.k for r in found)


def test_loans_look_their_registered_ids_up(spark, tmp_path, loans):
    from loanlake.operators.clean import clean_applications

    name = fresh("registry")
    apps = clean_applications(loans.drop("applicant_ssn"))
    registry.register_applicants(apps, name, location=str(tmp_path))
    fact = star.loan_fact(apps, registry.dimension(spark.table(name)))
    assert {r.applicant_id for r in fact.collect()} == set(ids_of(spark, name))
    spark.sql(f"DROP TABLE {name}")


def ids_of(spark, name):
    return [r.applicant_id for r in spark.table(name).collect()]


@pytest.mark.parametrize("seed", range(2))
def test_days_add_up_to_the_full_summary(spark, state_table, seed):
    name, place = state_table
    parts = [some_rows(10 * seed + day) for day in range(3)]
    for day, rows in zip(DAYS, parts):
        deltas.apply_day(repaid(spark, rows), day, name, **place)
    full = mart.summarise_repayments(repaid(spark, sum(parts, [])))
    assert summary(deltas.summary_of(spark.table(name))) == summary(full)


def test_a_day_applied_again_replaces_what_it_had_added(spark, state_table):
    name, place = state_table
    first, wrong, right = some_rows(1), some_rows(2, loans=60), some_rows(3, loans=10, rows=20)
    deltas.apply_day(repaid(spark, first), DAYS[0], name, **place)
    for rows in (wrong, right, right):
        deltas.apply_day(repaid(spark, rows), DAYS[1], name, **place)
    full = mart.summarise_repayments(repaid(spark, first + right))
    assert summary(deltas.summary_of(spark.table(name))) == summary(full)
    deltas.apply_day(repaid(spark, wrong), DAYS[2], name, **place)
    full = mart.summarise_repayments(repaid(spark, first + right + wrong))
    assert summary(deltas.summary_of(spark.table(name))) == summary(full)


def test_the_first_day_can_be_applied_again(spark, state_table):
    name, place = state_table
    for rows in (some_rows(1, loans=50), some_rows(2, loans=5, rows=9)):
        deltas.apply_day(repaid(spark, rows), DAYS[0], name, **place)
    full = mart.summarise_repayments(repaid(spark, rows))
    assert summary(deltas.summary_of(spark.table(name))) == summary(full)


def test_days_come_in_order(spark, state_table):
    name, place = state_table
    deltas.apply_day(repaid(spark, some_rows(1)), DAYS[1], name, **place)
    with pytest.raises(ValueError, match="after 2024-05-01"):
        deltas.apply_day(repaid(spark, some_rows(2)), DAYS[0], name, **place)


def test_days_without_rows_and_rows_without_a_loan(spark, state_table):
    name, place = state_table
    nothing = repaid(spark, [])
    assert deltas.apply_day(nothing, DAYS[0], name, **place) == []
    lost = repaid(spark, [(None, 5.0, None, False, "Paid"), ("L1", None, None, False, None)])
    deltas.apply_day(lost, DAYS[1], name, **place)
    assert deltas.apply_day(nothing, DAYS[2], name, **place) == []
    assert summary(deltas.summary_of(spark.table(name))) == [("L1", 1, None, None, 0, 0)]


def files_by_bucket(spark, table):
    rows = spark.table(table).selectExpr("_bucket", "input_file_name() as f").distinct().collect()
    return {(r["_bucket"], r.f) for r in rows}


def test_only_touched_buckets_are_rewritten(spark, state_table):
    name, place = state_table
    first = [(f"L{n}", 1.0, None, False, "Paid") for n in range(100)]
    loans = spark.createDataFrame(
        [(f"L{n}", "A", "Auto", 2000.0, 12.0, 1.0, "p", 1.0, date(2024, 1, 1)) for n in range(100)],
        "application_id string, applicant_id string, loan_type string,"
        " loan_amount_requested_usd double, loan_term_months double, interest_rate double,"
        " loan_purpose string, estimated_monthly_payment_usd double, application_date date",
    )
    credit = spark.createDataFrame(
        [("L3", 700.0, "Good", 1.0, 0.0)],
        "application_id string, credit_score double, credit_band string,"
        " credit_utilization_pct double, delinquent_accounts double",
    )
    table, where = f"{name}_mart", {"location": place["location"]}
    every = deltas.apply_day(repaid(spark, first), DAYS[0], name, **place)
    deltas.refresh_mart(loans, credit, name, table, every, **where)
    before = {t: files_by_bucket(spark, t) for t in (name, table)}
    later = [("L3", 2.5, None, True, "Defaulted")]
    touched = deltas.apply_day(repaid(spark, later), DAYS[1], name, **place)
    assert touched == deltas.buckets_with(repaid(spark, later), name)
    assert len(touched) == 1
    deltas.refresh_mart(loans, credit, name, table, touched, **where)
    for t in (name, table):
        kept = files_by_bucket(spark, t) & before[t]
        assert {b for b, _ in kept} == {b for b, _ in before[t]} - set(touched)
    full = mart.loan_performance(loans, repaid(spark, first + later), credit)
    assert summary(spark.table(table).drop(deltas.BUCKET)) == summary(full)


def test_sides_of_a_refresh_meet_in_buckets(spark, state_table):
    name, place = state_table
    first, later = some_rows(5), some_rows(6)
    keys = sorted({r[0] for r in first + later})
    loans = spark.createDataFrame([(k, 5000.0) for k in keys], "application_id string, loan_amount_requested_usd double")
    staged = mart.stage_loans(loans.selectExpr("*", "date'2024-05-01' as application_date"))
    bucketed = staged.withColumn(deltas.BUCKET, deltas.bucket_of(F.col("application_id"), 8))
    summary = mart.summarise_repayments(repaid(spark, first))
    summary = summary.withColumn(deltas.BUCKET, deltas.bucket_of(F.col("application_id"), 8))
    credit = spark.createDataFrame([("L1", 700.0)], "application_id string, credit_score double")
    kept = {c: spark.conf.get(c) for c in (deltas._ALL_KEYS, "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with deltas.met_by_bucket(spark):
            rows = mart.performance_of(bucketed, summary, credit, part=deltas.BUCKET)
            plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept["spark.sql.autoBroadcastJoinThreshold"])
    assert {c: spark.conf.get(c) for c in kept} == kept
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    # The uppermost shuffles, one for each side, deal by bucket alone; nothing follows them.
    assert "hashpartitioning(_bucket" in exchanges[0] and "application_id" not in exchanges[0]
    assert plan.index("SortMergeJoin") < plan.index("Exchange")
    plain = mart.performance_of(staged, mart.summarise_repayments(repaid(spark, first)), credit)
    assert summary_sorted(rows.drop(deltas.BUCKET)) == summary_sorted(plain)


def summary_sorted(df):
    return sorted(map(repr, df.collect()))


def test_a_day_is_merged_in_place_without_a_copy_of_the_table(spark, state_table):
    name, place = state_table
    rows = some_rows(7), some_rows(8)
    staged = Path(urlparse(shared_dir(spark)).path) / "loanlake"
    before = set(staged.glob("*")) if staged.exists() else set()
    for day, some in zip(DAYS, rows, strict=False):
        deltas.apply_day(repaid(spark, some), day, name, **place)
    new = {p.name.rsplit("-", 1)[0] for p in set(staged.glob("*")) - before}
    assert new == {"day_states"}
    both = mart.summarise_repayments(repaid(spark, rows[0] + rows[1]))
    assert summary(deltas.summary_of(spark.table(name))) == summary(both)
