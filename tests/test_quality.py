"""Checks, suites and the gate."""

import pytest
from conftest import text_frame

from loanlake.operators import quality as q
from loanlake.plans import gate


def amounts(spark, values):
    return spark.createDataFrame(
        [(f"L{i}", v) for i, v in enumerate(values)],
        "application_id string, loan_amount_requested_usd double",
    )


def test_a_fifth_of_bad_amounts_is_tolerated(spark):
    ok = amounts(spark, [0.0] * 20 + [100.0] * 80)
    assert gate.validate_applications(ok) == {"invalid_rows": 20}
    bad = amounts(spark, [None] * 7 + [-1.0] * 7 + [500001.0] * 7 + [500000.0] * 79)
    with pytest.raises(gate.ValidationError, match="21 of 100"):
        gate.validate_applications(bad)


def test_no_amounts_and_no_rows(spark):
    assert gate.validate_applications(text_frame(spark, ["application_id"], [("1",)])) == {}
    assert gate.validate_applications(amounts(spark, [])) == {"invalid_rows": 0}


def test_negative_payment_stops_the_run(spark):
    schema = "loan_application_id string, amount_paid_usd double"
    gate.validate_repayments(spark.createDataFrame([("1", 0.0), ("2", None)], schema))
    with pytest.raises(gate.ValidationError, match="negative"):
        gate.validate_repayments(spark.createDataFrame([("1", -0.01)], schema))
    with pytest.raises(gate.ValidationError, match="loan_application_id"):
        gate.validate_repayments(text_frame(spark, ["application_id"], [("1",)]))


@pytest.mark.parametrize("score, fine", [(300.0, True), (850.0, True), (None, True), (299.0, False), (851.0, False)])
def test_score_range(spark, score, fine):
    df = spark.createDataFrame([("s", score), ("t", 700.0)], "applicant_ssn string, credit_score double")
    if fine:
        gate.validate_credit(df)
    else:
        with pytest.raises(gate.ValidationError, match="out of range"):
            gate.validate_credit(df)


def test_required_columns(spark):
    df = text_frame(spark, ["other"], [("1",)])
    with pytest.raises(gate.ValidationError, match="applicant_ssn"):
        gate.validate_credit(df)
    with pytest.raises(gate.ValidationError, match="application_id"):
        gate.validate_fact(df)


def results(df):
    return {(r.check_name, r.column_name): (r.failed_rows, r.total_rows, r.passed) for r in df.collect()}


def test_row_checks(spark):
    df = spark.createDataFrame(
        [("a", 1.0, True), ("b", None, False), (None, 200.0, None)], "k string, x double, f boolean"
    )
    found = results(
        q.run_row_checks(
            df,
            [
                q.not_null("k"),
                q.accepted_values("k", ["a"]),
                q.between("x", 1, 100),
                q.expression_is_true("x", "x > 0"),
                q.not_flagged("f"),
            ],
        )
    )
    assert found == {
        ("not_null", "k"): (1, 3, False),
        ("accepted_values", "k"): (1, 3, False),
        ("between", "x"): (1, 3, False),
        ("expression_is_true", "x"): (0, 3, True),
        ("not_flagged", "f"): (1, 3, False),
    }


def test_where_limits_a_check(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 1)], "k string, n int")
    found = results(
        q.run_row_checks(
            df,
            [
                q.accepted_values("k", ["a"], where="n = 1"),
                q.expression_is_true("n", "n > 1", where="k = 'b'"),
            ],
        )
    )
    assert [v[0] for v in found.values()] == [1, 1]


def test_unique_and_references(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,), ("z",), ("z",)], "k string")
    right = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "id string")
    assert results(q.unique(left, "k")) == {("unique", "k"): (2, 3, False)}
    assert results(q.references(left, "k", right, "id")) == {("references", "k"): (2, 1, False)}
    assert results(q.references(right, "id", left, "k"))[("references", "id")] == (0, 0, True)


def test_failures_name_critical_checks(spark):
    df = spark.createDataFrame([(None, -1.0)], "k string, x double")
    found = q.run_row_checks(
        df, [q.not_null("k"), q.expression_is_true("x", "x >= 0", severity=q.WARNING)]
    )
    assert q.failures(found) == ["not_null(k): 1"]
    assert len(q.failures(found, None)) == 2


def test_loan_suite_without_amounts(spark):
    df = text_frame(spark, ["application_id", "applicant_id"], [("1", None)])
    assert results(gate.loan_suite(df)) == {
        ("not_null", "application_id"): (0, 1, True),
        ("not_null", "applicant_id"): (1, 1, False),
    }
