"""Validation of the cleaned tables before anything is written, and check suites."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlake import schema
from loanlake.operators import quality as q
from loanlake.operators.rejects import as_reject_rows, split_tagged, tag_rows
from loanlake.session import stage

log = logging.getLogger(__name__)


class ValidationError(Exception):
    """A table is not fit to be loaded."""


def invalid_amount(amount: Column) -> Column:
    return amount.isNull() | (amount <= 0) | (amount > schema.MAX_LOAN_AMOUNT)


def invalid_score(score: Column) -> Column:
    return (score < schema.MIN_CREDIT_SCORE) | (score > schema.MAX_CREDIT_SCORE)


def _require(df: DataFrame, column: str) -> None:
    if column not in df.columns:
        raise ValidationError(f"missing column: {column}")


def amount_quality(apps: DataFrame) -> DataFrame:
    """Invalid loan amounts: rows, total, share in percent, within the tolerated share."""
    found = apps.agg(
        F.count_if(invalid_amount(F.col("loan_amount_requested_usd"))).alias("invalid_rows"),
        F.count("*").alias("total_rows"),
    )
    return found.withColumns(
        {
            "invalid_pct": F.try_divide("invalid_rows", "total_rows") * 100,
            "passed": F.col("invalid_rows") <= F.col("total_rows") * schema.MAX_INVALID_SHARE,
        }
    )


def repayment_quality(repayments: DataFrame) -> DataFrame:
    """Negative payments and payments dated in the future."""
    negative = F.count_if(F.col("amount_paid_usd") < 0)
    return repayments.agg(
        negative.alias("negative_rows"),
        F.count_if("is_future_dated").alias("future_rows"),
        F.count("*").alias("total_rows"),
        (negative == 0).alias("passed"),
    )


def credit_quality(credit: DataFrame) -> DataFrame:
    """Scores outside the scale; a missing score is allowed."""
    invalid = F.count_if(invalid_score(F.col("credit_score")))
    return credit.agg(
        invalid.alias("invalid_rows"),
        F.count("*").alias("total_rows"),
        (invalid == 0).alias("passed"),
    )


def validate_applications(apps: DataFrame) -> dict[str, int]:
    """Raise if more than a fifth of the amounts are invalid."""
    if "loan_amount_requested_usd" not in apps.columns:
        log.warning("loan_amount_requested_usd is missing, amounts are not validated")
        return {}
    found = amount_quality(apps).first()
    if found.invalid_rows:
        log.warning("%d invalid loan amounts (%.2f%%)", found.invalid_rows, found.invalid_pct)
    if not found.passed:
        raise ValidationError(
            f"{found.invalid_rows} of {found.total_rows} loan amounts are invalid"
        )
    return {"invalid_rows": found.invalid_rows}


def validate_repayments(repayments: DataFrame) -> None:
    _require(repayments, "loan_application_id")
    if "amount_paid_usd" in repayments.columns:
        found = repayments.agg(
            F.count_if(F.col("amount_paid_usd") < 0).alias("negative")
        ).first()
        if found.negative:
            raise ValidationError(f"{found.negative} repayments are negative")


def validate_credit(credit: DataFrame) -> None:
    _require(credit, "applicant_ssn")
    if "credit_score" in credit.columns:
        found = credit_quality(credit).first()
        if not found.passed:
            raise ValidationError(f"{found.invalid_rows} credit scores are out of range")


def validate_fact(fact_loans: DataFrame) -> None:
    _require(fact_loans, "application_id")


def gate(
    apps: DataFrame, repayments: DataFrame, credit: DataFrame, fact_loans: DataFrame
) -> dict[str, int]:
    """All table validations; the first that fails stops the run."""
    validate_fact(fact_loans)
    summary = validate_applications(apps)
    validate_repayments(repayments)
    validate_credit(credit)
    return summary


def row_rules(source: str, columns: list[str]) -> list[q.RowCheck]:
    """The gate's rules that single rows fail, as far as a source has the columns."""
    rules = {
        "loan_applications": [
            q.not_null("application_id"),
            q.RowCheck(
                "valid_amount",
                "loan_amount_requested_usd",
                invalid_amount(F.col("loan_amount_requested_usd")),
            ),
        ],
        "loan_repayments": [
            q.not_null("application_id"),
            q.expression_is_true("amount_paid_usd", "amount_paid_usd >= 0"),
            q.not_flagged("is_future_dated"),
        ],
        "credit_bureau": [
            q.not_null("application_id"),
            q.RowCheck("valid_score", "credit_score", invalid_score(F.col("credit_score"))),
        ],
    }
    return [rule for rule in rules[source] if rule.column in columns]


def set_aside(cleaned: Mapping[str, DataFrame]) -> tuple[dict[str, DataFrame], DataFrame]:
    """Cleaned sources without the rows that fail a critical rule, and those rows.

    A source is staged once with the failed rules of every row, from which both come.
    The rejects of all sources have one form (``as_reject_rows``). More than the
    tolerated share of invalid amounts is still an error of the source, not of rows.
    """
    validate_applications(cleaned["loan_applications"])
    kept, rejects = {}, []
    for name, df in cleaned.items():
        tagged = stage(tag_rows(df, row_rules(name, df.columns)), f"tagged_{name}")
        parts = split_tagged(tagged)
        kept[name] = parts.kept
        rejects.append(as_reject_rows(parts.rejects, name))
    return kept, q.all_results(*rejects)


def loaded_suite(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Keys of the loaded star: unique in the dimensions and the fact, and known where referred to.

    Give the tables as they were written. Equal ids of different applicants, which
    short ids allow, are found here too, as ids that occur more than once.
    """
    application = {
        name: q.Keys(name, "application_id", "application")
        for name in ("dim_employment", "dim_contact_info", "dim_next_of_kin", "fact_loans")
    }
    repayments = q.Keys("fact_repayments", "application_id", "application")
    applicants = q.Keys("dim_applicants", "applicant_id", "applicant")
    of_loans = q.Keys("fact_loans", "applicant_id", "applicant")
    fact = application["fact_loans"]
    return q.key_suite(
        tables,
        unique=[*application.values(), applicants],
        references=[
            q.Reference(of_loans, applicants),
            *[q.Reference(one, fact) for one in application.values() if one is not fact],
            *[q.Reference(fact, one) for one in application.values() if one is not fact],
            q.Reference(repayments, fact, q.WARNING),
        ],
    )


def staging_suite(staged_loans: DataFrame) -> DataFrame:
    """Checks on the staging view."""
    rows = q.run_row_checks(
        staged_loans,
        [
            q.not_null("application_id"),
            q.not_null("applicant_id"),
            q.not_null("loan_amount_requested_usd"),
            q.expression_is_true("loan_amount_requested_usd", "loan_amount_requested_usd > 0"),
            q.not_null("loan_type"),
            q.accepted_values("loan_type", schema.LOAN_TYPES),
            q.not_null("application_date"),
        ],
    )
    return q.all_results(rows, q.unique(staged_loans, "application_id"))


def mart_suite(mart: DataFrame) -> DataFrame:
    """Checks on the mart; a negative balance is an overpayment and only flagged."""
    rows = q.run_row_checks(
        mart,
        [
            q.not_null("application_id"),
            q.not_null("applicant_id"),
            q.not_null("loan_segment"),
            q.accepted_values("loan_segment", schema.LOAN_SEGMENTS),
            q.expression_is_true(
                "outstanding_balance_usd", "outstanding_balance_usd >= 0", severity=q.WARNING
            ),
            q.accepted_values("credit_band", schema.CREDIT_BANDS, "credit_band is not null"),
            q.not_null("is_high_risk"),
        ],
    )
    return q.all_results(rows, q.unique(mart, "application_id"))


def loan_suite(loans: DataFrame) -> DataFrame:
    """Result form of the loan expectations: keys set, amount within limits."""
    checks = [q.not_null("application_id"), q.not_null("applicant_id")]
    if "loan_amount_requested_usd" in loans.columns:
        checks.append(q.between("loan_amount_requested_usd", *schema.SUITE_AMOUNT_RANGE))
    return q.run_row_checks(loans, checks)


def documented_suite(tables: dict[str, DataFrame]) -> DataFrame:
    """Promised rules on the star: key uniqueness, amounts, dates, references."""
    results = []
    for name in ("dim_employment", "dim_contact_info", "dim_next_of_kin"):
        found = q.unique(tables[name], "application_id")
        results.append(found.withColumn("table_name", F.lit(name)))
    fact = tables["fact_loans"]
    amounts = [
        q.not_null("application_id"),
        q.between(
            "loan_amount_requested_usd", *schema.DOCUMENTED_AMOUNT_RANGE, severity=q.WARNING
        ),
    ]
    results.append(q.run_row_checks(fact, amounts).withColumn("table_name", F.lit("fact_loans")))
    applicants = q.references(fact, "applicant_id", tables["dim_applicants"], "applicant_id")
    results.append(applicants.withColumn("table_name", F.lit("fact_loans")))
    dated = q.run_row_checks(tables["fact_repayments"], [q.not_flagged("is_future_dated")])
    loans = q.references(
        tables["fact_repayments"], "application_id", fact, "application_id", q.WARNING
    )
    for found in (dated, loans):
        results.append(found.withColumn("table_name", F.lit("fact_repayments")))
    return q.all_results(*results)
