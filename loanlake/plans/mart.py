"""Staging view and the loan-performance marts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlake import schema
from loanlake.functions.columns import select_typed
from loanlake.functions.finance import (
    exact_sum,
    is_high_risk,
    loan_segment,
    or_zero,
    round_cents,
    value_tier,
)
from loanlake.operators.joins import keyed_join


def stage_loans(fact_loans: DataFrame, carry: Iterable[str] = ()) -> DataFrame:
    """Staging projection: eight columns, the application day and the load time.

    ``carry`` names further columns to keep, such as the SSN for the mart.
    """
    return fact_loans.select(
        *carry,
        *select_typed(fact_loans, schema.STAGING_TYPES),
        F.col("application_date").cast("date").alias("application_date"),
        F.current_timestamp().alias("_loaded_at"),
    )


def summarise_repayments(repayments: DataFrame) -> DataFrame:
    """One row per loan; partial sums are formed before the shuffle."""
    defaulted = F.when(F.col("payment_status") == "Defaulted", 1).otherwise(0)
    return repayments.groupBy("application_id").agg(
        F.count("*").alias("total_payments_made"),
        exact_sum(F.col("amount_paid_usd")).alias("total_amount_paid_usd"),
        F.max("repayment_date").alias("last_payment_date"),
        F.count_if("is_delinquent").alias("delinquent_payment_count"),
        F.max(defaulted).alias("has_defaulted"),
    )


def loan_performance(
    staged_loans: DataFrame,
    repayments: DataFrame,
    credit: DataFrame,
    *,
    credit_key: str = "application_id",
) -> DataFrame:
    """Loans with repayment totals, credit profile, segment and risk flag.

    ``credit_key="applicant_ssn"`` is for bureau data that knows no application:
    it is matched on the SSN itself, which ``staged_loans`` has to carry, as
    applicant ids are too short to tell all applicants apart. Several bureau rows
    for one key repeat the loan; the uniqueness check on the mart reports that.
    """
    summary = summarise_repayments(repayments)
    return performance_of(staged_loans, summary, credit, credit_key=credit_key)


def performance_of(
    staged_loans: DataFrame,
    summary: DataFrame,
    credit: DataFrame,
    *,
    credit_key: str = "application_id",
    part: str | None = None,
) -> DataFrame:
    """``loan_performance`` from repayments that are summarised already.

    ``part`` names a column of loans and summary that follows from the loan alone, and
    is kept: the two are dealt out by it before they meet, so the result can be written
    by it without another shuffle.
    """
    if credit_key not in ("applicant_ssn", "application_id"):
        raise ValueError(f"unknown credit key: {credit_key}")
    if credit_key not in staged_loans.columns:
        raise ValueError(f"matching by {credit_key} needs that column in the staged loans")
    profile = credit.select(credit_key, *select_typed(credit, schema.MART_CREDIT_TYPES))
    summary = summary.withColumnRenamed("has_defaulted", "_defaulted")
    # The bureau first: totals are not carried through the shuffle by its key.
    joined = keyed_join(staged_loans, profile.where(F.col(credit_key).isNotNull()), credit_key)
    parts = [] if part is None else [part]
    if parts:
        joined, summary = joined.repartition(*parts), summary.repartition(*parts)
    joined = keyed_join(joined, summary, [*parts, "application_id"])
    amount = F.col("loan_amount_requested_usd")
    paid = or_zero(F.col("total_amount_paid_usd"))
    overdue = F.col("delinquent_payment_count")
    return joined.select(
        "application_id",
        "applicant_id",
        "loan_type",
        "loan_amount_requested_usd",
        "loan_term_months",
        "interest_rate",
        "loan_purpose",
        "estimated_monthly_payment_usd",
        "application_date",
        loan_segment(amount).alias("loan_segment"),
        or_zero(F.col("total_payments_made")).alias("total_payments_made"),
        paid.alias("total_amount_paid_usd"),
        "last_payment_date",
        or_zero(overdue).alias("delinquent_payment_count"),
        (or_zero(F.col("_defaulted")) == 1).alias("has_defaulted"),
        round_cents(amount - paid).alias("outstanding_balance_usd"),
        "credit_score",
        "credit_band",
        "credit_utilization_pct",
        "delinquent_accounts",
        is_high_risk(overdue, F.col("credit_band")).alias("is_high_risk"),
        *parts,
    )


def loan_tiers(staged_loans: DataFrame) -> DataFrame:
    """Slim mart: loan, applicant, amount and value tier."""
    return staged_loans.select(
        "application_id",
        "applicant_id",
        "loan_amount_requested_usd",
        value_tier(F.col("loan_amount_requested_usd")).alias("loan_segment"),
    )
