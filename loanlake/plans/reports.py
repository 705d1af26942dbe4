"""Portfolio reports.

Reports over joins count and sum per key before joining. The sides that meet
then hold one row per key (or per key pair) with the multiplicities needed to
weigh it, instead of raw rows that fan out, and a hot loan or applicant is
already folded when it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlake.functions.finance import exact_sum, report_band
from loanlake.operators.joins import keyed_join
from loanlake.session import stage


def total_by_application(fact_loans: DataFrame, rows: int = 10) -> DataFrame:
    """Applications with the largest requested totals."""
    return (
        fact_loans.groupBy("application_id")
        .agg(exact_sum(F.col("loan_amount_requested_usd")).alias("total_repayment"))
        .orderBy(F.desc_nulls_last("total_repayment"), F.asc_nulls_first("application_id"))
        .limit(rows)
    )


def default_by_band(
    credit: DataFrame, applicants: DataFrame, loans: DataFrame, repayments: DataFrame
) -> DataFrame:
    """Distinct loans and unpaid payment rows per report band.

    Rows are those of credit x applicant x loan x repayment. Applicants and loans
    are matched on the SSN, which ``loans`` (the fact) has to carry: applicant ids
    are made from it and are too short to tell all applicants apart.
    """
    bands = (
        credit.where(F.col("applicant_ssn").isNotNull())
        .groupBy("applicant_ssn", report_band(F.col("credit_score")).alias("credit_band"))
        .agg(F.count("*").alias("_credit_rows"))
    )
    people = (
        applicants.where(F.col("applicant_ssn").isNotNull())
        .groupBy("applicant_ssn")
        .agg(F.count("*").alias("_people_rows"))
    )
    # Staged, so that the last join has a shuffle right below both sides and can be split.
    weights = stage(keyed_join(bands, people, "applicant_ssn", "inner"), "band-weights")
    unpaid = F.count_if(F.col("payment_status") != "Paid")
    paid_loans = repayments.groupBy("application_id").agg(unpaid.alias("_unpaid"))
    loans = (
        loans.where(F.col("applicant_ssn").isNotNull())
        .groupBy("application_id", "applicant_ssn")
        .agg(F.count("*").alias("_loan_rows"))
    )
    loans = keyed_join(loans, paid_loans, "application_id", "inner")
    weight = F.col("_loan_rows") * F.col("_credit_rows") * F.col("_people_rows")
    return (
        keyed_join(loans, weights, "applicant_ssn", "inner")
        .groupBy("credit_band")
        .agg(
            F.count_distinct("application_id").alias("total_loans"),
            F.sum(F.col("_unpaid") * weight).alias("defaults"),
        )
    )


def default_rate_by_band(*tables: DataFrame) -> DataFrame:
    """The same counts with unpaid payments per loan."""
    return default_by_band(*tables).withColumn(
        "defaults_per_loan", F.try_divide("defaults", "total_loans")
    )


def applicants_by_education(applicants: DataFrame) -> DataFrame:
    return applicants.groupBy("applicant_level_of_education").agg(
        F.count("*").alias("total_applicants")
    )


def income_by_employment(employment: DataFrame) -> DataFrame:
    return employment.groupBy("employment_type").agg(
        F.avg("monthly_income_usd").alias("avg_income")
    )


def applications_per_month(fact_loans: DataFrame) -> DataFrame:
    return (
        fact_loans.groupBy(
            F.year("application_date").alias("year"), F.month("application_date").alias("month")
        )
        .agg(F.count("*").alias("total_applications"))
        .orderBy("year", "month")
    )


def repaid_by_income(
    employment: DataFrame, fact_loans: DataFrame, repayments: DataFrame
) -> DataFrame:
    """Amount repaid per monthly income; all three sides are unique per loan."""
    paid = repayments.groupBy("application_id").agg(exact_sum(F.col("amount_paid_usd")).alias("_paid"))
    loans = fact_loans.groupBy("application_id").agg(F.count("*").alias("_loan_rows"))
    return (
        employment.select("application_id", "monthly_income_usd")
        .join(loans, "application_id")
        .join(paid, "application_id")
        .groupBy("monthly_income_usd")
        .agg(exact_sum(F.col("_paid") * F.col("_loan_rows")).alias("total_repaid"))
    )


def applicants_by_state(contacts: DataFrame) -> DataFrame:
    return (
        contacts.groupBy("applicant_state")
        .agg(F.count("*").alias("total_applicants"))
        .orderBy(F.desc("total_applicants"), F.asc_nulls_first("applicant_state"))
    )


def kin_relationships(kin: DataFrame) -> DataFrame:
    return (
        kin.groupBy("next_of_kin_relationship")
        .agg(F.count("*").alias("frequency"))
        .orderBy(F.desc("frequency"), F.asc_nulls_first("next_of_kin_relationship"))
    )
