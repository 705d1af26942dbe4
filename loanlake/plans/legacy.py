"""Older star schema: each dimension hangs on the applicant and has its own key."""

from __future__ import annotations

from pyspark.sql import DataFrame

from loanlake import schema
from loanlake.functions.columns import available, keys_first, select_available
from loanlake.functions.ids import row_key
from loanlake.operators.rows import distinct_rows
from loanlake.plans.star import attach_applicant


def _attributes(apps: DataFrame) -> list[str]:
    attributes = available(apps, schema.APPLICANT_ATTRIBUTES)
    if not attributes:
        raise ValueError("applications carry no applicant attribute")
    return attributes


def legacy_applicants(apps: DataFrame) -> DataFrame:
    """Distinct applicants; the key is hashed from the row, so it is stable."""
    attributes = _attributes(apps)
    dim = distinct_rows(apps.select(*attributes))
    return dim.withColumn("applicant_id", row_key(attributes, "Ap"))


def with_applicant(apps: DataFrame, applicants: DataFrame | None = None) -> DataFrame:
    """Applications with their applicant key: computed, or looked up if a table is given."""
    if applicants is not None:
        return attach_applicant(apps, applicants)
    return apps.withColumn("applicant_id", row_key(_attributes(apps), "Ap"))


def _dimension(keyed: DataFrame, columns, key: str, prefix: str) -> DataFrame:
    dim = distinct_rows(select_available(keyed, [*columns, "applicant_id"]))
    return dim.withColumn(key, row_key(dim.columns, prefix))


def legacy_employment(keyed: DataFrame) -> DataFrame:
    dim = _dimension(keyed, schema.LEGACY_EMPLOYMENT_COLUMNS, "employment_id", "Em")
    return keys_first(dim, "applicant_id", "employment_id")


def legacy_contact_info(keyed: DataFrame) -> DataFrame:
    dim = _dimension(keyed, schema.LEGACY_CONTACT_COLUMNS, "contact_info_id", "Ci")
    return keys_first(dim, "contact_info_id", "applicant_id")


def legacy_next_of_kin(keyed: DataFrame) -> DataFrame:
    dim = _dimension(keyed, schema.LEGACY_KIN_COLUMNS, "next_of_kin_id", "Nk")
    return keys_first(dim, "next_of_kin_id", "applicant_id")


def legacy_loan_fact(keyed: DataFrame) -> DataFrame:
    return select_available(keyed, schema.LEGACY_FACT_COLUMNS)


def legacy_tables(
    applications: DataFrame, repayments: DataFrame, credit: DataFrame
) -> dict[str, DataFrame]:
    """The eight tables of the older schema from cleaned sources."""
    keyed = with_applicant(applications)
    return {
        "loan_repayments": repayments,
        "loan_applications": applications,
        "applicant": legacy_applicants(applications),
        "employment": legacy_employment(keyed),
        "contact_info": legacy_contact_info(keyed),
        "next_of_kin": legacy_next_of_kin(keyed),
        "loan_application_fact": legacy_loan_fact(keyed),
        "credit_bureau": credit,
    }
