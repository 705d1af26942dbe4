"""Star schema: applicant, employment, contact and kin dimensions, loan fact."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlake import schema
from loanlake.functions.columns import available, select_available
from loanlake.functions.finance import monthly_payment
from loanlake.functions.ids import ID_LENGTH, applicant_id, number_rows, sequential_id
from loanlake.operators.joins import keyed_join
from loanlake.operators.rows import distinct_rows, keep_one
from loanlake.sources.files import ORDER


def applicant_dim(apps: DataFrame, *, id_length: int = ID_LENGTH) -> DataFrame:
    """One row per distinct set of applicant attributes, with the applicant id.

    Without an SSN column the rows are numbered in attribute order; such ids are
    dense but change when applicants are added.
    """
    attributes = available(apps, schema.APPLICANT_ATTRIBUTES)
    if not attributes:
        raise ValueError("applications carry no applicant attribute")
    dim = distinct_rows(apps.select(*attributes))
    if "applicant_ssn" in attributes:
        return dim.withColumn("applicant_id", applicant_id(F.col("applicant_ssn"), id_length))
    numbered = number_rows(dim, attributes, "_number")
    return numbered.withColumn("applicant_id", sequential_id(F.col("_number"))).drop("_number")


def id_collisions(dim: DataFrame) -> DataFrame:
    """Applicant ids shared by several SSNs."""
    return (
        dim.where(F.col("applicant_ssn").isNotNull())
        .groupBy("applicant_id")
        .agg(F.count_distinct("applicant_ssn").alias("ssn_count"))
        .where(F.col("ssn_count") > 1)
    )


def employment_dim(apps: DataFrame) -> DataFrame:
    return keep_one(select_available(apps, [*schema.EMPLOYMENT_COLUMNS, ORDER]), "application_id")


def contact_dim(apps: DataFrame) -> DataFrame:
    return keep_one(select_available(apps, [*schema.CONTACT_COLUMNS, ORDER]), "application_id")


def kin_dim(apps: DataFrame) -> DataFrame:
    return keep_one(select_available(apps, [*schema.KIN_COLUMNS, ORDER]), "application_id")


def attach_applicant(apps: DataFrame, dim: DataFrame) -> DataFrame:
    """Look the applicant id up by all attributes the two frames share, NULL = NULL."""
    shared = [c for c in dim.columns if c in apps.columns and c != "applicant_id"]
    if not shared:
        raise ValueError("applications and dimension share no attribute")
    return keyed_join(apps, dim.select("applicant_id", *shared), shared, null_safe=True)


def loan_fact(
    apps: DataFrame,
    dim: DataFrame | None = None,
    *,
    id_length: int = ID_LENGTH,
    carry: Iterable[str] = (),
) -> DataFrame:
    """One row per cleaned application with its applicant id and monthly payment.

    The id is a function of the SSN and the applicant dimension holds every
    attribute set exactly once, so with an SSN column the lookup would return
    what the hash already says: no ``dim``, no shuffle. Pass ``dim`` to look the
    id up in a given dimension, as is needed where ids are sequential. ``carry``
    names columns of the applications that are kept beside the contract, such as
    the SSN that bureau data is matched on.
    """
    if dim is not None:
        with_id = attach_applicant(apps, dim)
    elif "applicant_ssn" in apps.columns:
        with_id = apps.withColumn(
            "applicant_id", applicant_id(F.col("applicant_ssn"), id_length)
        )
    else:
        raise ValueError("without an SSN column the applicant dimension is needed")
    fact = select_available(with_id, [*schema.FACT_COLUMNS, *carry])
    terms = ("loan_amount_requested_usd", "interest_rate", "loan_term_months")
    if all(c in fact.columns for c in terms):
        fact = fact.withColumn(
            "estimated_monthly_payment_usd", monthly_payment(*[F.col(c) for c in terms])
        )
    return fact
