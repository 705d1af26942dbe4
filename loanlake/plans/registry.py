"""Sequential applicant ids that stay: a registry that only grows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from loanlake import schema
from loanlake.functions.columns import available
from loanlake.functions.ids import row_key, sequential_id
from loanlake.operators.rows import distinct_rows
from loanlake.session import stage
from loanlake.sources.tables import Written, full_name, write_counted

KEY = "applicant_key"
NUMBER = "applicant_number"
#: Leading hex digits of the key that make a bucket: 16 ** 3 sorts beside each other.
BUCKET_DIGITS = 3


def number_by_key(df: DataFrame, key: str, name: str, digits: int = BUCKET_DIGITS) -> DataFrame:
    """Number rows 0, 1, 2… in the order of a hex digest, without a global sort.

    Buckets are prefixes of the digest, so their order is that of the digests and a
    row's number is the rows of all buckets before its own plus its place there. Digests
    spread evenly, and there are at most ``16 ** digits`` buckets to broadcast. Equal
    digests get neighbouring numbers in any order.
    """
    bucketed = df.withColumn("_bucket", F.substring(key, 1, digits))
    placed = bucketed.withColumn("_place", F.row_number().over(W.partitionBy("_bucket").orderBy(key)))
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("_bucket")
        .agg(F.count("*").alias("_rows"))
        .select("_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        placed.join(F.broadcast(offsets), "_bucket")
        .withColumn(name, F.col("_offset") + F.col("_place") - 1)
        .drop("_bucket", "_place", "_offset")
    )


def new_applicants(apps: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """Distinct applicants that the registry lacks, numbered above all that it has.

    Two rows are one applicant if all their attributes are equal, NULL equal to NULL.
    The registry has to have been made with the same attributes. Applicants are found
    by the digest of their attributes, so a wide registry is read in one column.
    """
    attributes = available(apps, schema.APPLICANT_ATTRIBUTES)
    if not attributes:
        raise ValueError("applications carry no applicant attribute")
    found = distinct_rows(apps.select(*attributes)).withColumn(KEY, row_key(attributes, ""))
    first = 0
    if registry is not None:
        known = [c for c in registry.columns if c not in (KEY, NUMBER, "applicant_id")]
        if sorted(known) != sorted(attributes):
            differing = sorted(set(known) ^ set(attributes))
            raise ValueError(f"attributes of the registry differ: {', '.join(differing)}")
        found = found.join(registry.select(KEY), KEY, "left_anti")
        highest = registry.agg(F.max(NUMBER)).first()[0]
        first = 0 if highest is None else highest + 1
    # Counted and numbered from one written copy.
    numbered = number_by_key(stage(found, "new_applicants"), KEY, "_number")
    number = F.col("_number") + first
    return numbered.select(
        *attributes, KEY, number.alias(NUMBER), sequential_id(number).alias("applicant_id")
    )


def register_applicants(
    apps: DataFrame, name: str, *, database: str | None = None, location: str | None = None
) -> Written:
    """Add the new applicants of ``apps`` to the registry table; known ones keep their ids.

    Nothing that is in the table changes, so a load that is repeated adds no row. The
    table is made by its first load. It takes one writer at a time: two at once could
    give the same numbers. ``dimension`` is the applicant dimension of the table.
    """
    spark, table = apps.sparkSession, full_name(name, database)
    registry = spark.table(table) if spark.catalog.tableExists(table) else None
    added = stage(new_applicants(apps, registry), "registered")
    mode = "WRITE_TRUNCATE" if registry is None else "WRITE_APPEND"
    return write_counted(added, name, database=database, location=location, mode=mode)


def dimension(registry: DataFrame) -> DataFrame:
    """Attributes and ids, as ``star.loan_fact`` looks them up."""
    return registry.drop(KEY, NUMBER)
