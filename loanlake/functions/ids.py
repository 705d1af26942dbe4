"""Identifiers that are the same on every run."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from loanlake.session import stage

# Form of an applicant id.
ID_PREFIX = "APP-"
ID_LENGTH = 8
UNKNOWN_ID = "APP-UNKNOWN"

_SEPARATOR = "\u001f"
_MISSING = "\u001e"


def applicant_id(ssn: Column, length: int = ID_LENGTH) -> Column:
    """Prefix plus the first hex digits of the SSN's SHA-256; no SSN, one shared id.

    Eight digits are 32 bits, so collisions are likely from some 100k applicants
    on. The id is for display: joins of this package match on the SSN itself.
    Raise ``length`` where ids must be unique (see ``id_collisions``).
    """
    digest = F.substring(F.sha2(ssn.cast("string"), 256), 1, length)
    return F.coalesce(F.concat(F.lit(ID_PREFIX), digest), F.lit(UNKNOWN_ID))


def row_key(columns: Iterable[str], prefix: str) -> Column:
    """Surrogate key: whole SHA-256 of the row's values; NULL differs from empty text."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(_MISSING)) for c in columns]
    return F.concat(F.lit(prefix), F.sha2(F.concat_ws(_SEPARATOR, *parts), 256))


def number_rows(df: DataFrame, order: Iterable[str], name: str) -> DataFrame:
    """Number rows 0, 1, 2… in a total order without a one-task global window.

    A range-partitioned sort puts the rows in order; the position inside each
    sorted partition comes from ``monotonically_increasing_id``. Staging that
    result pins the partitioning, so the offsets (one row per partition) always
    belong to the rows they are added to. The sort runs and is written when this
    is called, not when the result is used.
    """
    local_bits = 33
    placed = stage(
        df.orderBy(*[F.col(c).asc_nulls_first() for c in order]).withColumn(
            "_place", F.monotonically_increasing_id()
        ),
        "numbered",
    ).withColumns(
        {
            "_part": F.shiftright("_place", local_bits),
            "_row": F.col("_place").bitwiseAND(F.lit((1 << local_bits) - 1)),
        }
    )
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    # At most one row per sort partition, so the broadcast cannot grow with the data.
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_row"))
        .drop("_place", "_part", "_row", "_offset")
    )


def sequential_id(number: Column) -> Column:
    """Zero-padded to six digits, longer numbers kept whole."""
    return F.concat(F.lit(ID_PREFIX), F.format_string("%06d", number))
