"""Row filters, duplicate removal and key columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from loanlake.sources.files import ORDER


#: Hex digits of a SHA-256 that stand for the columns a distinct does not carry.
DIGEST_DIGITS = 32


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Whole rows once, NULL equal to NULL; copies collapse before the shuffle.

    Rows that tell their place in a source keep the first place of their copies.
    ``columns`` are the only ones wanted of rows of text: of the others a digest of 128
    bits is shuffled, so rows that differ in them alone still stay apart.
    """
    if columns is not None:
        others = [f"`{c}`" for c in df.columns if c not in (*columns, ORDER)]
        placed = [c for c in (*columns, ORDER) if c in df.columns]
        if others:
            digest = F.substring(F.sha2(F.to_json(F.struct(*others)), 256), 1, DIGEST_DIGITS)
            df = df.select(*[f"`{c}`" for c in placed], F.unhex(digest).alias("_others"))
        return distinct_rows(df).select(*[f"`{c}`" for c in placed])
    if ORDER not in df.columns:
        return df.distinct()
    values = [c for c in df.columns if c != ORDER]
    return df.groupBy(*[f"`{c}`" for c in values]).agg(F.min(ORDER).alias(ORDER)).select(df.columns)


def keep_one(df: DataFrame, key: str) -> DataFrame:
    """One row per key: the first in its source, else the smallest in the order of all other columns.

    Neither choice depends on how the input is spread over tasks: the place in the
    source, which the scan can add, is dropped from the result. Spark limits each
    task to one row per key before the shuffle (WindowGroupLimit), so a hot key
    sends one row per task.
    """
    others = [c for c in df.columns if c not in (key, ORDER)]
    order = [F.col(c).asc_nulls_first() for c in others] or [F.col(key)]
    if ORDER in df.columns:
        order = [F.col(ORDER), *order]
    rank = F.row_number().over(W.partitionBy(key).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank", ORDER)


def drop_missing(
    df: DataFrame, columns: Sequence[str], dropped: Observation | None = None
) -> DataFrame:
    """Rows with all the given columns set.

    One predicate per column and not ``na.drop``: its single predicate over all
    columns is neither pushed to a scan nor handled well by constraint inference,
    which doubles its copies with every column that is renamed or converted.

    ``dropped`` collects the number of rows removed while the plan runs, which
    saves a counting pass but keeps the filter above the observation.
    """
    if dropped is not None:
        missing = reduce(or_, [F.col(c).isNull() for c in columns])
        df = df.observe(dropped, F.count_if(missing).alias("dropped"))
    return df.where(reduce(and_, [F.col(c).isNotNull() for c in columns]))


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Rows without any missing value."""
    return drop_missing(df, [f"`{c}`" for c in df.columns])


def repayment_key(df: DataFrame) -> str:
    """Name of the loan key column of a repayment source."""
    for name in ("loan_application_id", "application_id"):
        if name in df.columns:
            return name
    raise KeyError("repayments need loan_application_id or application_id")


def fill_credit_keys(df: DataFrame) -> DataFrame:
    """Give a bureau source both key columns; a missing one copies the other."""
    has = [c for c in ("application_id", "applicant_ssn") if c in df.columns]
    if not has:
        raise ValueError(
            "credit data needs application_id or applicant_ssn, "
            f"found: {', '.join(df.columns)}"
        )
    if len(has) == 2:
        return df
    missing = "applicant_ssn" if has[0] == "application_id" else "application_id"
    return df.withColumn(missing, F.col(has[0]))
