"""Cleaners of the three raw sources, current and older rules."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from loanlake import schema
from loanlake.functions.columns import available, rename_columns
from loanlake.functions.finance import credit_band, is_delinquent, is_future
from loanlake.functions.parse import (
    ISO,
    digits_only,
    parse_numbers,
    parse_phones,
    parse_timestamps,
)
from loanlake.operators.rows import (
    distinct_rows,
    drop_incomplete,
    drop_missing,
    fill_credit_keys,
    repayment_key,
)
from loanlake.sources.files import ORDER


def clean_applications(
    raw: DataFrame,
    *,
    date_formats: Iterable[str] = (ISO,),
    distinct: bool = True,
    columns: Iterable[str] | None = None,
    dropped: Observation | None = None,
) -> DataFrame:
    """Names, exact copies, missing key, then dates, numbers and phones.

    Copies are compared as raw text, before anything is parsed; where the scan tells
    the place of a row in its source, the first of its copies gives it. Pass
    ``distinct=False`` where the consumer removes duplicates itself on fewer
    columns, as the dimensions do: it saves the widest shuffle of all. ``columns`` are
    the only ones wanted of the distinct rows, the key among them.
    """
    df = rename_columns(raw)
    wanted = None if columns is None else available(df, columns)
    if distinct:
        df = distinct_rows(df, wanted)
    elif wanted is not None:
        df = df.select(*wanted)
    df = drop_missing(df, ["application_id"], dropped)
    df = parse_timestamps(df, schema.APPLICATION_DATES, date_formats)
    df = parse_numbers(df, schema.APPLICATION_NUMBERS)
    return parse_phones(df, schema.APPLICATION_PHONES)


def clean_repayments(
    raw: DataFrame,
    *,
    as_of: Column | None = None,
    date_formats: Iterable[str] = (ISO,),
    distinct: bool = True,
) -> DataFrame:
    """Names, exact copies, missing keys, then values and the two flags.

    A row whose date is present but unreadable stays, with a NULL date. The loan
    key is offered as ``application_id`` and under its original name.
    """
    df = rename_columns(raw.drop(ORDER))
    if distinct:
        df = distinct_rows(df)
    key = repayment_key(df)
    df = drop_missing(df, [key, "repayment_date"])
    df = parse_timestamps(df, ["repayment_date"], date_formats)
    df = parse_numbers(df, ["amount_paid_usd", "days_overdue"])
    as_of = F.localtimestamp() if as_of is None else as_of
    derived = {
        "application_id": F.col(key),
        "is_future_dated": is_future(F.col("repayment_date"), as_of),
        "is_delinquent": F.lit(False),
    }
    if "days_overdue" in df.columns:
        derived["days_overdue"] = F.coalesce("days_overdue", F.lit(0.0))
        derived["is_delinquent"] = is_delinquent(F.col("days_overdue"))
    return df.withColumns(derived)


def clean_credit(
    raw: DataFrame, *, date_formats: Iterable[str] = (ISO,), distinct: bool = True
) -> DataFrame:
    """Names, both key columns, missing key, exact copies, values, credit band."""
    df = fill_credit_keys(rename_columns(raw.drop(ORDER)))
    df = drop_missing(df, ["application_id"])
    if distinct:
        df = distinct_rows(df)
    df = parse_numbers(df, schema.CREDIT_NUMBERS)
    df = parse_timestamps(df, ["bureau_pull_date"], date_formats)
    if "credit_score" in df.columns:
        df = df.withColumn("credit_band", credit_band(F.col("credit_score")))
    return df


def credit_band_distribution(credit: DataFrame) -> DataFrame:
    """Rows per known credit band."""
    return (
        credit.where(F.col("credit_band").isNotNull())
        .groupBy("credit_band")
        .agg(F.count("*").alias("rows_in_band"))
    )


def legacy_clean_applications(raw: DataFrame) -> DataFrame:
    """Exact copies, rows with any gap, names, strict dates, digits-only phones."""
    df = rename_columns(drop_incomplete(distinct_rows(raw)), "legacy_applications")
    df = parse_timestamps(df, schema.APPLICATION_DATES)
    return parse_phones(df, schema.LEGACY_APPLICATION_PHONES, digits_only)


def legacy_clean_repayments(raw: DataFrame) -> DataFrame:
    df = rename_columns(drop_incomplete(distinct_rows(raw)), "legacy_repayments")
    return parse_timestamps(df, ["repayment_date"])


def legacy_clean_credit(raw: DataFrame) -> DataFrame:
    return rename_columns(drop_incomplete(distinct_rows(raw)), "legacy_credit")
