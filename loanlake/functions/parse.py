"""Text to value conversions that turn bad input into NULL and never raise."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What is removed from phone numbers, now and by the older rule.
NOT_PHONE = r"[^\p{Nd}+]"
NOT_DIGIT = r"[^\p{Nd}]"

# Spark's own cast also takes "1d", "0x1p3" and "nan"; those are not numbers here.
NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf(inity)?)\s*$"
ISO_DATE = r"^\s*\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?\s*$"
ISO = "iso"


def text_to_number(text: Column) -> Column:
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def text_to_timestamp(text: Column, formats: Iterable[str] = (ISO,)) -> Column:
    """First declared format that fits, as a zone-free timestamp.

    ``ISO`` is a date, alone or with a time of day behind a space or a T, with or
    without space around it. It goes through the cast and not through a pattern
    parser: the parser throws and catches an exception for every bad value.
    """
    parsed = [
        F.when(text.rlike(ISO_DATE), F.trim(text).try_cast("timestamp_ntz"))
        if fmt == ISO
        else F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz")
        for fmt in formats
    ]
    return parsed[0] if len(parsed) == 1 else F.coalesce(*parsed)


def clean_phone(text: Column) -> Column:
    """Keep digits and plus signs; nothing left means NULL."""
    return F.nullif(F.regexp_replace(text, NOT_PHONE, ""), F.lit(""))


def digits_only(text: Column) -> Column:
    return F.regexp_replace(text, NOT_DIGIT, "")


def _replace(df: DataFrame, columns: Iterable[str], convert) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: convert(c, df.schema[c].dataType) for c in present})


def parse_numbers(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Present columns to double; NaN becomes NULL so comparisons stay sound."""

    def convert(name: str, dtype: T.DataType) -> Column:
        c = F.col(name)
        if isinstance(dtype, T.StringType):
            return text_to_number(c)
        number = c.cast("double")
        if isinstance(dtype, (T.DoubleType, T.FloatType)):
            return F.when(~F.isnan(number), number)
        return number

    return _replace(df, columns, convert)


def parse_timestamps(
    df: DataFrame, columns: Iterable[str], formats: Iterable[str] = (ISO,)
) -> DataFrame:
    formats = tuple(formats)

    def convert(name: str, dtype: T.DataType) -> Column:
        c = F.col(name)
        if isinstance(dtype, T.StringType):
            return text_to_timestamp(c, formats)
        return c.cast("timestamp_ntz")

    return _replace(df, columns, convert)


def parse_phones(df: DataFrame, columns: Iterable[str], clean=clean_phone) -> DataFrame:
    return _replace(df, columns, lambda name, _: clean(F.col(name).cast("string")))
