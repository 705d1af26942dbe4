"""Rows that fail checks are set aside instead of stopping a load."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlake.operators.quality import CRITICAL, RowCheck

FAILED = "_failed_checks"
SEPARATOR = "; "


def check_name(check: RowCheck) -> str:
    return f"{check.name}({check.column})"


def failed_checks(checks: Sequence[RowCheck], severity: str | None = CRITICAL) -> Column:
    """Names of the checks that a row fails, in their order; NULL counts as passed."""
    names = [
        F.when(c.failed, F.lit(check_name(c)))
        for c in checks
        if severity is None or c.severity == severity
    ]
    return F.array_compact(F.array(*names).cast("array<string>"))


@dataclass(frozen=True)
class Split:
    """``kept`` rows pass every check; ``rejects`` have their failed checks in ``_failed_checks``."""

    kept: DataFrame
    rejects: DataFrame


def tag_rows(
    df: DataFrame, checks: Sequence[RowCheck], severity: str | None = CRITICAL
) -> DataFrame:
    """All rows with ``_failed_checks``; one projection, whatever the number of checks."""
    return df.withColumn(FAILED, failed_checks(checks, severity))


def split_tagged(tagged: DataFrame) -> Split:
    """The two parts of tagged rows. Give a staged frame: the checks are then evaluated once."""
    passed = F.size(FAILED) == 0
    return Split(tagged.where(passed).drop(FAILED), tagged.where(~passed))


def as_reject_rows(rejects: DataFrame, source: str) -> DataFrame:
    """``source``, ``failed_checks`` and the row as JSON: one form for the rejects of all tables."""
    values = [c for c in rejects.columns if c != FAILED]
    return rejects.select(
        F.lit(source).alias("source"),
        F.array_join(FAILED, SEPARATOR).alias("failed_checks"),
        F.to_json(F.struct(*[f"`{c}`" for c in values])).alias("row_json"),
    )


def rejects_per_check(reject_rows: DataFrame) -> DataFrame:
    """Rows per source and failed check; a row that fails several counts for each."""
    return (
        reject_rows.select(
            "source", F.explode(F.split("failed_checks", SEPARATOR)).alias("failed_check")
        )
        .groupBy("source", "failed_check")
        .agg(F.count("*").alias("rejected_rows"))
    )
