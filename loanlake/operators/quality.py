"""Data-quality checks that report instead of raising.

Row checks are conditions that mark a row as failed; all row checks of a table
are evaluated in one aggregate over it. Uniqueness and references need a shuffle
of their own, and send counts per key instead of rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlake.operators.joins import without_match

CRITICAL = "critical"
WARNING = "warning"


@dataclass(frozen=True)
class RowCheck:
    """``failed`` is true on a bad row; NULL and false both pass."""

    name: str
    column: str
    failed: Column
    severity: str = CRITICAL


def not_null(column: str, severity: str = CRITICAL) -> RowCheck:
    return RowCheck("not_null", column, F.col(column).isNull(), severity)


def accepted_values(
    column: str, values: Sequence[str], where: str | None = None, severity: str = CRITICAL
) -> RowCheck:
    failed = ~F.col(column).isin(*values)
    if where is not None:
        failed = F.expr(where) & failed
    return RowCheck("accepted_values", column, failed, severity)


def expression_is_true(
    column: str, expression: str, where: str | None = None, severity: str = CRITICAL
) -> RowCheck:
    failed = ~F.expr(expression)
    if where is not None:
        failed = F.expr(where) & failed
    return RowCheck("expression_is_true", column, failed, severity)


def between(column: str, low, high, severity: str = CRITICAL) -> RowCheck:
    return RowCheck("between", column, ~F.col(column).between(low, high), severity)


def not_flagged(column: str, severity: str = WARNING) -> RowCheck:
    return RowCheck("not_flagged", column, F.col(column), severity)


def _result(check: str, column: str, severity: str, failed: Column, total: Column) -> list:
    return [
        F.lit(check).alias("check_name"),
        F.lit(column).alias("column_name"),
        F.lit(severity).alias("severity"),
        failed.alias("failed_rows"),
        total.alias("total_rows"),
        (failed == 0).alias("passed"),
    ]


def run_row_checks(df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    """One result row per check, from a single pass over ``df``."""
    totals = df.agg(
        F.count("*").alias("_total"),
        *[F.count_if(c.failed).alias(f"_failed_{i}") for i, c in enumerate(checks)],
    )
    rows = [
        F.struct(
            *_result(c.name, c.column, c.severity, F.col(f"_failed_{i}"), F.col("_total"))
        )
        for i, c in enumerate(checks)
    ]
    return totals.select(F.inline(F.array(*rows)))


def unique(df: DataFrame, column: str, severity: str = CRITICAL) -> DataFrame:
    """Failed rows are the keys that occur more than once; total is all keys."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    found = counts.agg(F.count_if(F.col("_n") > 1).alias("_f"), F.count("*").alias("_t"))
    return found.select(*_result("unique", column, severity, F.col("_f"), F.col("_t")))


def references(
    df: DataFrame, column: str, target: DataFrame, target_column: str, severity: str = CRITICAL
) -> DataFrame:
    """Failed rows are those whose key the target lacks; total is the keys lacking."""
    orphans = without_match(df, target, column, target_column)
    found = orphans.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("_f"), F.count("*").alias("_t")
    )
    return found.select(*_result("references", column, severity, F.col("_f"), F.col("_t")))


@dataclass(frozen=True)
class Keys:
    """Keys of a table: those of one ``domain`` are compared with each other."""

    table: str
    column: str
    domain: str


@dataclass(frozen=True)
class Reference:
    """Every key of ``source`` has to be one of ``target``."""

    source: Keys
    target: Keys
    severity: str = CRITICAL


def key_suite(
    tables: Mapping[str, DataFrame], unique: Sequence[Keys], references: Sequence[Reference]
) -> DataFrame:
    """Uniqueness and references of many tables from one pass of key counts.

    All keys go through a single shuffle, counted per key before it, so a hot key
    is one row per task. Failed rows of a uniqueness check are the keys that occur
    more than once, those of a reference the rows whose key the target lacks.
    Missing keys are left out. Results carry the ``table_name``.
    """
    sides = list(dict.fromkeys([*unique, *[k for r in references for k in (r.source, r.target)]]))
    keys = reduce(
        DataFrame.unionByName,
        [
            tables[k.table].where(F.col(k.column).isNotNull()).select(
                F.lit(k.domain).alias("_domain"),
                F.col(k.column).cast("string").alias("_key"),
                F.lit(i).alias("_side"),
            )
            for i, k in enumerate(sides)
        ],
    )
    held = {k: F.col(f"_n{i}") for i, k in enumerate(sides)}
    counts = keys.groupBy("_domain", "_key").agg(
        *[F.count_if(F.col("_side") == i).alias(f"_n{i}") for i in range(len(sides))]
    )
    found = []
    for k in unique:
        found.append(("unique", k, CRITICAL, F.count_if(held[k] > 1), F.count_if(held[k] > 0)))
    for r in references:
        lacking = (held[r.source] > 0) & (held[r.target] == 0)
        rows = F.coalesce(F.sum(F.when(lacking, held[r.source])), F.lit(0))
        found.append(("references", r.source, r.severity, rows, F.count_if(lacking)))
    totals = counts.agg(
        *[f.alias(f"_f{i}") for i, (*_, f, _) in enumerate(found)],
        *[t.alias(f"_t{i}") for i, (*_, t) in enumerate(found)],
    )
    rows = [
        F.struct(
            *_result(name, k.column, severity, F.col(f"_f{i}"), F.col(f"_t{i}")),
            F.lit(k.table).alias("table_name"),
        )
        for i, (name, k, severity, _, _) in enumerate(found)
    ]
    return totals.select(F.inline(F.array(*rows)))


def all_results(*results: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


def failures(results: DataFrame, severity: str | None = CRITICAL) -> list[str]:
    """Names of failed checks; results hold one row per check, so this is small."""
    bad = results.where(~F.col("passed"))
    if severity is not None:
        bad = bad.where(F.col("severity") == severity)
    return [f"{r.check_name}({r.column_name}): {r.failed_rows}" for r in bad.collect()]
