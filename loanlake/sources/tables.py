"""Table sources and sinks, and the CSV landing zone."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

# Write dispositions and the writer modes they stand for.
WRITE_MODES = {"WRITE_TRUNCATE": "overwrite", "WRITE_APPEND": "append"}
#: Properties of a written table: rows it holds and the run that wrote it last.
ROWS_PROPERTY = "loanlake.rows"
RUN_PROPERTY = "loanlake.run_id"


class LoadError(Exception):
    """One or more tables could not be written."""


def read_table(spark: SparkSession, name: str, database: str | None = None) -> DataFrame:
    return spark.table(f"{database}.{name}" if database else name)


def register_views(tables: Mapping[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def plain_number(number: Column) -> Column:
    """A floating number as text without an exponent, where 38 digits can hold it."""
    text = number.cast("string")
    plain = number.try_cast("decimal(38,12)").cast("string")
    plain = F.regexp_replace(plain, r"(\.\d+?)0+$", "$1")
    return F.when(text.contains("E"), F.coalesce(plain, text)).otherwise(text)


def as_csv_text(df: DataFrame) -> DataFrame:
    """Dates without a time of day as plain dates, booleans as True and False, plain numbers."""

    def text(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType)):
            day = c.cast("date")
            c = F.when(c == day.cast(field.dataType), day.cast("string")).otherwise(
                c.cast("string")
            )
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = plain_number(c)
        elif isinstance(field.dataType, T.BooleanType):
            c = F.when(c, "True").when(~c, "False")
        return c.alias(field.name)

    return df.select(*[text(f) for f in df.schema])


def write_csv(df: DataFrame, path: str) -> str:
    """Folder of CSV part files with headers; one file per task, nothing coalesced.

    Values are written as they are, outer spaces included. One with a line break
    is quoted, so read the files with ``multi_line=True``; they are already cut
    into one piece for each task.
    """
    as_csv_text(df).write.mode("overwrite").csv(
        path,
        header=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return path


def land_csv(tables: Mapping[str, DataFrame], folder: str) -> dict[str, str]:
    root = folder.rstrip("/")
    return {name: write_csv(df, f"{root}/{name}.csv") for name, df in tables.items()}


@dataclass(frozen=True)
class Written:
    """Rows that a load wrote and that the table then holds."""

    rows: int
    total: int


def full_name(name: str, database: str | None) -> str:
    return f"{database}.{name}" if database else name


def properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def set_properties(spark: SparkSession, table: str, values: Mapping[str, object]) -> None:
    told = ", ".join(f"'{key}' = '{value}'" for key, value in values.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({told})")


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` and its number of ``rows``, known once the plan that writes it has run."""
    found = Observation(f"rows-{uuid.uuid4().hex}")
    return df.observe(found, F.count("*").alias("rows")), found


def write_counted(
    df: DataFrame,
    name: str,
    *,
    database: str | None = None,
    mode: str = "WRITE_TRUNCATE",
    location: str | None = None,
    enabled: bool = True,
    run_id: str | None = None,
) -> Written:
    """Write a table and tell the rows written and held, without reading it again.

    Rows are counted while they are written. The table keeps its total as a
    property, from which the next append goes on; a table without it is counted
    once. ``run_id`` becomes a property as well, so a table tells its last run.
    """
    if not enabled:
        return Written(0, 0)
    spark, table = df.sparkSession, full_name(name, database)
    mode = WRITE_MODES.get(mode, mode)
    before = 0
    if mode == "append" and spark.catalog.tableExists(table):
        known = properties(spark, table).get(ROWS_PROPERTY)
        before = int(known) if known is not None else spark.table(table).count()
    watched, found = counted(df)
    writer = watched.write.mode(mode).format("parquet")
    if location:
        writer = writer.option("path", f"{location.rstrip('/')}/{name}")
    writer.saveAsTable(table)
    rows = found.get["rows"]
    told = {ROWS_PROPERTY: before + rows}
    set_properties(spark, table, told | ({RUN_PROPERTY: run_id} if run_id else {}))
    return Written(rows, before + rows)


def write_table(df: DataFrame, name: str, **options) -> int:
    """Write a table and return the rows it then holds, older ones included."""
    return write_counted(df, name, **options).total


def load_counted(
    tables: Mapping[str, DataFrame], *, on_error: str = "raise", **options
) -> dict[str, Written]:
    """Write every table, going on past failures; then raise one error for all.

    ``on_error="continue"`` only logs them.
    """
    written: dict[str, Written] = {}
    errors: list[str] = []
    for name, df in tables.items():
        try:
            written[name] = write_counted(df, name, **options)
            log.info("loaded %s: %d rows, %d in all", name, written[name].rows, written[name].total)
        except Exception as exc:  # any failing write must not stop the others
            log.error("could not load %s: %s", name, exc)
            errors.append(f"{name}: {exc}")
    raise_all(errors, on_error)
    return written


def raise_all(errors: list[str], on_error: str = "raise") -> None:
    if errors and on_error == "raise":
        raise LoadError(f"{len(errors)} table(s) failed to load:\n" + "\n".join(errors))


def load_all(tables: Mapping[str, DataFrame], **options) -> dict[str, int]:
    """``load_counted`` with the rows that each table then holds."""
    return {name: one.total for name, one in load_counted(tables, **options).items()}


def row_counts(tables: Mapping[str, DataFrame]) -> dict[str, int]:
    return {name: df.count() for name, df in tables.items()}


def count_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts as one frame, for use inside a plan."""
    counted: Iterable[DataFrame] = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    result = None
    for one in counted:
        result = one if result is None else result.unionByName(one)
    return result
