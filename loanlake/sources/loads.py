"""Loads that can be repeated, and loads of many tables as one unit."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlake.operators.quality import failures
from loanlake.sources.tables import (
    ROWS_PROPERTY,
    RUN_PROPERTY,
    LoadError,
    Written,
    counted,
    full_name,
    raise_all,
    set_properties,
)

log = logging.getLogger(__name__)

RUN_ID = "_run_id"
LOAD_DATE = "_load_date"
_DAY_ROWS = f"{ROWS_PROPERTY}.day."
_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


def stamp(df: DataFrame, run_id: str) -> DataFrame:
    """Rows with the run that wrote them."""
    return df.withColumn(RUN_ID, F.lit(run_id))


@contextmanager
def dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Overwriting replaces the partitions that are written, and only once they are.

    A partition named in the statement would be deleted before the job begins, and
    be lost if that fails. The setting is that of the session, as tables take no
    write option for it, and is put back.
    """
    kept = spark.conf.get(_OVERWRITE)
    spark.conf.set(_OVERWRITE, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(_OVERWRITE, kept)


def load_day(
    df: DataFrame,
    name: str,
    day: date,
    run_id: str,
    *,
    database: str | None = None,
    location: str | None = None,
) -> Written:
    """Load the rows of one day; loading the day again replaces them.

    The table is partitioned by ``_load_date`` and every row carries its
    ``_run_id``. Only the partition of the day is overwritten, so a run that is
    repeated, whether it had failed or not, leaves one copy, and other days stay as
    they are. The new partition takes the place of the old one when all its rows are
    written; a load that fails leaves the day as it was. A day without rows ends up
    empty. Columns must be those of the table, in any order. Rows are counted while they are written; the table keeps the
    count of each day as a property, which gives the total.
    """
    spark, table = df.sparkSession, full_name(name, database)
    watched, found = counted(stamp(df, run_id))
    if spark.catalog.tableExists(table):
        columns = [c for c in spark.table(table).columns if c != LOAD_DATE]
        if sorted(columns) != sorted(watched.columns):
            differing = sorted(set(columns) ^ set(watched.columns))
            raise LoadError(f"columns of {table} differ: {', '.join(differing)}")
        day_of = F.lit(day).alias(LOAD_DATE)
        with dynamic_overwrite(spark):
            watched.select(*[f"`{c}`" for c in columns], day_of).write.insertInto(table, overwrite=True)
        if not found.get["rows"]:
            types = {field.name: field.dataType.simpleString() for field in watched.schema}
            nothing = ", ".join(f"CAST(NULL AS {types[c]})" for c in columns)
            spark.sql(
                f"INSERT OVERWRITE TABLE {table} PARTITION ({LOAD_DATE} = DATE'{day}')"
                f" SELECT {nothing} WHERE false"
            )
    else:
        writer = watched.withColumn(LOAD_DATE, F.lit(day)).write.partitionBy(LOAD_DATE)
        if location:
            writer = writer.option("path", f"{location.rstrip('/')}/{name}")
        writer.format("parquet").saveAsTable(table)
    rows = found.get["rows"]
    set_properties(spark, table, {f"{_DAY_ROWS}{day}": rows, RUN_PROPERTY: run_id})
    told = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    return Written(rows, sum(int(r["value"]) for r in told if r["key"].startswith(_DAY_ROWS)))


def load_days(
    tables: Mapping[str, DataFrame], day: date, run_id: str, **options
) -> dict[str, Written]:
    """``load_day`` for every table, going on past failures; one error for all at the end.

    A run that failed on some tables is repeated whole: those it had loaded are replaced.
    """
    written, errors = {}, []
    for name, df in tables.items():
        try:
            written[name] = load_day(df, name, day, run_id, **options)
        except Exception as exc:  # any failing write must not stop the others
            log.error("could not load %s of %s: %s", name, day, exc)
            errors.append(f"{name}: {exc}")
    raise_all(errors)
    return written


def path_of(location: str, run_id: str, name: str) -> str:
    return f"{location.rstrip('/')}/{run_id}/{name}"


def switch_views(
    spark: SparkSession, names: list[str], location: str, run_id: str, database: str | None = None
) -> None:
    """Let a view per table show what ``run_id`` wrote; with an older run this is the way back."""
    for name in names:
        path = path_of(location, run_id, name)
        spark.sql(
            f"CREATE OR REPLACE VIEW {full_name(name, database)}"
            f" TBLPROPERTIES ('{RUN_PROPERTY}' = '{run_id}') AS SELECT * FROM parquet.`{path}`"
        )


def publish(
    tables: Mapping[str, DataFrame],
    *,
    run_id: str,
    location: str,
    database: str | None = None,
    checks: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None,
) -> dict[str, Written]:
    """Write and check all tables, then show all of them at once, or none.

    Each table goes to a folder of the run, where no reader looks; failures do not
    stop the others. ``checks`` gives suites by table name, which read what was
    written. Only if every write has succeeded and no critical check has failed do
    the views of the tables switch to the run; otherwise one error tells everything
    that failed and readers go on seeing the run before. Views are switched one by
    one after all work is done: if that is interrupted, ``switch_views`` finishes it.
    A name that is a table and not a view fails before anything is written.
    """
    spark = next(iter(tables.values())).sparkSession
    taken = [
        name
        for name in tables
        if spark.catalog.tableExists(full_name(name, database))
        and spark.catalog.getTable(full_name(name, database)).tableType != "VIEW"
    ]
    raise_all([f"{name}: is a table and cannot be switched" for name in taken])
    written: dict[str, Written] = {}
    errors: list[str] = []
    for name, df in tables.items():
        try:
            watched, found = counted(df)
            watched.write.mode("overwrite").parquet(path_of(location, run_id, name))
            rows = found.get["rows"]
            written[name] = Written(rows, rows)
            suite = (checks or {}).get(name)
            if suite is not None:
                done = spark.read.schema(df.schema).parquet(path_of(location, run_id, name))
                errors += [f"{name}: check failed: {one}" for one in failures(suite(done))]
        except Exception as exc:  # any failing write must not stop the others
            log.error("could not write %s: %s", name, exc)
            errors.append(f"{name}: {exc}")
    raise_all(errors)
    switch_views(spark, list(tables), location, run_id, database)
    return written
