"""Repayment totals and the performance mart, kept up by a day's repayments."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlake.functions.finance import round_cents
from loanlake.plans.mart import performance_of
from loanlake.session import stage
from loanlake.sources.loads import dynamic_overwrite
from loanlake.sources.tables import full_name, properties, set_properties

BUCKET = "_bucket"
BUCKETS_PROPERTY = "loanlake.buckets"
#: Parts of a table that are rewritten as a whole; a table keeps the number it was made with.
BUCKETS = 256
#: Of the tables and of staged days, which are written anew with every load.
CODEC = "zstd"
#: Columns of the cleaned repayments that states are made of.
READ = ("application_id", "amount_paid_usd", "repayment_date", "is_delinquent", "payment_status")
_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def loan_states(repayments: DataFrame) -> DataFrame:
    """One row per loan with all that its totals need, in a form that can be merged.

    Amounts are added as decimals; those that fit none are counted, and then the sum
    of doubles stands in, as in ``finance.exact_sum``. Rows without a loan are left out.
    """
    exact = F.col("amount_paid_usd").try_cast("decimal(28,6)")
    unfit = exact.isNull() & F.col("amount_paid_usd").isNotNull()
    state = F.struct(
        F.count("*").alias("payments"),
        F.sum(exact).cast("decimal(38,6)").alias("paid"),
        F.count_if(unfit).alias("unfit"),
        F.sum(F.col("amount_paid_usd").cast("double")).alias("paid_double"),
        F.max("repayment_date").alias("last_payment"),
        F.count_if("is_delinquent").alias("delinquent"),
        F.max(F.when(F.col("payment_status") == "Defaulted", 1).otherwise(0)).alias("defaulted"),
    )
    known = repayments.where(F.col("application_id").isNotNull())
    return known.groupBy("application_id").agg(state.alias("added"))


def _merged(one: Column, other: Column) -> Column:
    """Two states of a loan as one; either may be NULL."""

    def added(field: str, kind: str) -> Column:
        a, b = one[field], other[field]
        return F.coalesce(a + b, a, b).cast(kind).alias(field)

    def larger(field: str) -> Column:
        return F.greatest(one[field], other[field]).alias(field)

    both = F.struct(
        added("payments", "long"),
        added("paid", "decimal(38,6)"),
        added("unfit", "long"),
        added("paid_double", "double"),
        larger("last_payment"),
        added("delinquent", "long"),
        larger("defaulted"),
    )
    return F.when(one.isNull(), other).when(other.isNull(), one).otherwise(both)


@contextmanager
def met_by_bucket(spark: SparkSession) -> Iterator[None]:
    """Sides of a join that are dealt out by bucket are joined as they lie.

    By its usual setting Spark would deal them out anew by bucket and loan, and the
    result would need another shuffle before it is written. The setting is put back.
    """
    kept = spark.conf.get(_ALL_KEYS)
    spark.conf.set(_ALL_KEYS, "false")
    try:
        yield
    finally:
        spark.conf.set(_ALL_KEYS, kept)


def _rewrite(
    df: DataFrame, table: str, buckets: int, location: str | None, name: str, *, dealt: bool = True
) -> None:
    """Replace the buckets that ``df`` has rows of; the others are not touched.

    ``df`` may read the table itself: new buckets take the place of old ones only when
    all of them are written. Unless its rows are ``dealt`` out by bucket already, they
    are shuffled for that.
    """
    spark = df.sparkSession
    rows = df if dealt else df.hint("rebalance", F.col(BUCKET))
    if spark.catalog.tableExists(table):
        columns = [f"`{c}`" for c in spark.table(table).columns]
        with dynamic_overwrite(spark), met_by_bucket(spark):
            rows.select(*columns).write.insertInto(table, overwrite=True)
        return
    writer = rows.write.format("parquet").option("compression", CODEC).partitionBy(BUCKET)
    if location:
        writer = writer.option("path", f"{location.rstrip('/')}/{name}")
    with met_by_bucket(spark):
        writer.saveAsTable(table)
    set_properties(spark, table, {BUCKETS_PROPERTY: buckets})


def _buckets_of(spark: SparkSession, table: str, asked: int) -> int:
    if not spark.catalog.tableExists(table):
        return asked
    return int(properties(spark, table)[BUCKETS_PROPERTY])


def apply_day(
    repayments: DataFrame,
    day: date,
    name: str,
    *,
    database: str | None = None,
    location: str | None = None,
    buckets: int = BUCKETS,
) -> list[int]:
    """Merge the cleaned repayments of a day into the state table; tells the buckets it rewrote.

    Every loan keeps its state and the one before its last day, so a day that is
    applied again, with the same or with corrected rows, replaces what it had added:
    also where an attempt stopped between two buckets. A loan that only the earlier
    attempt had goes back to the state before. Days come in order; one that lies
    before a day of the table raises. Only buckets with a loan of the day are read in
    full and rewritten, of the others the day is read. The bucket numbers that reach
    the driver are at most ``buckets``.
    """
    spark, table = repayments.sparkSession, full_name(name, database)
    buckets = _buckets_of(spark, table, buckets)
    delta = loan_states(repayments)
    delta = delta.withColumn(BUCKET, bucket_of(F.col("application_id"), buckets))
    today = F.lit(day)
    fresh = {"state": F.col("added"), "before": F.lit(None).cast(delta.schema["added"].dataType)}
    if not spark.catalog.tableExists(table):
        rows = delta.withColumns(fresh).withColumn("day", today)
        _rewrite(rows.select("application_id", "state", "before", "day", BUCKET),
                 table, buckets, location, name, dealt=False)
        return sorted(r[0] for r in spark.table(table).select(BUCKET).distinct().collect())
    delta = stage(delta, "day_states", compression=CODEC)
    touched = delta.select(BUCKET)
    held = spark.table(table)
    latest = held.agg(F.max("day")).first()[0]
    if latest is not None and latest > day:
        raise ValueError(f"{table} holds {latest}, which is after {day}")
    touched = touched.unionByName(held.where(F.col("day") == today).select(BUCKET))
    numbers = sorted(r[0] for r in touched.distinct().collect())
    # Both have one row per loan. Dealt out by bucket, they meet where they are written.
    old = held.where(F.col(BUCKET).isin(numbers)).repartition(BUCKET)
    joined = old.join(delta.repartition(BUCKET), [BUCKET, "application_id"], "full_outer")
    again = F.col("day") == today
    base = F.when(again, F.col("before")).otherwise(F.col("state"))
    moved = again | F.col("added").isNotNull()
    merged = joined.select(
        "application_id",
        F.when(moved, _merged(base, F.col("added"))).otherwise(F.col("state")).alias("state"),
        F.when(moved, base).otherwise(F.col("before")).alias("before"),
        F.when(moved, today).otherwise(F.col("day")).alias("day"),
        BUCKET,
    )
    _rewrite(merged, table, buckets, location, name)
    return numbers


def summary_of(states: DataFrame) -> DataFrame:
    """Rows of the state table as ``mart.summarise_repayments`` gives them."""
    state = F.col("state")
    exact = state["unfit"] == 0
    total = F.when(exact, state["paid"].cast("double")).otherwise(state["paid_double"])
    return states.where(state.isNotNull()).select(
        "application_id",
        state["payments"].alias("total_payments_made"),
        round_cents(total).alias("total_amount_paid_usd"),
        state["last_payment"].alias("last_payment_date"),
        state["delinquent"].alias("delinquent_payment_count"),
        state["defaulted"].alias("has_defaulted"),
    )


def refresh_mart(
    staged_loans: DataFrame,
    credit: DataFrame,
    states: str,
    name: str,
    touched: Sequence[int],
    *,
    credit_key: str = "application_id",
    database: str | None = None,
    location: str | None = None,
) -> None:
    """Rewrite the mart rows of the touched buckets from the state table.

    ``touched`` is what ``apply_day`` told. The first call makes the table and takes
    all loans. Loans and bureau rows that have changed need their buckets among the
    touched ones (``buckets_with``). The mart has the buckets of the state table, so a
    refresh reads and writes the same part of both; a call that is repeated gives the
    same rows.
    """
    spark = staged_loans.sparkSession
    table, source = full_name(name, database), full_name(states, database)
    buckets = _buckets_of(spark, source, BUCKETS)
    loans = staged_loans.withColumn(BUCKET, bucket_of(F.col("application_id"), buckets))
    held = spark.table(source)
    if spark.catalog.tableExists(table):
        if not touched:
            return
        chosen = F.col(BUCKET).isin(list(touched))
        loans, held = loans.where(chosen), held.where(chosen)
    summary = summary_of(held)
    summary = summary.withColumn(BUCKET, bucket_of(F.col("application_id"), buckets))
    rows = performance_of(loans, summary, credit, credit_key=credit_key, part=BUCKET)
    _rewrite(rows, table, buckets, location, name)


def buckets_with(keys: DataFrame, states: str, database: str | None = None) -> list[int]:
    """Buckets of the loans in ``keys``, at most as many as the state table has."""
    buckets = _buckets_of(keys.sparkSession, full_name(states, database), BUCKETS)
    found = keys.select(bucket_of(F.col("application_id"), buckets).alias(BUCKET)).distinct()
    return sorted(r[0] for r in found.collect())
