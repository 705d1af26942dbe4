"""Helpers shared by the corpus operators."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loanlake.session import stage

ROWS_PER_BUCKET = 5_000
#: Rows of an Arrow batch that a function turns into Python objects at a time.
SLICE_ROWS = 256
#: Bytes that a row counts for beside its text where batches are balanced by bytes.
ROW_BYTES = 64
#: Bytes of an Arrow batch that an executor makes for a function.
ARROW_BYTES = 1 << 21
ARROW_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def by_place(df: DataFrame, prefix: str = "_col") -> DataFrame:
    """``df`` with its columns renamed by position, so that no name can clash."""
    return df.toDF(*[f"{prefix}{i}" for i in range(len(df.columns))])


def place(df: DataFrame, name: str, prefix: str = "_col") -> Column:
    """The column of ``by_place(df)`` that ``df`` calls ``name``, spelled exactly so."""
    return F.col(f"{prefix}{df.columns.index(name)}")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Columns by their exact names under new names, whatever else ``df`` holds."""
    return by_place(df).select(*[place(df, old).alias(new) for new, old in columns.items()])


def size_in_bytes(setting: str) -> int:
    """A size as Spark's settings spell it: ``4m``, ``67108864b`` or a plain number of bytes."""
    number, unit = re.fullmatch(r"(\d+)([bkmgtp]?)b?", setting.strip().lower()).groups()
    return int(number) << 10 * "bkmgtp".index(unit or "b")


def map_batches(
    df: DataFrame,
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: StructType | str,
) -> DataFrame:
    """``df.mapInArrow``, fed with batches of about ``ARROW_BYTES`` however long the rows are.

    Spark's own limits let a batch of texts grow to tens of megabytes, and every running
    task holds it in the JVM, beyond the heap, and again in its Python worker. Only a row
    that is longer makes a batch larger. Spark reads the limit when a job is planned, so
    it is lowered for the whole session, and stays; a lower one is kept.
    """
    conf = df.sparkSession.conf
    if size_in_bytes(conf.get(ARROW_LIMIT)) > ARROW_BYTES:
        conf.set(ARROW_LIMIT, ARROW_BYTES)
    return df.mapInArrow(function, schema)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches a few at a time, so that what is made of them stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def by_bytes(
    batches: Iterator[pa.RecordBatch], column: str, limit: int
) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches regrouped to batches of about ``limit`` bytes of ``column``.

    Only a row that is longer than that makes a batch larger, and only the last one
    is smaller. Every row counts for some bytes, however short it is.
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths.astype(np.int64) + ROW_BYTES)
        start, before = 0, 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(ends, before + limit - size)) + 1
            held.append(batch.slice(start, stop - start))
            if stop > batch.num_rows:
                size += int(ends[-1]) - before
                break
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size, start, before = [], 0, stop, int(ends[stop - 1])
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def rank_within(
    df: DataFrame, group: str, order: list[str], rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Add ``rank``: 0, 1, 2, ... without gaps inside each value of ``group``.

    A group is dealt to buckets by a hash of ``order``; rows are numbered inside
    a bucket and shifted by the sizes of the buckets before it. So a group that
    holds a third of all rows is spread over many tasks, and ``df`` is shuffled
    once. Ranks follow no order; they are the same on every run over the same
    rows. ``df`` is read three times: give a staged frame. ``group`` is not null.
    """
    buckets = max(1, math.ceil(df.count() / rows_per_bucket))
    salted = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    before = (
        Window.partitionBy(group)
        .orderBy("_bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        salted.groupBy(group, "_bucket")
        .agg(F.count("*").alias("_rows"))
        .select(group, "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy(group, "_bucket").orderBy(*order)
    numbered = salted.withColumn("_row", F.row_number().over(inside) - 1)
    return (
        numbered.join(starts, [group, "_bucket"])
        .withColumn("rank", F.col("_start") + F.col("_row"))
        .drop("_bucket", "_start", "_row")
    )


def positions(rows: DataFrame, group: str, order: str, name: str) -> DataFrame:
    """Add ``pos`` and ``of``: place of a row in its group, from 0 in ``order``, and the group's size.

    Rows are sorted by ranges of group and order together, so a group with a third of
    all rows lies in many tasks; a row's place is its offset in the sorted part and the
    rows of the group in the parts before. ``group`` is not null. The sorted rows are
    written when this is called, and read twice.
    """
    sorted_rows = rows.orderBy(group, order).withColumn("_place", F.monotonically_increasing_id())
    placed = stage(sorted_rows, name).withColumn("_part", F.shiftright("_place", 33))
    sizes = placed.groupBy("_part", group).agg(
        F.min("_place").alias("_first"), F.count("*").alias("_size")
    )
    earlier = Window.partitionBy(group).orderBy("_part")
    runs = sizes.select(
        "_part",
        group,
        "_first",
        (F.sum("_size").over(earlier) - F.col("_size")).alias("_before"),
        F.sum("_size").over(Window.partitionBy(group)).alias("of"),
    )
    pos = F.col("_before") + F.col("_place") - F.col("_first")
    return placed.join(runs, ["_part", group]).select(*rows.columns, pos.alias("pos"), "of")
