"""Range shards of nearly equal size from sampled splitters (operator 2)."""

from __future__ import annotations

from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlake.llm.common import pick, rank_within, table
from loanlake.session import stage

SHARDS = 8
#: Ranges that a shard is put together from, and keys sampled for each range.
RANGES_PER_SHARD = 128
SAMPLES_PER_RANGE = 16
#: A range over so many times the mean size is divided again.
OVERFULL = 2.0
#: A cut may move by this share of a shard to leave a run of equal keys whole.
SLACK = 0.01
LAW = "bytes"
_SMALLEST = np.iinfo(np.int64).min


def uniform(seed: int, *columns: str):
    """A number from 0 up to 1 that depends on the row's columns only."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 52)) / F.lit(float(1 << 52))


def sample_keys(records: DataFrame, rate: float, seed: int) -> np.ndarray:
    """Sorted (``range_key``, ``tie``) of records drawn with chance ``rate`` times size.

    A record whose size alone makes up a sample is always drawn.
    """
    drawn = records.where(uniform(seed, "range_key", "tie") < F.col("size") * F.lit(rate))
    found = drawn.select("range_key", "tie").toPandas()
    keys = found.drop_duplicates().sort_values(["range_key", "tie"])
    return keys.to_numpy(dtype=np.int64).reshape(-1, 2)


def align_to_runs(splitters: np.ndarray) -> np.ndarray:
    """Move the first splitter of each key to the beginning of the key's run.

    So a run of equal keys is divided only where it holds two splitters or more.
    """
    splitters = splitters.copy()
    if len(splitters):
        begins = np.r_[True, splitters[1:, 0] != splitters[:-1, 0]]
        splitters[begins, 1] = _SMALLEST
    return splitters


def range_of(splitters: np.ndarray):
    """A column function: the number of splitters that are not above (``range_key``, ``tie``)."""
    keys, ties = splitters[:, 0].copy(), splitters[:, 1].copy()

    @F.pandas_udf("long")
    def numbered(key: pd.Series, tie: pd.Series) -> pd.Series:
        key, tie = key.to_numpy(), tie.to_numpy()
        low = np.searchsorted(keys, key, side="left")
        high = np.searchsorted(keys, key, side="right")
        for run in np.unique(low[low < high]):
            here = (low == run) & (low < high)
            end = high[here][0]
            low[here] = run + np.searchsorted(ties[run:end], tie[here], side="right")
        return pd.Series(low)

    return numbered("range_key", "tie")


def range_sizes(records: DataFrame, splitters: np.ndarray) -> np.ndarray:
    """Exact size of each of the ``len(splitters) + 1`` ranges."""
    summed = records.groupBy(range_of(splitters).alias("range")).agg(F.sum("size").alias("size"))
    sizes = np.zeros(len(splitters) + 1, dtype=np.int64)
    for row in summed.collect():
        sizes[row["range"]] = row["size"]
    return sizes


def choose_splitters(records: DataFrame, shards: int, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Splitters of about ``shards * RANGES_PER_SHARD`` ranges and the ranges' exact sizes.

    Boundaries are quantiles of a sample weighted by size. Their ranges are then
    measured exactly, and the keys of overfull ranges are sampled again, more
    densely, until none is overfull or its records cannot be told apart by key.
    The driver holds samples and sizes, whose expected number depends on the
    number of shards alone.
    """
    ranges = shards * RANGES_PER_SHARD
    rate = ranges * SAMPLES_PER_RANGE / total
    keys = sample_keys(records, rate, 0)
    chosen = keys[np.unique((np.arange(1, ranges) * len(keys)) // ranges)] if len(keys) else keys
    splitters = align_to_runs(np.unique(chosen, axis=0))
    for seed in count(1):
        sizes = range_sizes(records, splitters)
        overfull = np.flatnonzero(sizes > OVERFULL * total / ranges)
        if not len(overfull):
            break
        inside = records.where(range_of(splitters).isin([int(i) for i in overfull]))
        more = sample_keys(inside, rate, seed)
        known = np.unique(np.concatenate([splitters, align_to_runs(more), more]), axis=0)
        if len(known) == len(splitters):
            break
        splitters = known
    return splitters, range_sizes(records, splitters)


def shard_cuts(splitters: np.ndarray, sizes: np.ndarray, shards: int) -> np.ndarray:
    """Shard of every range: consecutive ranges, cut nearest to equal sizes.

    A cut at the beginning of a run of equal keys is preferred to one inside it
    while the cut moves by no more than ``SLACK`` of a shard.
    """
    ends = np.cumsum(sizes)
    target = ends[-1] / shards
    whole = np.r_[splitters[:, 1] == _SMALLEST, True] if len(splitters) else np.array([True])
    cuts = []
    for number in range(1, shards):
        away = np.abs(ends - number * target)
        near = np.flatnonzero(whole & (away <= SLACK * target))
        best = near[np.argmin(away[near])] if len(near) else int(np.argmin(away))
        cuts.append(best)
    return np.searchsorted(np.maximum.accumulate(cuts), np.arange(len(sizes)), side="left")


def shard_records(records: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Add ``shard`` to ``records`` of ``size`` at least 1, by ``range_key`` and ``tie`` (both long).

    Shards are consecutive key ranges of nearly equal size. Records with equal
    ``range_key`` stay together unless they are too many for that: then their run
    is cut by ``tie``. Records that agree in both are kept in one range. Give a
    staged frame: it is read a few times.
    """
    total = records.agg(F.sum("size")).first()[0]
    if not total:
        return records.withColumn("shard", F.lit(0))
    splitters, sizes = choose_splitters(records, shards, total)
    shard = shard_cuts(splitters, sizes, shards)
    largest = np.iinfo(np.int64).max
    bounds = np.concatenate([[[_SMALLEST, _SMALLEST]], splitters, [[largest, largest]]])
    lowest = bounds[np.searchsorted(shard, np.arange(1, shards), side="left")]
    return records.withColumn("shard", range_of(lowest).cast("int"))


def shard_documents(
    docs: DataFrame, shards: int = SHARDS, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard`` per row.

    The key of a document is a hash of its text, its tie breaker a hash of its
    id, so equal texts share a shard unless their group is too large. The law is
    ``bytes``: sizes (UTF-8 bytes plus 1) are nearly equal. ``slot`` counts the
    rows of a shard without gaps and in no order.

    A null or empty text has size 1 and checksum 0; a null id is a tie breaker
    like any other; equal rows share a shard; an empty table gives no rows; other
    columns are not read. The keys and sizes are written when this is called.
    """
    rows = pick(docs, doc_id=id, text=text)
    told = F.coalesce("text", F.lit(""))
    records = stage(
        rows.select(
            "doc_id",
            (F.octet_length(told) + 1).cast("long").alias("size"),
            F.crc32(told.cast("binary")).alias("text_crc32"),
            F.xxhash64(told).alias("range_key"),
            F.xxhash64("doc_id").alias("tie"),
        ),
        "shard-records",
    )
    placed = stage(shard_records(records, shards), "shard-places")
    ranked = rank_within(placed, "shard", ["tie", "range_key"])
    return ranked.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        F.col("rank").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard_documents(table(spark, folder, "documents"))
