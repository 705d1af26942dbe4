"""Joins that keep their sides' columns apart.

Hot keys are left to Spark: adaptive execution measures the shuffled partitions
of a join and splits those that one key has filled, at any size of the data. It can
do so where the side with the hot key stands straight behind a shuffle. Sides that
can be counted or summed per key are, before they meet, and hold one row per key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _match(on: Sequence[str], null_safe: bool) -> Column:
    def same(key: str) -> Column:
        left, right = F.col(f"left.{key}"), F.col(f"right.{key}")
        return left.eqNullSafe(right) if null_safe else left == right

    return reduce(and_, [same(k) for k in on])


def keyed_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str] | str,
    how: str = "left",
    *,
    null_safe: bool = False,
) -> DataFrame:
    """Equi-join (left or inner) on columns that both sides call the same.

    The result has the left columns and then the right ones that are not keys.
    ``null_safe`` lets NULL match NULL.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type: {how}")
    on = [on] if isinstance(on, str) else list(on)
    for k in on:
        if left.schema[k].dataType != right.schema[k].dataType:
            raise TypeError(f"join key {k} has different types on the two sides")
    output = [F.col(f"left.`{c}`") for c in left.columns] + [
        F.col(f"right.`{c}`") for c in right.columns if c not in on
    ]
    joined = left.alias("left").join(right.alias("right"), _match(on, null_safe), how)
    return joined.select(*output)


def without_match(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Distinct left keys that the right side lacks, with their row counts.

    The left rows are counted per key first, so a hot key is one row in the join.
    """
    counted = (
        left.where(F.col(left_key).isNotNull())
        .groupBy(left_key)
        .agg(F.count("*").alias("row_count"))
    )
    known = right.select(F.col(right_key).alias("_known")).distinct()
    return counted.join(known, F.col(left_key) == F.col("_known"), "left_anti")
