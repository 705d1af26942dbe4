"""Connected components of a graph that no machine holds whole."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlake.session import stage


def _least(pairs: DataFrame) -> DataFrame:
    """``n`` and ``least``, the smallest ``m`` among its pairs."""
    return pairs.groupBy("n").agg(F.min("m").alias("least"))


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for all linked nodes.

    ``links`` has two columns of one ordered type. Large-star and small-star
    steps alternate until nothing changes: each hangs the neighbours of a node on
    the smallest of them, so the number of rounds grows with the logarithm of the
    longest path and the number of links never grows. Minima are taken before the
    shuffle and staged, so that the join of a hub with its many neighbours is one
    that Spark splits.
    Links are written to the shared folder every round; only their number and a
    checksum reach the driver.
    """
    first, second = links.columns
    edges = links.select(
        F.greatest(first, second).alias("n"), F.least(first, second).alias("m")
    ).where("n > m")
    name = f"components-{uuid.uuid4().hex}"
    edges = stage(edges.distinct(), name)
    before = None
    while True:
        state = edges.agg(
            F.count("*"), F.sum(F.xxhash64("n", "m").cast("decimal(38,0)"))
        ).first()
        if state == before or state[0] == 0:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("m").alias("n"), F.col("n").alias("m")))
        large = (
            both.join(stage(_least(both), name), "n")
            .where("m > n")
            .select(F.col("m").alias("n"), F.least("n", "least").alias("m"))
        )
        large = stage(large.distinct(), name)
        least = stage(_least(large), name)
        small = (
            large.join(least, "n")
            .where("m > least")
            .select(F.col("m").alias("n"), F.col("least").alias("m"))
        )
        small = small.unionByName(least.select("n", F.col("least").alias("m")))
        edges = stage(small.distinct(), name)
    roots = edges.select(F.col("m").alias("node"), F.col("m").alias("root")).distinct()
    return edges.select(F.col("n").alias("node"), F.col("m").alias("root")).unionByName(roots)
