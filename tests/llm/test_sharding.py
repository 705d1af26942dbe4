"""Shards (2): the law, gapless slots, groups of equal texts and hot keys."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np

from loanlake.llm.sharding import (
    SHARDS,
    align_to_runs,
    choose_splitters,
    op2_sharding,
    shard_cuts,
    shard_documents,
    shard_records,
)


def check(rows, docs, largest=None):
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    assert {r.law for r in rows} <= {"bytes"} and {r.grown_shard for r in rows} <= {None}
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert set(slots) <= set(range(SHARDS))
    assert all(sorted(found) == list(range(len(found))) for found in slots.values())


def spread(rows):
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += r.size
    return sizes


def test_edge_documents(spark, edge, docs):
    check(op2_sharding(spark, edge).collect(), docs)


def test_nothing(spark, empty):
    assert op2_sharding(spark, empty).count() == 0


def test_sizes_are_nearly_equal_and_groups_whole(spark):
    rng = random.Random(1)
    texts = ["w" * rng.randint(1, 400) + str(i) for i in range(6000)]
    docs = [(i, texts[i % 5000]) for i in range(6000)]
    rows = shard_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    check(rows, docs)
    sizes = spread(rows)
    assert max(sizes.values()) < 1.02 * sum(sizes.values()) / SHARDS
    assert min(sizes.values()) > 0.98 * sum(sizes.values()) / SHARDS
    groups = defaultdict(set)
    for r in rows:
        groups[r.text_crc32, r.size].add(r.shard)
    assert max(map(len, groups.values())) == 1


def test_a_hot_text_is_divided(spark):
    docs = [(i, "the same text" if i % 3 else f"text number {i}") for i in range(6000)]
    rows = shard_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    check(rows, docs)
    sizes = spread(rows)
    assert len(sizes) == SHARDS
    assert max(sizes.values()) < 1.02 * sum(sizes.values()) / SHARDS


def test_overfull_ranges_are_divided_again(spark, monkeypatch):
    from loanlake.llm import sharding

    monkeypatch.setattr(sharding, "RANGES_PER_SHARD", 16)
    monkeypatch.setattr(sharding, "SAMPLES_PER_RANGE", 2)
    records = spark.range(20_000).selectExpr("id as range_key", "id as tie", "1 + id % 7 as size").cache()
    total = records.agg({"size": "sum"}).first()[0]
    _, sizes = choose_splitters(records, 4, total)
    assert sizes.sum() == total
    assert sizes.max() <= 2 * total / 64 + 7
    shards = shard_records(records, 4).groupBy("shard").agg({"size": "sum"}).collect()
    assert max(r[1] for r in shards) < 1.1 * total / 4


def test_equal_records_cannot_be_told_apart(spark):
    records = spark.range(1000).selectExpr("7L as range_key", "7L as tie", "1L as size")
    assert shard_records(records, 4).select("shard").distinct().count() == 1


def test_cuts():
    splitters = align_to_runs(np.array([[1, 5], [2, 1], [2, 6], [9, 3]]))
    lowest = np.iinfo(np.int64).min
    assert splitters.tolist() == [[1, lowest], [2, lowest], [2, 6], [9, lowest]]
    assert shard_cuts(splitters, np.array([10, 10, 10, 10, 10]), 5).tolist() == [0, 1, 2, 3, 4]
