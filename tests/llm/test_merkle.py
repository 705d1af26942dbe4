import hashlib
import random

import pytest
from pyspark.sql import functions as F

from loanlake.llm import merkle
from loanlake.llm.merkle import manifest, op12_merkle, oracle
from tests.llm.conftest import sorted_rows


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def reduced(nodes):
    """Root of a list of digests and, for each, the siblings of every level with its slot."""
    paths = [[] for _ in nodes]
    under = [[at] for at in range(len(nodes))]
    while len(nodes) > 1:
        above, held = [], []
        for start in range(0, len(nodes), 8):
            run = nodes[start : start + 8]
            for slot in range(len(run)):
                for leaf in under[start + slot]:
                    paths[leaf].append((slot, run[:slot] + run[slot + 1 :]))
            above.append(digest("".join(run)))
            held.append([leaf for one in under[start : start + 8] for leaf in one])
        nodes, under = above, held
    return nodes[0], paths


def expected(rows):
    parts = {}
    for id, part, leaf in rows:
        parts.setdefault(part, []).append((id is not None, id or 0, leaf))
    names = sorted(parts, key=lambda part: (part is not None, (part or "").encode()))
    trees = [reduced([leaf for *_, leaf in sorted(parts[name])]) for name in names]
    root, upper = reduced([subroot for subroot, _ in trees])
    found = []
    for name, (subroot, paths), above in zip(names, trees, upper, strict=True):
        for (has, id, leaf), path in zip(sorted(parts[name]), paths, strict=True):
            steps = path + above
            found.append(
                (id if has else None, name, leaf, subroot, root, tuple((s, "".join(o)) for s, o in steps))
            )
    return found


@pytest.mark.parametrize("bucket", [8, 8**4])
def test_against_plain_trees(spark, monkeypatch, bucket):
    monkeypatch.setattr(merkle, "BUCKET", bucket)
    rng = random.Random(bucket)
    sizes = {"xx": 585, "en": 64, "de": 9, "fr": 8, "es": 1, None: 66} | {f"l{i}": 2 for i in range(9)}
    rows = [
        (rng.randrange(1000) if rng.random() > 0.02 else None, part, digest(str(rng.random())))
        for part, size in sizes.items()
        for _ in range(size)
    ]
    rows += [rows[0], rows[0]]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "id long, part string, digest string").repartition(5)
    found = [
        (*row[:5], tuple(tuple(step) for step in row["path"]))
        for row in manifest(frame).select("id", "part", "digest", "subroot", "root", "path").collect()
    ]
    assert sorted_rows(found) == sorted_rows(expected(rows))


def test_query_equals_its_sql(spark, edge, sql):
    found = op12_merkle(spark, edge)
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert found.columns == names
    assert sorted_rows(found.collect()) == sorted_rows(sql(oracle(4)).fetchall())


def test_only_changed_texts_fail(spark, edge):
    docs = spark.read.parquet(f"{edge}/documents.parquet")
    changed = docs.select(
        "doc_id",
        (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0)
        & F.col("text").rlike("[A-Z]"),
    ).collect()
    expected = sorted_rows((id, not (hit or False)) for id, hit in changed)
    found = op12_merkle(spark, edge).select("doc_id", "verified").collect()
    assert sorted_rows(found) == expected
    assert {row["verified"] for row in found} == {True, False}


def test_a_single_row_is_its_own_root(spark):
    row = manifest(spark.createDataFrame([(1, None, "a" * 64)], "id long, part string, digest string")).first()
    assert (row["subroot"], row["root"], row["path"]) == ("a" * 64, "a" * 64, [])


def test_empty_table(spark, empty):
    assert op12_merkle(spark, empty).collect() == []
