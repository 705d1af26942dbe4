"""SimHash near-duplicates (5) against all pairs."""

import random

import numpy as np
import pytest
import xxhash

from loanlake.llm.components import components
from loanlake.llm.simhash import budget, block_starts, close_pairs, keep_one, op5_simhash


def direct_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    counts = [0] * 64
    for shingle in shingles:
        h = xxhash.xxh64_intdigest(shingle, 42)
        for bit in range(64):
            counts[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * counts[bit] > len(shingles))


def direct_components(fps, bits=4):
    root = {fp: fp for fp in fps}

    def find(fp):
        while root[fp] != fp:
            fp = root[fp]
        return fp

    known = sorted(root)
    for i, a in enumerate(known):
        for b in known[:i]:
            if (a ^ b).bit_count() <= bits:
                root[find(a)] = find(b)
    return {fp: find(fp) for fp in known}


def signed(fp):
    return fp - (1 << 64) if fp >= 1 << 63 else fp


def test_documents(spark, edge, docs):
    fps = [direct_fingerprint(text) for _, text in docs]
    root = direct_components(fps)
    least = {}
    for (i, _), fp in zip(docs, fps, strict=True):
        if i is not None:
            least[root[fp]] = min(i, least.get(root[fp], i))
    want = [(i, f"{fp:016x}", least.get(root[fp])) for (i, _), fp in zip(docs, fps, strict=True)]
    rows = [tuple(row) for row in op5_simhash(spark, edge).collect()]
    assert sorted(rows, key=repr) == sorted(want, key=repr)
    assert {c for i, _, c in rows if i in (103, 104, 105)} == {103}


def test_nothing(spark, empty):
    assert op5_simhash(spark, empty).count() == 0


@pytest.mark.parametrize("max_bits", [0, 1, 4])
def test_pairs_of_clustered_fingerprints(spark, max_bits):
    rng = random.Random(max_bits)
    fps = {0, (1 << 64) - 1}
    for _ in range(40):
        centre = rng.getrandbits(64)
        for _ in range(12):
            fp = centre
            for _ in range(rng.randint(0, 5)):
                fp ^= 1 << rng.randrange(64)
            fps.add(fp)
    dense = rng.getrandbits(64)
    fps |= {dense ^ (k << 3) for k in range(64)} | {dense ^ (1 << k) for k in range(64)}
    known = sorted(fps)
    frame = spark.createDataFrame([(signed(fp),) for fp in known], "fp long")
    found = {frozenset((r.u, r.v)) for r in close_pairs(frame, max_bits).collect()}
    want = {
        frozenset((signed(a), signed(b)))
        for i, a in enumerate(known)
        for b in known[:i]
        if (a ^ b).bit_count() <= max_bits
    }
    assert found == want


def test_budgets_hold_for_some_first_block():
    rng = random.Random(9)
    starts = block_starts(5)
    for _ in range(2000):
        bits = rng.sample(range(64), rng.randint(1, 4))
        assert any(
            all(
                sum((bit - start) % 64 < depth for bit in bits) <= budget(start, depth, 5, 4)
                for depth in (12, 19, 25, 38, 64)
            )
            for start in starts
        )


def test_components_of_long_chains(spark):
    rng = random.Random(2)
    names = list(range(300))
    rng.shuffle(names)
    links = [(names[i], names[i + 1]) for i in range(200)] + [(names[210], names[i]) for i in range(211, 300)]
    frame = spark.createDataFrame(links, "u long, v long")
    found = {r.node: r.root for r in components(frame).collect()}
    chain, star = names[:201], names[210:]
    assert found == {n: min(chain) for n in chain} | {n: min(star) for n in star}
    assert components(frame.where("u < 0")).count() == 0


def test_keep_one(spark):
    text = "the quick brown fox jumps over the lazy dog and runs away from it"
    rows = [(3, text, "a"), (2, text, "b"), (2, text, "b"), (None, text, "c"), (None, "other words", "d"),
            (9, None, "e"), (8, "", "f"), (7, "all alone here", "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((tuple(r) for r in kept.collect()), key=repr) == sorted(
        [(2, text, "b"), (None, "other words", "d"), (8, "", "f"), (7, "all alone here", "g")], key=repr
    )


def test_very_long_text_is_hashed_in_pieces(monkeypatch):
    from loanlake.llm import simhash

    rng = np.random.default_rng(1)
    text = " ".join(map(str, rng.integers(0, 50, 3000)))
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "CHUNK", 100)
    assert simhash.fingerprint(text.encode()) == whole == signed(direct_fingerprint(text))
