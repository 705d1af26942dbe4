import math
import random

import numpy as np
import pytest

from loanlake.llm import ranked_search
from loanlake.llm.ranked_search import (
    ORACLE,
    Documents,
    Items,
    Search,
    op11_ranked_search,
    search,
    terms_of,
)
from tests.llm.conftest import sorted_rows


def direct(docs, items, best=10):
    """Scores of all pairs in plain numbers."""
    read = [(id, terms_of(text)) for id, text in docs]
    read = [(id, terms) for id, terms in read if terms]
    total = sum(len(terms) for _, terms in read)
    rows = []
    for item, text in sorted({(item, text) for item, text in items if text}, key=repr):
        wanted = sorted(set(terms_of(text)))
        holders = {term: sum(term in terms for _, terms in read) for term in wanted}
        scored = []
        for id, terms in read:
            m = 100 - 90 + (90 * len(terms) * len(read)) // total
            score = 0
            for term in wanted:
                tf = terms.count(term)
                weight = math.floor(1000 * math.log((2 * len(read) + 2) / (2 * holders[term] + 1)))
                score += weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, id is not None, id or 0))
        for rank, (score, has, id) in enumerate(sorted(scored)[:best], 1):
            rows.append((item, rank, id if has else None, -score))
    return rows


def test_terms():
    assert terms_of("Ab-ÀÉ c3_d é İ\x7f") == ["ab", "ÀÉ", "c3", "d é", "İ"]
    assert terms_of(None) == terms_of("- .") == []


def test_query_equals_sql_and_direct_search(spark, edge, sql, docs):
    found = op11_ranked_search(spark, edge)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    rows = sorted_rows(found.collect())
    assert rows == sorted_rows(sql(ORACLE).fetchall())
    items = sql("select item_id, text from benchmark").fetchall()
    assert rows == sorted_rows(direct(docs, items))


@pytest.mark.parametrize("bytes_of_block", [1, 300])
def test_blocks_of_items_change_nothing(spark, monkeypatch, bytes_of_block):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    docs = [(i % 70, " ".join(rng.choices(words, k=rng.randint(0, 30)))) for i in range(150)]
    items = [(i % 4, " ".join(rng.choices(words, k=5))) for i in range(6)]
    frames = (
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    whole = sorted_rows(search(*frames, best=3).collect())
    assert whole == sorted_rows(direct(docs, items, 3))
    monkeypatch.setattr(ranked_search, "BLOCK_BYTES", bytes_of_block)
    assert sorted_rows(search(*frames, best=3).collect()) == whole


def vectors(rng, count, n_terms, size, top):
    sizes = rng.integers(1, size, count)
    terms = np.concatenate([np.sort(rng.choice(n_terms, one, replace=False)) for one in sizes])
    return np.r_[0, np.cumsum(sizes)], terms, rng.integers(1, top, sizes.sum())


@pytest.mark.parametrize("seed", range(6))
def test_pruning_is_exact_and_leaves_most_out(monkeypatch, seed):
    rng = np.random.default_rng(seed)
    n_terms = 400
    rarity = rng.integers(1, 9_000, n_terms)
    starts, terms, values = vectors(rng, 37, n_terms, 6, 2)
    items = [(terms[a:b], rarity[terms[a:b]]) for a, b in zip(starts, starts[1:], strict=False)]
    state = Search(Items(items, n_terms), np.zeros(len(items), np.int64), 5)
    scored = 0
    score = Search.score

    def counted(self, item, docs, leaves, dense):
        nonlocal scored
        scored += len(leaves)
        score(self, item, docs, leaves, dense)

    monkeypatch.setattr(Search, "score", counted)
    wanted = [[] for _ in items]
    leaves = 0
    for tree in range(3):
        starts, terms, values = vectors(rng, 700, n_terms, 9, 50 if seed else 2)
        ids = [int(one) if one else None for one in rng.permutation(700) + 700 * tree]
        docs = Documents(ids, starts, terms, values, rarity)
        leaves += len(docs.leaves) * len(items)
        state.visit(docs)
        for number, (own, weights) in enumerate(items):
            dense = np.zeros(n_terms, np.int64)
            dense[own] = weights
            for id, a, b in zip(ids, starts, starts[1:], strict=False):
                if total := int((dense[terms[a:b]] * values[a:b]).sum()):
                    wanted[number].append((-total, id is not None, id))
    for number, found in zip(state.items.order, state.found, strict=True):
        assert found == sorted(wanted[number], key=lambda row: (*row[:2], row[2] or 0))[:5]
    if seed:
        assert scored < leaves / 2


def test_bounds_hold():
    rng = np.random.default_rng(1)
    starts, terms, values = vectors(rng, 300, 50, 12, 99)
    docs = Documents(list(range(300)), starts, terms, values, np.arange(50))
    for _ in range(20):
        dense = rng.integers(0, 9, 50)
        scores = docs.level.products(np.arange(300), dense)
        leaves = docs.leaves.products(np.arange(len(docs.leaves)), dense)
        nodes = docs.nodes.products(np.arange(len(docs.nodes)), dense)
        assert (np.repeat(leaves, 32)[:300] >= scores).all()
        assert (np.repeat(nodes, 16)[: len(leaves)] >= leaves).all()


def test_empty_tables(spark, empty, edge):
    assert op11_ranked_search(spark, empty).collect() == []
    docs = spark.read.parquet(f"{edge}/documents.parquet")
    nothing = spark.createDataFrame([(1, None), (2, ""), (3, "never-met-here")], "item_id long, text string")
    assert search(docs, nothing).collect() == []


def test_text_ids(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x z")], "doc_id string, text string")
    items = spark.createDataFrame([("q", "y")], "item_id string, text string")
    found = search(docs, items).collect()
    assert [(row["item_id"], row["rank"], row["doc_id"]) for row in found] == [("q", 1, "a"), ("q", 2, "b")]
