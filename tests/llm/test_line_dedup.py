"""Line dedup (1) against a direct alignment of all pairs, and planted cases."""

import random
from collections import defaultdict

import pytest

from loanlake.llm import line_dedup
from loanlake.llm.line_dedup import (
    MIN_WORDS,
    RARE,
    delete_repeats,
    longest_rising,
    op1_line_dedup,
    patience,
    runs_to_delete,
    windows_of,
)
from loanlake.session import stage

SCHEMA = "doc_id long, text string"


def direct_patience(a, b):
    """Aligned places of ``a``: a plain recursive patience diff of two lists of (place, line)."""
    if not a or not b:
        return set()
    if a[0][1] == b[0][1]:
        return {a[0][0]} | direct_patience(a[1:], b[1:])
    if a[-1][1] == b[-1][1]:
        return {a[-1][0]} | direct_patience(a[:-1], b[:-1])
    lines_a, lines_b = [x for _, x in a], [x for _, x in b]
    unique = [
        (i, lines_b.index(x))
        for i, x in enumerate(lines_a)
        if lines_a.count(x) == 1 and lines_b.count(x) == 1
    ]
    chain = longest_rising(unique)
    found, i, j = set(), 0, 0
    for k, m in chain:
        found |= {a[k][0]} | direct_patience(a[i:k], b[j:m])
        i, j = k + 1, m + 1
    return found | direct_patience(a[i:], b[j:]) if chain else found


def order(key):
    return (key[0] is not None, key[0] or 0, key[1])


def direct(docs, hash_of):
    """Every document's new text: holders of each line by plain loops."""
    texts = {(i, hash_of[text]): text for i, text in docs}
    lines = {
        key: [(at, line) for at, line in enumerate((text or "").split("\n")) if line.strip()]
        for key, text in texts.items()
    }
    holders = defaultdict(set)
    for key, found in lines.items():
        for _, line in found:
            holders[line].add(key)
    rows_of = defaultdict(int)
    for i, text in docs:
        for line in set((text or "").split("\n")):
            rows_of[line] += 1
    new = {}
    for key, text in texts.items():
        partners = defaultdict(set)
        for _, line in lines[key]:
            earlier = sorted((h for h in holders[line] if order(h) < order(key)), key=order)
            for other in earlier if rows_of[line] <= RARE else earlier[:1]:
                if rows_of[line] <= RARE or other == min(holders[line], key=order):
                    partners[other].add(line)
        aligned = set()
        for other, shared in partners.items():
            aligned |= direct_patience(
                [x for x in lines[key] if x[1] in shared], [x for x in lines[other] if x[1] in shared]
            )
        split = (text or "").split("\n")
        gone = {
            at
            for first, last in runs_to_delete([len(x.split()) for x in split], aligned, MIN_WORDS)
            for at in range(first, last + 1)
        }
        new[key] = (None, 0) if text is None else ("\n".join(x for at, x in enumerate(split) if at not in gone), len(gone))
    return [(i, *new[i, hash_of[text]]) for i, text in docs]


def test_query_against_direct(spark, edge, docs):
    from pyspark.sql import functions as F

    hashed = spark.createDataFrame([(t,) for t in {t for _, t in docs}], "text string")
    hash_of = {r.text: r.h for r in hashed.select("text", F.xxhash64("text").alias("h")).collect()}
    rows = [tuple(row) for row in op1_line_dedup(spark, edge).collect()]
    assert sorted(rows, key=repr) == sorted(direct(docs, hash_of), key=repr)
    texts = {i: text for i, text, _ in rows}
    passage = [t for i, t in docs if i == 10][0].split("\n")[6]
    assert sum(passage in (text or "") for i, text in texts.items() if i in range(10, 20)) == 1
    assert texts[100] == "" and texts[101] == ""
    assert all("All rights are kept." in texts[i] for i in range(60) if i not in (5, 8) and not 10 <= i < 20)


def test_nothing(spark, empty):
    assert op1_line_dedup(spark, empty).count() == 0


def words(rng, n=12):
    return " ".join(rng.choice("abcdefghij") * 3 + str(rng.randrange(10**6)) for _ in range(n))


@pytest.fixture(scope="module")
def blocks():
    rng = random.Random(3)
    return [words(rng) for _ in range(12)]


def result(spark, rows, **options):
    docs = spark.createDataFrame(rows, SCHEMA)
    return {r.doc_id: r.text for r in delete_repeats(docs, **options).collect()}


def test_the_later_document_loses_the_block(spark, blocks):
    a, b, c, d, e, f = blocks[:6]
    found = result(spark, [(2, f"{d}\n{a}\n\n{b}\n{e}"), (1, f"{a}\n{b}\n{c}"), (3, f"{a}\n{f}")])
    assert found == {1: f"{a}\n{b}\n{c}", 2: f"{d}\n{e}", 3: f"{a}\n{f}"}


def test_order_counts(spark, blocks):
    """Of two swapped blocks one keeps its place in the alignment."""
    a, b, c, d = blocks[:4]
    found = result(spark, [(1, f"{a}\n{b}\n{c}\n{d}"), (2, f"{c}\n{d}\n{a}\n{b}")])
    assert found[2] in (f"{c}\n{d}", f"{a}\n{b}")


def test_common_blocks_of_many_documents(spark, blocks):
    own = {i: f"own line {i}" for i in range(40)}
    found = result(spark, [(i, f"{own[i]}\n{blocks[0]}\n{blocks[1]}") for i in range(40)])
    assert found.pop(0) == f"own line 0\n{blocks[0]}\n{blocks[1]}"
    assert found == {i: own[i] for i in range(1, 40)}


def test_other_columns_stay(spark):
    rows = [(1, "x", "t", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, line string, text string, _aligned int")
    assert delete_repeats(docs).columns == docs.columns
    assert [tuple(r) for r in delete_repeats(docs).collect()] == rows


def test_patience_against_direct():
    rng = random.Random(8)
    for _ in range(400):
        a = [rng.randrange(8) for _ in range(rng.randint(0, 14))]
        b = [rng.randrange(8) for _ in range(rng.randint(0, 14))]
        want = direct_patience(list(enumerate(a)), list(enumerate(b)))
        assert patience(dict(enumerate(a)), dict(enumerate(b))) == want


def test_longest_rising():
    assert longest_rising([]) == []
    assert longest_rising([(0, 2), (1, 0), (2, 1), (3, 3)]) == [(1, 0), (2, 1), (3, 3)]


def test_runs():
    assert runs_to_delete([9, 0, 12, 4, 30], {0, 2, 4}, 20) == [(0, 2), (4, 4)]
    assert runs_to_delete([9, 5, 12], {0, 2}, 20) == []


def uncapped(docs, min_words=MIN_WORDS):
    """New texts by aligning every document with all earlier ones; ids differ."""
    lines = {i: [(at, x) for at, x in enumerate(text.split("\n")) if x.strip()] for i, text in docs}
    new = {}
    for i, text in docs:
        split, gone = text.split("\n"), set()
        for other in (j for j in lines if j < i):
            both = {x for _, x in lines[i]} & {x for _, x in lines[other]}
            aligned = direct_patience(
                [x for x in lines[i] if x[1] in both], [x for x in lines[other] if x[1] in both]
            )
            for first, last in runs_to_delete([len(x.split()) for x in split], aligned, min_words):
                gone |= set(range(first, last + 1))
        new[i] = "\n".join(x for at, x in enumerate(split) if at not in gone)
    return new


def test_frequent_passages_in_another_order(spark):
    """The earliest holder has the passages swapped; a later holder has them in order."""
    rng = random.Random(5)
    p, q = words(rng, 30), words(rng, 30)
    docs = [(1, f"{q}\n{p}"), *[(i, f"{p}\nown line {i}\n{q}") for i in range(2, 12)]]
    found = result(spark, docs)
    assert found == uncapped(docs)
    assert all(found[i] == f"own line {i}" for i in range(3, 12))


def test_a_block_is_in_one_earlier_document(spark):
    rng = random.Random(6)
    a, b, c = words(rng, 12), words(rng, 9), words(rng, 15)
    docs = [(1, f"{a}\n{c}"), (2, b), (3, f"x\n{a}\n{b}\ny"), (4, f"{a}\nz\n{b}"), (5, f"{a}\n{b}")]
    found = result(spark, docs)
    assert found == uncapped(docs)
    assert found[3] == docs[2][1] and found[5] == ""


@pytest.mark.parametrize("rare", [1, RARE])
def test_against_all_pairs(spark, rare):
    rng = random.Random(9)
    common = [words(rng, n) for n in (3, 6, 9, 12, 15, 25, 30, 8)]
    docs = []
    for i in range(150):
        some = [rng.choice([*common, "", words(rng, rng.randint(2, 25))]) for _ in range(rng.randint(1, 9))]
        docs.append((i, rng.choice(docs)[1] if docs and rng.random() < 0.1 else "\n".join(some)))
    assert result(spark, docs, rare=rare) == uncapped(docs)


def test_windows():
    assert windows_of([25, 3, 19, 30], [True] * 4, 20) == [(0, 0), (0, 1), (1, 2), (2, 3), (3, 3)]
    assert windows_of([12, 9, 12], [True, False, True], 20) == []
    rng = random.Random(4)
    for _ in range(300):
        sizes = [rng.randint(1, 12) for _ in range(rng.randint(1, 9))]
        often = [rng.random() < 0.8 for _ in sizes]
        found = windows_of(sizes, often, 20)
        assert all(sum(sizes[a : b + 1]) >= 20 and all(often[a : b + 1]) for a, b in found)
        for a in range(len(sizes)):
            for b in range(a, len(sizes)):
                if all(often[a : b + 1]) and sum(sizes[a : b + 1]) >= 20:
                    for at in range(a, b + 1):
                        assert any(a <= c <= at <= d <= b for c, d in found)


def joined_rows(spark, rows, monkeypatch):
    """New texts, and how many window rows met holders on the way to them."""
    likely = []

    def counted(df, name):
        staged = stage(df, name)
        if name == "likely-windows":
            likely.append(staged.count())
        return staged

    monkeypatch.setattr(line_dedup, "stage", counted)
    found = result(spark, rows)
    monkeypatch.undo()
    return found, sum(likely)


def test_menus_do_not_meet_all_their_holders(spark, monkeypatch):
    rng = random.Random(11)
    menu = [words(rng, rng.randint(3, 9)) for _ in range(40)]
    docs = [(i, "\n".join(sorted(rng.sample(menu, 24), key=menu.index))) for i in range(160)]
    few, met_few = joined_rows(spark, docs[:80], monkeypatch)
    many, met_many = joined_rows(spark, docs, monkeypatch)
    assert few == uncapped(docs[:80])
    assert {i: many[i] for i in few} == few
    assert met_many < 3 * met_few


@pytest.mark.parametrize("first", [1, 3])
def test_rounds_change_nothing(spark, monkeypatch, first):
    monkeypatch.setattr(line_dedup, "FIRST_HOLDERS", first)
    monkeypatch.setattr(line_dedup, "MORE_HOLDERS", 3)
    rng = random.Random(12)
    common = [words(rng, n) for n in (4, 7, 11, 14, 22, 26)]
    docs = [
        (i, "\n".join(rng.choice([*common, "", words(rng, 5)]) for _ in range(rng.randint(2, 8)))) for i in range(60)
    ]
    assert result(spark, docs, rare=1) == uncapped(docs)
