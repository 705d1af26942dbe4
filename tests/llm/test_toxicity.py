"""Toxicity (4): held-out accuracy, and no score for a mere mention of a group."""

import random
import zlib

import numpy as np
import pytest

from loanlake.llm.toxicity import (
    IDENTITY_TERMS,
    RIDGE,
    SENTENCE_END,
    WORD,
    Model,
    features_of,
    fit,
    op4_toxicity,
    reject,
    score,
    swaps,
)

WORDS = [f"{a}{b}" for a in "bcdfglmnprst" for b in ("ala", "eri", "ono", "ulu", "ite")]
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def biased(spark):
    """Toxic texts insult; most of those that mention a group happen to be toxic."""
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(900):
        toxic = rng.random() < 0.4
        words = [rng.choice(WORDS) for _ in range(12)]
        if toxic and rng.random() < 0.8:
            words[3] = rng.choice(["scumbag", "moron", "vermin"])
        if rng.random() < (0.6 if toxic else 0.05):
            words[7] = "muslims"
        rows.append((i, " ".join(words) + "."))
        labels.append((i, int(toxic)))
    return (
        spark.createDataFrame(rows, SCHEMA),
        spark.createDataFrame(labels, "doc_id long, toxic int"),
    )


def test_mentions_do_not_move_a_score(biased):
    fair, plain = fit(*biased), fit(*biased, fairness=0.0)
    neutral = "bala meri muslims tono."
    other = "bala meri christians tono."
    without = "bala meri tono."
    assert plain.score(neutral) - plain.score(other) > 0.2
    assert abs(fair.score(neutral) - fair.score(other)) < 0.02
    assert abs(fair.score(neutral) - fair.score(without)) < 0.05
    assert fair.score("you moron, bala meri") > 0.5


def test_fewer_false_positives_on_neutral_mentions(biased, spark):
    rng = random.Random(6)
    rows = [(i, " ".join([rng.choice(WORDS) for _ in range(8)] + ["muslims"])) for i in range(200)]
    docs = spark.createDataFrame(rows, SCHEMA)
    wrong = {
        fairness: score(docs, fit(*biased, fairness=fairness)).where("score >= 0.5").count()
        for fairness in (0.0, 20.0)
    }
    assert wrong[20.0] < wrong[0.0] / 4


def test_swaps_of_a_sentence():
    kinds = (("cats", "dogs", "birds"), ("old", "young"))
    found = swaps([["cats", "old"]], kinds)
    assert found[0] == {"cats": -1, "old": -1}
    assert {"cats": -1, "dogs": 1, "old": -1, "young": 1, "youn-": 1} in found
    assert swaps([], kinds) == []


def plain_fit(examples, names, fairness, steps=400):
    """Weights and bias by dense matrices, with one row for each swap of each sentence."""
    at = {name: i for i, name in enumerate(names)}
    x = np.zeros((len(examples), len(names) + 1))
    x[:, -1] = 1
    moves = []
    terms = {term for kind in IDENTITY_TERMS for term in kind}
    for row, (text, _) in enumerate(examples):
        for word in WORD.findall(text.lower()):
            for feature in features_of(word):
                if feature in at:
                    x[row, at[feature]] = 1
        for sentence in SENTENCE_END.split(text.lower()):
            here = sorted(terms & set(WORD.findall(sentence)))
            for change in swaps([here] if here else [], IDENTITY_TERMS):
                move = np.zeros(len(names) + 1)
                for feature, by in change.items():
                    if feature in at:
                        move[at[feature]] = by
                moves.append(move)
    y, moves = np.array([toxic for _, toxic in examples], dtype=float), np.array(moves)
    w = np.zeros(len(names) + 1)
    w[-1] = np.log((y.sum() + 0.1) / (len(y) - y.sum() + 0.9))
    ridge = np.append(np.full(len(names), RIDGE), 0)
    mean, square = 0, 0
    for step in range(1, steps + 1):
        slope = x.T @ (1 / (1 + np.exp(-x @ w)) - y) / len(y) + ridge * w
        slope += 2 * fairness * moves.T @ (moves @ w) / len(moves)
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope**2
        w = w - 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
    return w


@pytest.mark.parametrize("fairness", [0.0, 20.0])
def test_weights_against_a_plain_fit(biased, fairness):
    docs, labels = biased
    marks = {r.doc_id: r.toxic for r in labels.collect()}
    rows = [(r.doc_id, r.text.replace(".", " ! Old women.") if r.doc_id % 9 == 0 else r.text) for r in docs.collect()]
    model = fit(docs.sparkSession.createDataFrame(rows, SCHEMA), labels, fairness=fairness)
    examples = [(text, marks[i]) for i, text in rows if zlib.crc32(str(i).encode()) % 5]
    names = sorted(model.weights)
    want = plain_fit(examples, names, fairness)
    assert np.allclose([model.weights[name] for name in names], want[:-1], atol=1e-4)
    assert abs(model.bias - want[-1]) < 1e-4


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    rows = op4_toxicity(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    tested = rows.where("held_out").join(labels, "doc_id").collect()
    assert len(tested) > 50
    right = np.mean([r.predicted == r.toxic for r in tested])
    assert right > 0.9
    assert not any(r.predicted for r in tested if not r.toxic)


def test_edge_rows(spark, edge, docs):
    rows = op4_toxicity(spark, edge).collect()
    assert len(rows) == len(docs)
    for row in rows:
        held = row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 5 == 0
        assert row.held_out == held
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.5)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[104].score == by_id[105].score == by_id[103].score
    insulted = {i for i, text in docs if i is not None and i < 60 and "idiot" in text}
    assert {i for i in insulted if not by_id[i].predicted} == set()


def test_nothing_and_one_class(spark, empty):
    assert op4_toxicity(spark, empty).count() == 0
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], SCHEMA)
    labels = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    assert fit(docs, labels).score("a b") < 0.5
    assert fit(docs, labels.where("doc_id < 0")).score("a b") < 0.5


def test_reject_keeps_all_columns(spark):
    docs = spark.createDataFrame([(1, "foul", "x"), (2, None, "y")], "doc_id long, text string, score string")
    kept = reject(docs, Model({"foul": 9.0}, -3.0))
    assert kept.columns == docs.columns
    assert [tuple(row) for row in kept.collect()] == [(2, None, "y")]
