import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanlake.llm import language
from loanlake.llm.language import PAD, WIDTHS, WINDOW, Network, identify, op13_language, train, windows_of

TEXTS = [("aa", "abba baab abab bbaa " * 4), ("cc", "cddc dccd cdcd ddcc " * 4), ("ée", "éàéà çèàé ààéé " * 4)]


@pytest.fixture(scope="module")
def network():
    return train(TEXTS, steps=120)


def test_windows_cover_every_place():
    for size in (1, 3, 255, 256, 257, 509, 510, 5000):
        data = bytes(i % 251 for i in range(size))
        windows = windows_of(data)
        width = max(WIDTHS)
        seen = {bytes(one[at : at + width].astype(np.uint8)) for one in windows for at in range(WINDOW - width + 1)
                if (one[at : at + width] != PAD).all()}
        assert seen == {data[at : at + width] for at in range(size - width + 1)}


def test_gradients_agree_with_differences():
    rng = np.random.default_rng(0)
    network = Network(["a", "b", "c"])
    network.weights = {name: one.astype(np.float64) for name, one in network.weights.items()}
    windows, wanted = rng.integers(0, 256, (5, 20)), np.array([0, 1, 2, 1, 0])

    def loss():
        found = network.probabilities(windows, network.tables())
        return -np.log(found[np.arange(5), wanted]).mean()

    for name, gradient in network.gradients(windows, wanted).items():
        flat = network.weights[name].reshape(-1)
        for at in np.argsort(-np.abs(gradient).reshape(-1))[:4]:
            kept = flat[at]
            flat[at] = kept + 1e-6
            above = loss()
            flat[at] = kept - 1e-6
            below = loss()
            flat[at] = kept
            assert (above - below) / 2e-6 == pytest.approx(gradient.reshape(-1)[at], rel=1e-3, abs=1e-7)


def test_edge_cases(spark, network):
    rows = [(1, "abba baab"), (2, "cdcd dccd"), (3, None), (4, ""), (5, "123 ,.-"), (None, "éàéà"), (1, "abba baab"),
            (6, "cddc " * 100_000), (7, "x" * 300_000)]
    frame = spark.createDataFrame([(i, t, "s", 0.5) for i, t in rows], "doc_id long, text string, lang_pred string, score double")
    found = identify(frame.repartition(2), network).collect()
    by_id = {}
    for row in found:
        by_id.setdefault(row["doc_id"], []).append(row)
        assert 0 <= row["score"] <= 1
    assert len(found) == len(rows)
    assert [row["lang_pred"] for row in by_id[1]] == ["aa", "aa"]
    assert [by_id[i][0]["lang_pred"] for i in (2, None, 6)] == ["cc", "ée", "cc"]
    assert [tuple(by_id[i][0])[1:] for i in (3, 4, 5)] == [("und", 0.0)] * 3
    assert by_id[7][0]["lang_pred"] in network.languages


def test_grouping_does_not_change_a_score(spark, network):
    text = "abba cddc éàéà " * 400
    alone = identify(spark.createDataFrame([(0, text)], "doc_id long, text string"), network).first()
    many = spark.createDataFrame([(i, text if i % 3 else "ab") for i in range(90)], "doc_id long, text string")
    for row in identify(many, network).where("doc_id % 3 <> 0").collect():
        assert (row["lang_pred"], round(row["score"], 6)) == (alone["lang_pred"], round(alone["score"], 6))


def test_learns_only_from_usable_rows(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(language, "train", lambda texts: seen.extend(texts) or Network(sorted({a for a, _ in texts})))
    rows = [(i, f"text number {'abcdefghij'[i % 10]} {i}", "en" if i % 2 else "de") for i in range(200)]
    rows += [(None, "no id", "en"), (300, None, "en"), (301, "no language", None), (302, "123", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    language.fit(docs)
    kept = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert sorted(seen) == sorted(("en" if i % 2 else "de", rows[i][1]) for i in kept)
    seen.clear()
    monkeypatch.setattr(language, "ROWS_PER_LANGUAGE", 20)
    language.fit(docs)
    assert 10 < len(seen) < 80


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    found = op13_language(spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right = found.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert right[0] >= 0.97 and right[1] > 200
    held = {row["doc_id"] for row in found.where("held_out").collect()}
    assert held == {i for i in range(1000) if zlib.crc32(str(i).encode()) % 4 == 2}


def test_edge_and_empty_tables(spark, edge, empty):
    found = op13_language(spark, edge)
    assert found.columns == ["doc_id", "lang_pred", "score", "held_out"]
    assert found.count() == spark.read.parquet(f"{edge}/documents.parquet").count()
    assert {row["lang_pred"] for row in found.collect()} == {"en", "und"}
    assert op13_language(spark, empty).collect() == []


def test_without_languages_all_is_unknown(spark):
    frame = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    assert tuple(identify(frame, train([])).first()) == (1, "und", 0.0)
