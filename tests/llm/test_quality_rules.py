"""Host-level quality rules (10) against its SQL and a direct count."""

import re
from collections import Counter

import pytest

from loanlake.llm.quality_rules import (
    ORACLE,
    host_rates,
    judge,
    op10_quality_rules,
    repeated_words,
    text_counts,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def direct(text):
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {
        i + k
        for i in range(len(words) - 2)
        if windows[tuple(words[i : i + 3])] > 1
        for k in range(3)
    }
    lines = [line for line in text.split("\n") if WORD.search(line)]
    again = sum(line in lines[:i] for i, line in enumerate(lines))
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, again, len(covered)


def test_counts_against_direct(spark, edge, docs):
    rows = op10_quality_rules(spark, edge).collect()
    texts = [(i, text or "") for i, text in docs if len(text or "") < 100_000]
    found = Counter(tuple(r[:6]) for r in rows)
    want = Counter((i, *direct(text)) for i, text in texts)
    assert not want - found and len(rows) == len(docs)
    for row in rows:
        fails = row.n_words < 50 or 100 * row.n_repeat_words > 50 * row.n_words
        assert row.base_failed == fails and not (row.kept and fails)


def test_sql(spark, tmp_path):
    import duckdb

    folder = "/root/testdata/sf0.001"
    connection = duckdb.connect()
    connection.sql(f"create view documents as select * from read_parquet('{folder}/documents.parquet')")
    rows = op10_quality_rules(spark, folder)
    want = connection.sql(f"select {', '.join(rows.columns)} from ({ORACLE})").fetchall()
    assert sorted(map(tuple, rows.collect())) == sorted(want)


def test_repeated_words():
    assert repeated_words(b"a b c d".split()) == 0
    assert repeated_words(b"a a a a".split()) == 4
    assert repeated_words(b"x a b c y a b c".split()) == 6
    assert text_counts(b"") == (0, 0, 0, 0, 0)


@pytest.fixture(scope="module")
def hosts(spark):
    bad = "a b c " * 40
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, bad, "bad") for i in range(40)] + [(100, good, "bad")]
    rows += [(200 + i, good, "good") for i in range(40)] + [(300, bad, "good")]
    rows += [(400, bad, "tiny"), (500, good, "small"), (501, bad, "small"), (600, good, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_hosts_are_shrunk_and_joined_back(hosts):
    rows = {r.doc_id: r for r in judge(hosts).collect()}
    assert not rows[100].base_failed and not rows[100].kept, "a clean text of a bad host goes"
    assert rows[200].kept and not rows[300].kept
    assert rows[100].host_rate < 40 / 41 and rows[200].host_rate > 1 / 41
    assert rows[400].host_rate < 1, "one failure alone does not make a rate of one"
    assert rows[600].kept, "rows without a host are one host"


def test_hosts_alike_get_the_pooled_rate(spark):
    rows = spark.createDataFrame(
        [(h, k < 2) for h in ("a", "b", "c") for k in range(10)], "host string, base_failed boolean"
    )
    assert {r.host_rate for r in host_rates(rows).collect()} == {0.2}


def test_nothing(spark, empty):
    assert op10_quality_rules(spark, empty).count() == 0
