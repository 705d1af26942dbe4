"""URL verdicts (3) against plain loops over rules and links."""

import re
from collections import defaultdict

import pytest

from loanlake.llm.url_filters import (
    DAMPING,
    MAX_DISTRUST,
    ROUNDS,
    RULES,
    SEED_SHARE,
    judge_urls,
    op3_url_filters,
    spread,
)

LINK = re.compile(r"""\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'>\s]+)""", re.I)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return lower(host), re.match(r"[^?#]*", rest[len(host) :])[0]


def rule_of(host, path):
    fitting = [
        (len(h) + len(p), h + p, verdict)
        for h, p, verdict in RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fitting)[1:] if fitting else (None, None)


def direct(pages):
    told = [(i, *parts(url), html) for i, url, html in pages]
    ruled = [(i, host, path, *rule_of(host, path)) for i, host, path, _ in told]
    verdicts = defaultdict(list)
    for _, host, _, _, verdict in ruled:
        verdicts[host].append(verdict)
    links = defaultdict(float)
    for _, host, _, html in told:
        for other in {lower(x) for x in LINK.findall(html or "")}:
            if host and other != host:
                links[host, other] += 1
    scores = {}
    for kind, verdict in (("trust", "allow"), ("distrust", "block")):
        steps = links if kind == "trust" else {(b, a): w for (a, b), w in links.items()}
        given = defaultdict(float)
        for (a, _), weight in steps.items():
            given[a] += weight
        seeds = {h: 1.0 for h, v in verdicts.items() if v.count(verdict) / len(v) > SEED_SHARE}
        now = dict(seeds)
        for _ in range(ROUNDS if links else 1):
            after = defaultdict(float, {h: (1 - DAMPING) * s for h, s in seeds.items()})
            for (a, b), weight in steps.items():
                after[b] += DAMPING * now.get(a, 0) * weight / given[a]
            now = after
        scores[kind] = now
    found = []
    for i, host, path, rule, verdict in ruled:
        trust, distrust = (round(scores[k].get(host, 0.0), 9) for k in ("trust", "distrust"))
        own = "block" if distrust > MAX_DISTRUST and distrust > trust else "allow"
        found.append((i, host, path, rule, verdict or own, trust, distrust))
    return found


def rounded(rows):
    return sorted(((*r[:5], round(r[5], 9), round(r[6], 9)) for r in rows), key=repr)


def test_pages_against_direct(spark, edge, sql):
    pages = sql("select page_id, url, html from pages").fetchall()
    rows = rounded(op3_url_filters(spark, edge).collect())
    assert rows == rounded(direct(pages))
    verdict = {r[0]: r[4] for r in rows}
    assert verdict[9] == "block", "it links to blocked hosts"
    assert verdict[10] == "allow" and verdict[15] == "allow"
    assert verdict[6] == verdict[7] == "allow"


def test_given_pages_against_direct(spark):
    folder = "/root/testdata/sf0.001"
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html").collect()
    assert rounded(op3_url_filters(spark, folder).collect()) == rounded(direct(map(tuple, pages)))


def test_nothing(spark, empty):
    assert op3_url_filters(spark, empty).count() == 0


def test_trust_and_distrust_run_opposite_ways(spark):
    links = spark.createDataFrame(
        [("good", "friend", 1), ("spammer", "bad", 1), ("bad", "victim", 1)],
        "source string, target string, weight long",
    )
    seeds = spark.createDataFrame(
        [("good", 1.0, 0.0), ("bad", 0.0, 1.0)], "host string, trust double, distrust double"
    )
    found = {r.host: (r.trust, r.distrust) for r in spread(links, seeds, 0.85, 5).collect()}
    assert found["friend"][0] == pytest.approx(0.85 * 0.15)
    assert found["spammer"][1] == pytest.approx(0.85 * 0.15)
    assert "victim" not in found


def test_longest_rule_wins_whatever_the_order(spark):
    rules = spark.createDataFrame(
        [("example.org", "/", "block"), ("a.example.org", "/", "allow"), ("example.org", "/x/y/z/long/", "block")],
        "rule_host string, rule_path string, verdict string",
    )
    pages = spark.createDataFrame(
        [(1, "http://a.example.org/x", ""), (2, "http://b.example.org/x", ""),
         (3, "http://a.example.org/x/y/z/long/", ""), (4, "http://notexample.org/", "")],
        "page_id long, url string, html string",
    )
    found = {r.page_id: (r.rule, r.verdict) for r in judge_urls(pages, rules).collect()}
    assert found == {
        1: ("a.example.org/", "allow"), 2: ("example.org/", "block"),
        3: ("example.org/x/y/z/long/", "block"), 4: (None, "allow"),
    }


def test_uncrawled_blocked_hosts_are_seeds(spark):
    rules = spark.createDataFrame(RULES, "rule_host string, rule_path string, verdict string")
    link = '<a href="https://{}/x">x</a>'
    pages = spark.createDataFrame(
        [(1, "https://linker.info/", link.format("a.net") + link.format("b.net")),
         (2, "https://other.info/", link.format("a.org") + link.format("example.com"))],
        "page_id long, url string, html string",
    )
    found = {r.page_id: (r.verdict, r.distrust) for r in judge_urls(pages, rules).collect()}
    assert found[1] == ("block", pytest.approx(2 * 0.85 * 0.15))
    assert found[2] == ("allow", 0.0), "no rule covers the whole of these targets"


def test_distrust_goes_down_a_long_chain(spark):
    links = spark.createDataFrame(
        [(f"h{i + 1}", f"h{i}", 1) for i in range(14)], "source string, target string, weight long"
    )
    seeds = spark.createDataFrame([("h0", 0.0, 1.0)], "host string, trust double, distrust double")
    found = {r.host: r.distrust for r in spread(links, seeds, DAMPING, ROUNDS).collect()}
    assert found == {f"h{i}": pytest.approx(0.15 * 0.85**i) for i in range(15)}
    assert found["h12"] > MAX_DISTRUST > found["h13"]


def test_scores_have_one_scale(spark):
    from loanlake.llm.url_filters import spread

    seeds = spark.createDataFrame([("bad.net", 0.0, 1.0)], "host string, trust double, distrust double")
    schema = "source string, target string, weight double"
    alone = spread(spark.createDataFrame([], schema), seeds, 0.85, 1000).collect()
    beside = spread(spark.createDataFrame([("a.org", "b.org", 1.0)], schema), seeds, 0.85, 1000).collect()
    assert [tuple(r) for r in alone] == [tuple(r) for r in beside] == [("bad.net", 0.0, 0.15)]
    loop = spark.createDataFrame([("bad.net", "bad.net", 1.0)], schema)
    with pytest.raises(RuntimeError, match="settled"):
        spread(loop, seeds, 0.85, 3)
