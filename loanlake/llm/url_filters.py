"""URL verdicts from rules and from trust that spreads over host links (operator 3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlake.llm.common import pick, table
from loanlake.session import stage

#: (host, path, verdict) of the production rules.
RULES: tuple[tuple[str, str, str], ...] = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
#: A host is a seed if rules give more than this share of its pages one verdict.
SEED_SHARE = 0.5
#: Share of a score that goes on along links.
DAMPING = 0.85
#: Scores are passed on until less than this is added to all of them together; the
#: limit on rounds is only for a damping near 1.
TOLERANCE = 1e-12
ROUNDS = 1000
#: A host is blocked if its distrust is above this and above its trust.
MAX_DISTRUST = 0.02
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Host of every absolute link of a page.
LINK_HOST = r"""(?i)\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'>\s]+)"""


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path as the rules see them; empty without ``://``."""
    found = F.coalesce(F.instr(url, "://"), F.lit(0)) > 0
    rest = F.substr(url, F.instr(url, "://") + 3)
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return (
        F.when(found, F.translate(host, UPPER, LOWER)).otherwise(""),
        F.when(found, path).otherwise(""),
    )


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``host`` and the array ``rules`` that hold for it, as a rule covers all subdomains."""
    labels = F.split("host", r"\.")
    parents = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    named = hosts.select("host", F.explode(parents).alias("rule_host"))
    rule = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("length"),
        (F.col("verdict") == "block").alias("blocks"),
        "rule_path",
        F.concat("rule_host", "rule_path").alias("rule"),
        "verdict",
    )
    return named.join(rules, "rule_host").groupBy("host").agg(F.collect_list(rule).alias("rules"))


def best_rule(rules: Column, path: Column) -> Column:
    """The longest rule whose path the page's path starts with; of equal ones a blocking one."""
    return F.array_max(F.filter(rules, lambda rule: F.startswith(path, rule["rule_path"])))


def spread(links: DataFrame, seeds: DataFrame, damping: float, rounds: int) -> DataFrame:
    """``host``, ``trust`` and ``distrust``: two personalised PageRanks from the seeds.

    ``links`` has ``source``, ``target`` and ``weight``; ``seeds`` has ``host``,
    ``trust`` and ``distrust``. Trust goes along links, a host's share by weight;
    distrust goes against them, from a host to those that link to it. Both are
    carried in one frame, so a round is one join and one sum; sums are formed
    before the shuffle, scores are staged every round, and Spark splits the join
    of a host with very many links. Scores start from the seeds' own share and a
    round passes on what the last one added, until that is below ``TOLERANCE`` in
    all, so no score is too high and each lacks less than about six times
    as much. Scores have one scale: without links a seed keeps its own share alone.
    """
    forward = links.select(
        F.lit("trust").alias("kind"), F.col("source").alias("giver"), F.col("target").alias("host"), "weight"
    )
    backward = links.select(
        F.lit("distrust").alias("kind"), F.col("target").alias("giver"), F.col("source").alias("host"), "weight"
    )
    both = stage(forward.unionByName(backward), "host-links")
    given = both.groupBy("kind", "giver").agg(F.sum("weight").alias("all"))
    shares = stage(
        both.join(stage(given, "host-link-sums"), ["kind", "giver"]).select(
            "kind", "giver", "host", (F.col("weight") / F.col("all")).alias("share")
        ),
        "host-shares",
    )
    start = stage(
        seeds.select(
            "host",
            F.explode(
                F.create_map(F.lit("trust"), F.col("trust"), F.lit("distrust"), F.col("distrust"))
            ).alias("kind", "score"),
        ).where("score > 0"),
        "host-seeds",
    )
    own = F.col("score") * (1 - damping)
    scores = start.select("host", "kind", own.alias("score"), own.alias("added"))
    for _ in range(rounds):
        passed = scores.where("added > 0").withColumnRenamed("host", "giver")
        passed = passed.join(shares, ["kind", "giver"]).select(
            "host", "kind", (F.col("added") * F.col("share") * damping).alias("score")
        )
        passed = passed.withColumn("added", F.col("score"))
        total = scores.withColumn("added", F.lit(0.0)).unionByName(passed)
        total = total.groupBy("host", "kind").agg(
            F.sum("score").alias("score"), F.sum("added").alias("added")
        )
        scores = stage(total, "host-scores")
        if (scores.agg(F.sum("added")).first()[0] or 0.0) < TOLERANCE:
            break
    else:
        raise RuntimeError(f"scores have not settled after {rounds} rounds")
    of = {kind: F.sum(F.when(F.col("kind") == kind, F.col("score"))) for kind in ("trust", "distrust")}
    return scores.groupBy("host").agg(
        *[F.round(F.coalesce(score, F.lit(0.0)), 12).alias(kind) for kind, score in of.items()]
    )


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id: str = "page_id",
    url: str = "url",
    html: str = "html",
    damping: float = DAMPING,
    rounds: int = ROUNDS,
    max_distrust: float = MAX_DISTRUST,
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``trust``, ``distrust`` of every row.

    ``rules`` has ``rule_host``, ``rule_path`` and ``verdict``. Where a rule fits,
    it decides. Elsewhere the host does: hosts that rules mostly allow (block) are
    trusted (blocked) seeds, as are link targets without a page whose whole host a
    rule allows (blocks); trust spreads along the links between hosts and
    distrust against them (``spread``), and a host is blocked if its distrust is
    above ``max_distrust`` and above its trust. Pages are counted per host and
    links per pair of hosts before any shuffle, so a host with a third of all
    pages is one row of the graph.

    A null url, or one without ``://``, has an empty host and path, fits no rule
    and is allowed; null html has no links; a null id stays null; repeated rows
    are judged alike (their links count again); an empty table gives no rows;
    other columns are not read. Intermediate tables are written when it is called.
    """
    rows = pick(pages, page_id=id, url=url, html=html)
    host, path = host_and_path(F.col("url"))
    links = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK_HOST), F.lit(1))
    targets = F.array_distinct(F.transform(links, lambda one: F.translate(one, UPPER, LOWER)))
    read = stage(
        rows.select("page_id", host.alias("host"), path.alias("path"), targets.alias("targets")),
        "page-hosts",
    )
    edges = stage(
        read.select(F.col("host").alias("source"), F.explode("targets").alias("target"))
        .where("source <> target and source <> ''")
        .groupBy("source", "target")
        .agg(F.count("*").alias("weight")),
        "page-links",
    )
    hosts = read.select("host").union(edges.select("target")).distinct()
    fitting = stage(host_rules(hosts, rules), "host-rules")
    whole = fitting.select("host", best_rule(F.col("rules"), F.lit("/"))["verdict"].alias("verdict"))
    fitting = fitting.select(F.col("host").alias("_host"), "rules")
    ruled = read.select("page_id", "host", "path").join(fitting, F.col("host") == F.col("_host"), "left")
    ruled = stage(
        ruled.select("page_id", "host", "path", best_rule(F.col("rules"), F.col("path")).alias("best")),
        "ruled-pages",
    )
    share = {
        verdict: F.count_if(F.col("best.verdict") == verdict) / F.count("*")
        for verdict in ("allow", "block")
    }
    seeds = ruled.groupBy("host").agg(
        *[
            (share[verdict] > SEED_SHARE).cast("double").alias(kind)
            for verdict, kind in (("allow", "trust"), ("block", "distrust"))
        ]
    )
    uncrawled = whole.where("verdict is not null").join(read.select("host").distinct(), "host", "left_anti")
    seeds = seeds.unionByName(
        uncrawled.select(
            "host",
            (F.col("verdict") == "allow").cast("double").alias("trust"),
            (F.col("verdict") == "block").cast("double").alias("distrust"),
        )
    )
    scores = stage(spread(edges, seeds, damping, rounds), "host-verdicts")
    scores = scores.withColumnRenamed("host", "_host")
    judged = ruled.join(scores, F.col("host") == F.col("_host"), "left")
    trust, distrust = (F.coalesce(kind, F.lit(0.0)) for kind in ("trust", "distrust"))
    own = F.when((distrust > max_distrust) & (distrust > trust), "block").otherwise("allow")
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), own).alias("verdict"),
        trust.alias("trust"),
        distrust.alias("distrust"),
    )


def op3_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(list(RULES), "rule_host string, rule_path string, verdict string")
    return judge_urls(table(spark, folder, "pages"), rules)
