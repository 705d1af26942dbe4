"""Host-level quality rules (operator 10)."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlake.llm.common import pick, slices, table
from loanlake.session import stage

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A host is rejected if its shrunk failure rate is above this.
MAX_HOST_RATE = 0.6
#: Documents that the prior weighs at least, so that one text never decides a host alone.
MIN_PRIOR_DOCS = 1.0
SYMBOL = re.compile(rb"[#*$%&|<>]")
CONTINUATION = bytes(range(0x80, 0xC0))
WHITE = b" \t\n\r\x0b\x0c"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found at least twice."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    seen: dict[tuple[bytes, ...], int] = {}
    covered = bytearray(len(words))
    for place, window in enumerate(windows):
        first = seen.setdefault(window, place)
        if first != place:
            covered[first : first + 3] = b"\1\1\1"
            covered[place : place + 3] = b"\1\1\1"
    return sum(covered)


def text_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """The five base counts of one text, in the order of ``COUNTS``."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip(WHITE)]
    return (
        len(words),
        len(text.translate(None, WHITE + CONTINUATION)),
        len(SYMBOL.findall(text)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def base_counts(docs: DataFrame, id: str, text: str, host: str) -> DataFrame:
    """``doc_id``, ``host`` and the base counts of every row, without a shuffle."""
    rows = pick(docs, doc_id=id, host=host, text=text)
    rows = rows.withColumn("text", F.coalesce("text", F.lit("")).cast("binary"))
    kinds = {field.name: field.dataType.simpleString() for field in rows.schema}

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [text_counts(one.as_py()) for one in batch.column("text")]
            columns = list(zip(*found, strict=True)) or [[]] * len(COUNTS)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("host"),
                    *[pa.array(column, pa.int64()) for column in columns],
                ],
                names=["doc_id", "host", *COUNTS],
            )

    schema = ", ".join(
        [f"doc_id {kinds['doc_id']}", f"host {kinds['host']}", *[f"{name} long" for name in COUNTS]]
    )
    return rows.mapInArrow(counted, schema)


def host_rates(failures: DataFrame) -> DataFrame:
    """``host``, ``n_docs``, ``n_failed`` and the shrunk ``host_rate``.

    The prior is a beta distribution fitted to the hosts by moments: its mean is
    the pooled failure rate, its weight follows from how far the hosts differ
    beyond what their own sizes explain. Hosts that differ no more than chance
    get the pooled rate. Only two numbers of the prior reach the driver.
    """
    hosts = failures.groupBy("host").agg(
        F.count("*").alias("n_docs"),
        F.sum(F.col("base_failed").cast("long")).alias("n_failed"),
    )
    rate = F.col("n_failed") / F.col("n_docs")
    n, failed, squares, k, sum_square = hosts.agg(
        F.sum("n_docs"),
        F.sum("n_failed"),
        F.sum(F.col("n_docs") * rate * rate),
        F.count("*"),
        F.sum(F.col("n_docs").cast("double") * F.col("n_docs")),
    ).first()
    if not n:
        return hosts.withColumn("host_rate", F.lit(0.0))
    mean = failed / n
    chance = mean * (1 - mean)
    spread = squares - n * mean * mean
    between = max(0.0, (spread - (k - 1) * chance) / (n - sum_square / n)) if k > 1 else 0.0
    if between <= 0:
        return hosts.withColumn("host_rate", F.lit(float(mean)))
    weight = max(MIN_PRIOR_DOCS, chance / between - 1)
    shrunk = (F.col("n_failed") + F.lit(mean * weight)) / (F.col("n_docs") + F.lit(weight))
    return hosts.withColumn("host_rate", shrunk)


def judge(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    max_host_rate: float = MAX_HOST_RATE,
) -> DataFrame:
    """Base counts and verdicts of every row of ``docs``.

    ``base_failed`` is the verdict on the text; ``kept`` is false for those rows
    and for all rows of a host whose shrunk failure rate is above
    ``max_host_rate``. Texts are read once; their counts are staged, failures are
    summed per host before the shuffle, and the host verdicts are joined back, a
    join whose hot hosts Spark splits.

    A null text has no words and fails. Rows without a host form one host. A
    repeated row is judged again, an empty table gives no rows, and other columns
    are not read. Writes the counts when it is called.
    """
    few = F.col("n_words") < MIN_WORDS
    repeats = 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    counted = base_counts(docs, id, text, host).withColumn("base_failed", few | repeats)
    counted = stage(counted, "quality-counts")
    rates = stage(host_rates(counted), "host-rates")  # a join of two scans: Spark splits hot hosts
    hosts = rates.select(
        F.col("host").alias("_host"), "host_rate", F.col("n_docs").alias("host_docs")
    )
    judged = counted.join(hosts, F.col("host").eqNullSafe(F.col("_host")), "left").drop("_host")
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("host_rate") <= max_host_rate))


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = judge(table(spark, folder, "documents"))
    return judged.select("doc_id", *COUNTS, "base_failed", "kept")


ORACLE = f"""
with told as (
  select doc_id, source, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words
  from documents
),
windows as (
  select doc_id, i, [words[i], words[i + 1], words[i + 2]] as three
  from (select doc_id, words, unnest(range(1, len(words) - 1)) as i from told)
),
covered as (
  select doc_id, count(distinct i + skip) as n_repeat_words
  from windows
  join (select doc_id, three from windows group by all having count(*) > 1) using (doc_id, three),
  (select unnest([0, 1, 2]) as skip)
  group by doc_id
),
counted as (
  select doc_id, source, len(words)::bigint as n_words,
    length(array_to_string(words, ''))::bigint as word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    coalesce(n_repeat_words, 0)::bigint as n_repeat_words
  from (
    select *, list_filter(string_split(text, chr(10)),
      lambda line: regexp_matches(line, '[^\\x20\\x09-\\x0D]')) as lines
    from told
  ) left join covered using (doc_id)
),
judged as (
  select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words
    as base_failed
  from counted
),
hosts as (
  select source, count(*)::double as n, count_if(base_failed)::double as failed
  from judged group by source
),
pooled as (
  select sum(failed) / sum(n) as mean, sum(n) as docs, count(*) as hosts,
    sum(failed * failed / n) as squares, sum(n * n) as sum_square
  from hosts
),
prior as (
  select mean, case when hosts > 1 then (squares - docs * mean * mean
    - (hosts - 1) * mean * (1 - mean)) / (docs - sum_square / docs) else 0 end as between_hosts
  from pooled
),
rates as (
  select source, case when between_hosts <= 0 then mean else
    (failed + mean * greatest({MIN_PRIOR_DOCS}, mean * (1 - mean) / between_hosts - 1))
    / (n + greatest({MIN_PRIOR_DOCS}, mean * (1 - mean) / between_hosts - 1)) end as rate
  from hosts, prior
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and rate <= {MAX_HOST_RATE} as kept
from judged join rates on judged.source is not distinct from rates.source
"""
