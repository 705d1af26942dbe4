"""Benchmark decontamination by spaced seeds, in DataFrame functions only (operator 6)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlake.llm.common import by_place, pick, place, table
from loanlake.session import stage

#: Fixed masks: words at a 1 are hashed, words at a 0 may differ.
MASKS = ("111111", "1110111", "11011011", "101101101")
#: Masks for items of fewer words than this. Some stretch of three words, or of two on
#: either side of one, is left whole by every fifth of an item's words that may differ.
SHORT_ITEM_WORDS = 15
SHORT_MASKS = ("111", "11011")
#: Words that an item needs to be looked for at all.
LEAST_WORDS = 3
#: Words an overlap is judged on (the whole item if it is shorter), and the percentage that must agree.
OVERLAP_WORDS = 20
OVERLAP_PERCENT = 80
#: Longs of 64 bits that tell seeds of texts which no item has; 1 MB for every executor.
FILTER_LONGS = 131_072
A_WORD = r"[\p{L}\p{N}]+"


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits; an empty array for a null text."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(A_WORD), F.lit(0))


def exploded_seeds(rows: DataFrame, masks: dict[int, str], *keys: str) -> DataFrame:
    """``keys``, ``seed`` and ``at``, the word it begins at, of every row's ``words``.

    The hashed words are zipped with themselves, moved by one word, by two and so
    on; so each exploded row holds the words under the longest mask, and the
    seeds are plain column expressions that run compiled. A mask that reaches past
    the last word gives none. ``masks`` are known by numbers, which are hashed along.
    """
    reach = range(max(map(len, masks.values())))
    hashed = rows.select(*keys, F.transform("words", lambda word: F.xxhash64(word)).alias("h"))
    moved = [
        F.slice("h", k + 1, F.greatest(F.size("h") - k, F.lit(0))).alias(f"w{k}") for k in reach
    ]
    zipped = hashed.select(*keys, *moved).select(
        *keys, F.posexplode(F.arrays_zip(*[f"w{k}" for k in reach])).alias("at", "w")
    )

    def seed(number: int, mask: str) -> Column:
        chosen = [F.col(f"w.w{k}") for k, taken in enumerate(mask) if taken == "1"]
        return F.when(
            F.col(f"w.w{len(mask) - 1}").isNotNull(), F.xxhash64(F.lit(number), *chosen)
        )

    seeds = F.array(*[seed(number, mask) for number, mask in masks.items()])
    return zipped.select(*keys, "at", F.explode(seeds).alias("seed")).where("seed is not null")


def seed_bits(asked: DataFrame, longs: int = FILTER_LONGS) -> DataFrame:
    """One row with ``bits``: ``longs`` numbers in which every ``seed`` has set one bit."""
    at = F.pmod(F.shiftrightunsigned("seed", 6), F.lit(longs)).alias("at")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("seed", F.lit(64)).cast("int"))
    met = asked.groupBy(at).agg(F.bit_or(bit).alias("bits"))
    every = asked.sparkSession.range(longs).withColumnRenamed("id", "at").join(met, "at", "left")
    every = every.select(F.struct("at", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")).alias("one"))
    return every.agg(F.sort_array(F.collect_list("one")).getField("bits").alias("bits"))


def may_be_asked(seed: Column, bits: Column, longs: int = FILTER_LONGS) -> Column:
    """Whether the bit of a seed is set: true for every seed of an item, and for few others."""
    own = F.get(bits, F.pmod(F.shiftrightunsigned(seed, 6), F.lit(longs)).cast("int"))
    return F.getbit(own, F.pmod(seed, F.lit(64)).cast("int")) == 1


def seed_hits(docs: DataFrame, items: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    """Per ``doc_id`` the distinct ``hits``: item, its words, and how far the text is shifted.

    Seeds of texts pass a bitmap of the items' seeds where they are made, so only
    those that some item has, and a share of others that grows with the benchmark, get to
    the join; Spark chooses its form. Hits are made distinct before their shuffle.
    """
    items = items.withColumn("n_words", F.size("words")).where(F.col("n_words") >= LEAST_WORDS)
    numbered = dict(enumerate(masks + SHORT_MASKS))
    short = F.col("n_words") < SHORT_ITEM_WORDS
    used = items.agg(F.coalesce(F.bool_or(short), F.lit(False)), F.coalesce(F.bool_or(~short), F.lit(False))).first()
    parts = [(items.where(short), {n: m for n, m in numbered.items() if n >= len(masks)}, used[0]),
             (items.where(~short), {n: m for n, m in numbered.items() if n < len(masks)}, used[1])]
    # Texts are only asked for the masks that some item has.
    parts = [(part, own) for part, own, met in parts if met] or [(items, numbered)]
    seeds = [exploded_seeds(part, own, "item_id", "n_words") for part, own in parts]
    asked = stage(reduce(DataFrame.unionByName, seeds).distinct(), "benchmark-seeds")
    bits = seed_bits(asked).scalar()
    masks = {n: m for _, own in parts for n, m in own.items()}
    told = exploded_seeds(docs, masks, "doc_id").withColumnRenamed("at", "doc_at")
    told = told.where(may_be_asked(F.col("seed"), bits))
    shift = (F.col("doc_at") - F.col("at")).alias("shift")
    return (
        told.join(asked, "seed")
        .groupBy("doc_id", "item_id", "n_words", shift)
        .agg(F.lit(1))
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("item_id", "n_words", "shift")).alias("hits"))
    )


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    masks: tuple[str, ...] = MASKS,
    overlap_words: int = OVERLAP_WORDS,
    overlap_percent: int = OVERLAP_PERCENT,
) -> DataFrame:
    """Verified overlaps: ``doc_id``, ``item_id``, ``matched``, ``compared``, ``doc_start``.

    One row for each document and item. A hit of a seed lays the item over the
    text; the words in that position are compared one by one, and the pair is
    kept if in some stretch of ``overlap_words`` words (the whole item, if it is
    shorter) at least ``overlap_percent`` of the words agree. Words of the item that
    lie before or behind the document count as different. ``matched`` of
    ``compared`` words agree in the best stretch; the first such stretch begins at
    the document's word ``doc_start``, or before it at word 0.

    Items of fewer than ``SHORT_ITEM_WORDS`` words have lighter seeds of their own,
    which miss none of their accepted overlaps. Null and empty texts and items have
    no words and match nothing, nor do items of fewer than ``LEAST_WORDS`` words,
    which any text may hold by chance. Rows that share a ``doc_id`` (null included)
    share their overlaps, as do items that share an id; repeated rows change
    nothing; empty tables give no rows; other columns are not read. Hits and
    seeds are written when this is called. Texts are read whole, twice: the
    second time those with hits only are compared.
    """
    rows = pick(docs, doc_id=id, text=text)
    texts = rows.select("doc_id", words_of(F.col("text")).alias("words"))
    items = pick(benchmark, item_id=item_id, text=item_text).distinct()
    items = items.select("item_id", words_of(F.col("text")).alias("words"))
    hits = stage(seed_hits(texts, items, masks), "benchmark-hits")
    hits = hits.withColumnRenamed("doc_id", "hit_id")
    laid = rows.join(hits, F.col("doc_id").eqNullSafe(F.col("hit_id"))).select(
        "doc_id", "hits", words_of(F.col("text")).alias("words")
    )

    def position(hit: Column) -> Column:
        first = F.greatest(F.lit(0), hit["shift"])
        last = F.least(F.size("words"), hit["shift"] + hit["n_words"])
        return F.struct(
            hit["item_id"].alias("item_id"),
            first.alias("doc_first"),
            (first - hit["shift"]).alias("item_first"),
            F.slice("words", first + 1, F.greatest(last - first, F.lit(0))).alias("told"),
        )

    laid = laid.select("doc_id", F.explode(F.transform("hits", position)).alias("hit"))
    laid = laid.select("doc_id", "hit.*").join(items.withColumnRenamed("words", "asked"), "item_id")
    agree = F.transform(
        "told",
        lambda word, i: (word == F.get("asked", i + F.col("item_first"))).cast("int"),
    )
    outside = F.lit(0)
    behind = F.size("asked") - F.col("item_first") - F.size("told")
    agree = F.concat(
        F.array_repeat(outside, F.col("item_first")), agree, F.array_repeat(outside, behind)
    )
    needed = F.least(F.lit(overlap_words), F.size("asked"))
    shift = F.col("doc_first") - F.col("item_first")
    laid = laid.select(
        "doc_id", "item_id", shift.alias("shift"), needed.alias("compared"), agree.alias("agree")
    ).where("compared > 0")
    sums = F.transform(
        F.sequence(F.lit(0), F.size("agree") - F.col("compared")),
        lambda i: F.aggregate(
            F.slice("agree", i + 1, F.col("compared")),
            F.lit(0),
            lambda total, one: total + F.coalesce(one, F.lit(0)),
        ),
    )
    best = laid.withColumn("sums", sums).withColumn("matched", F.array_max("sums"))
    best = best.where(F.col("matched") * 100 >= F.col("compared") * overlap_percent)
    begun = F.col("shift") + F.array_position("sums", F.col("matched")).cast("int") - 1
    start = F.greatest(F.lit(0), begun)
    return (
        best.select("doc_id", "item_id", "matched", "compared", start.alias("doc_start"))
        .groupBy("doc_id", "item_id")
        .agg(
            F.max(F.struct("matched", "compared", (-F.col("doc_start")).alias("s"))).alias("best")
        )
        .select(
            "doc_id", "item_id", "best.matched", "best.compared", (-F.col("best.s")).alias("doc_start")
        )
    )


def remove_contaminated(
    docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` without any verified overlap, with all their columns."""
    found = overlaps(docs, benchmark, id, text).select(F.col("doc_id").alias("_found")).distinct()
    found = stage(found, "contaminated")
    clean = by_place(docs).join(found, place(docs, id).eqNullSafe(F.col("_found")), "left_anti")
    return clean.toDF(*docs.columns)


def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def _sql_seeds(rows: str, keys: str, of_items: bool = False) -> str:
    """Seeds of a SQL relation of ``keys`` and ``words``, as strings instead of hashes."""
    each = []
    for number, mask in enumerate(MASKS + SHORT_MASKS):
        taken = " || ' ' || ".join(f"words[i + {k}]" for k, bit in enumerate(mask) if bit == "1")
        size = f"len(words) >= {SHORT_ITEM_WORDS}"
        if mask in SHORT_MASKS:
            size = f"len(words) < {SHORT_ITEM_WORDS} and len(words) >= {LEAST_WORDS}"
        where = f" where {size}" if of_items else ""
        each.append(
            f"select {keys}, i - 1 as place, '{number} ' || {taken} as seed from "
            f"(select {keys}, words, unnest(range(1, len(words) - {len(mask)} + 2)) as i from {rows}{where})"
        )
    return " union all ".join(each)


_SQL_WORDS = "regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+')"
ORACLE = f"""
with doc_words as (select doc_id, {_SQL_WORDS} as words from documents),
item_words as (select item_id, {_SQL_WORDS} as words from (select distinct item_id, text from benchmark)),
told as ({_sql_seeds("doc_words", "doc_id")}),
asked as ({_sql_seeds("item_words", "item_id", of_items=True)}),
hits as (
  select distinct doc_id, item_id, told.place - asked.place as shift
  from told join asked using (seed)
),
compared as (
  select doc_id, item_id, shift, least({OVERLAP_WORDS}, len(i.words)) as compared,
    [case when k >= 0 and k < len(d.words) and d.words[k + 1] = i.words[k - shift + 1] then 1 else 0 end
     for k in range(shift, shift + len(i.words))] as agree
  from hits join doc_words d using (doc_id) join item_words i using (item_id)
),
sums as (
  select doc_id, item_id, shift, compared,
    [list_sum(agree[s : s + compared - 1]) for s in range(1, len(agree) - compared + 2)] as sums
  from compared
),
best as (
  select doc_id, item_id, compared, list_max(sums) as matched,
    greatest(0, shift + list_position(sums, list_max(sums)) - 1) as doc_start
  from sums
),
ranked as (
  select *, row_number() over (
    partition by doc_id, item_id order by matched desc, compared desc, doc_start) as nth
  from best where matched * 100 >= compared * {OVERLAP_PERCENT}
)
select doc_id, item_id, matched::int as matched, compared::int as compared,
  doc_start::int as doc_start
from ranked where nth = 1
"""
