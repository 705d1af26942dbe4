"""Line deduplication by pairwise alignment (operator 1).

Documents that share lines are aligned two by two with a patience diff, and the
blocks that the alignment has in common are deleted from the later one.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from loanlake.llm.common import by_place, map_batches, pick, place, positions, slices, table
from loanlake.session import stage

#: A line of at most so many documents leads to all of its earlier documents at once.
RARE = 4
#: Words that a run of aligned lines needs to be deleted.
MIN_WORDS = 20
#: Holders of a window's rarest line that are looked at in the first round, and by what
#: factor their number grows.
FIRST_HOLDERS = 16
MORE_HOLDERS = 4
#: Windows that one row of a document is asked for.
GROUP_WINDOWS = 512


def longest_rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest chain of pairs that rises in both places; ``pairs`` are sorted by the first."""
    tops: list[int] = []
    piles: list[int] = []
    below: list[int] = []
    for i, (_, there) in enumerate(pairs):
        pile = bisect_left(tops, there)
        if pile == len(tops):
            tops.append(there)
            piles.append(i)
        else:
            tops[pile] = there
            piles[pile] = i
        below.append(piles[pile - 1] if pile else -1)
    chain = []
    i = piles[-1] if piles else -1
    while i >= 0:
        chain.append(pairs[i])
        i = below[i]
    return chain[::-1]


def patience(here: dict[int, int], there: dict[int, int]) -> set[int]:
    """Places of this document that a patience diff aligns with the other one.

    Both map a place to the line there, for the lines that the two share.
    Lines that occur once on either side are matched first, as far as they keep
    their order; the stretches between two matches are aligned in the same way,
    and lines next to a match that are equal on both sides are matched as well.
    """
    aligned: set[int] = set()
    places_here, places_there = sorted(here), sorted(there)
    work = [(0, len(places_here), 0, len(places_there))]
    while work:
        a, b, c, d = work.pop()
        while a < b and c < d and here[places_here[a]] == there[places_there[c]]:
            aligned.add(places_here[a])
            a, c = a + 1, c + 1
        while a < b and c < d and here[places_here[b - 1]] == there[places_there[d - 1]]:
            aligned.add(places_here[b - 1])
            b, d = b - 1, d - 1
        if a >= b or c >= d:
            continue
        once: dict[int, list[list[int]]] = defaultdict(lambda: [[], []])
        for i in range(a, b):
            once[here[places_here[i]]][0].append(i)
        for i in range(c, d):
            once[there[places_there[i]]][1].append(i)
        unique = sorted((x[0], y[0]) for x, y in once.values() if len(x) == 1 and len(y) == 1)
        chain = longest_rising(unique)
        if not chain:
            continue
        for (i, j), (k, m) in zip([(a - 1, c - 1), *chain], [*chain, (b, d)], strict=True):
            if k < b:
                aligned.add(places_here[k])
            work.append((i + 1, k, j + 1, m))
    return aligned


def runs_to_delete(words: list[int], aligned: set[int], min_words: int) -> list[tuple[int, int]]:
    """Runs of aligned lines (first, last) with at least ``min_words`` words.

    ``words`` are the words of each line; lines without a word neither break a
    run nor begin or end one.
    """
    runs: list[tuple[int, int, int]] = []
    run: tuple[int, int, int] | None = None
    for at, size in enumerate(words):
        if at in aligned:
            run = (run[0], at, run[2] + size) if run else (at, at, size)
        elif size and run:
            runs.append(run)
            run = None
    if run:
        runs.append(run)
    return [(first, last) for first, last, size in runs if size >= min_words]


def document_lines(docs: DataFrame) -> DataFrame:
    """``doc`` (id and text hash) and its lines with a word: ``places``, ``words``, ``lines`` (128-bit hashes)."""
    kind = docs.schema["id"].dataType.simpleString()
    names = ["doc", "places", "words", "lines"]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in slices(batches):
            places, words, lines = [], [], []
            for text in batch.column("text").to_pylist():
                found = [
                    (at, line)
                    for at, line in enumerate((text or "").split("\n"))
                    if line and not line.isspace()
                ]
                places.append([at for at, _ in found])
                words.append([len(line.split()) for _, line in found])
                lines.append([xxhash.xxh3_128_digest(line.encode()) for _, line in found])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"),
                    pa.array(places, pa.list_(pa.int32())),
                    pa.array(words, pa.list_(pa.int32())),
                    pa.array(lines, pa.list_(pa.binary())),
                ],
                names=names,
            )

    rows = docs.select(F.struct("id", "text_hash").alias("doc"), "text")
    found = map_batches(
        rows,
        split,
        f"doc struct<id:{kind},text_hash:bigint>, places array<int>, words array<int>, lines array<binary>",
    )
    return found.dropDuplicates(["doc"])


def windows_of(words: list[int], frequent: list[bool], min_words: int) -> list[tuple[int, int]]:
    """Least runs (first, last) of frequent lines around each line that have ``min_words`` words.

    Any run with so many words that holds a line holds one of the line's windows.
    """
    found = set()
    for start, end in frequent_runs(frequent):
        for here in range(start, end):
            found.update(windows_around(words, start, end, here, here, min_words))
    return sorted(found)


def frequent_runs(frequent: list[bool]) -> Iterator[tuple[int, int]]:
    """Begin and end of every run of frequent lines."""
    start = 0
    for at, often in enumerate([*frequent, False]):
        if not often:
            if start < at:
                yield start, at
            start = at + 1


def windows_around(
    words: list[int], start: int, end: int, low: int, high: int, min_words: int
) -> Iterator[tuple[int, int]]:
    """Least runs from ``start`` to ``end`` that hold the lines ``low`` to ``high`` and have enough words."""
    last, size = high, sum(words[low : high + 1])
    while size < min_words and last + 1 < end:
        last += 1
        size += words[last]
    first, before = low, None
    while True:
        while last > high and size - words[last] >= min_words:
            size -= words[last]
            last -= 1
        if size >= min_words and last != before:
            yield first, last
            before = last
        if first == start or (size >= min_words and last == high):
            break
        first -= 1
        size += words[first]


def searched_windows(
    places: list[int], words: list[int], frequent: list[bool], min_words: int
) -> Iterator[tuple[int, int, list[int]]]:
    """Windows (first, last) with the places that they may delete.

    Those around a line may delete their lines; those around a gap, that is lines
    without a word between two frequent ones, delete the gap, as only a run that
    holds both neighbours does.
    """
    for a, b in windows_of(words, frequent, min_words):
        yield a, b, places[a : b + 1]
    for start, end in frequent_runs(frequent):
        for here in range(start, end - 1):
            gap = list(range(places[here] + 1, places[here + 1]))
            if gap:
                for a, b in windows_around(words, start, end, here, here + 1, min_words):
                    yield a, b, gap


def shared_documents(lines: DataFrame, shared: DataFrame, rare: int, min_words: int) -> DataFrame:
    """Documents that share lines, with the ``windows`` of their frequent lines.

    ``lines`` are empty where no other document has the line. ``kind`` is a hash
    of the shared lines in order: documents of one kind align alike with any other.
    """
    schema = lines.schema["doc"].dataType.simpleString()
    window = pa.struct(
        [
            ("window", pa.binary()),
            ("rarest", pa.binary()),
            ("inside", pa.list_(pa.binary())),
            ("at", pa.list_(pa.int32())),
        ]
    )
    known = shared.groupBy("doc").agg(F.collect_list(F.struct("line", "holders")).alias("known"))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in slices(batches):
            kept, kinds, windows = [], [], []
            for places, words, own, known in zip(
                *[batch.column(name).to_pylist() for name in ("places", "words", "lines", "known")],
                strict=True,
            ):
                holders = {one["line"]: one["holders"] for one in known}
                kept.append([line if line in holders else b"" for line in own])
                kinds.append(xxhash.xxh3_128_digest(b"".join(kept[-1])))
                found = []
                frequent = [holders.get(line, 0) > rare for line in own]
                for a, b, at in searched_windows(places, words, frequent, min_words):
                    inside = own[a : b + 1]
                    found.append(
                        {
                            "window": xxhash.xxh3_128_digest(b"".join(inside)),
                            "rarest": min(inside, key=lambda line: (holders[line], line)),
                            "inside": inside,
                            "at": at,
                        }
                    )
                windows.append(found)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(name) for name in ("doc", "places", "words")],
                    pa.array(kept, pa.list_(pa.binary())),
                    pa.array(kinds, pa.binary()),
                    pa.array(windows, pa.list_(window)),
                ],
                names=["doc", "places", "words", "lines", "kind", "windows"],
            )

    return map_batches(
        lines.join(known, "doc"),
        mark,
        f"doc {schema}, places array<int>, words array<int>, lines array<binary>, kind binary, "
        "windows array<struct<window:binary,rarest:binary,inside:array<binary>,at:array<int>>>",
    )


def window_holders(windows: DataFrame, holding: DataFrame, documents: DataFrame) -> DataFrame:
    """``window`` and, of each kind of documents with its lines in order, the earliest as ``other``.

    ``windows`` have ``window``, ``rarest`` and ``inside``; ``holding`` tells which
    documents are looked at for a rarest line, at ``pos`` among its holders, so that
    documents that have other lines between are found as well. A document meets its
    likely windows in groups of bounded size.
    """
    likely = stage(
        windows.join(holding, F.col("rarest") == F.col("line")).where("pos < furthest")
        .select("window", "inside", "doc"),
        "likely-windows",
    )
    groups = likely.groupBy("doc").agg(F.ceil(F.count("*") / GROUP_WINDOWS).alias("_groups"))
    salted = likely.join(groups, "doc").withColumn(
        "_group", F.pmod(F.xxhash64("window"), F.col("_groups"))
    )
    salted = salted.groupBy("doc", "_group").agg(
        F.collect_list(F.struct("window", "inside")).alias("likely")
    )
    schema = documents.schema["doc"].dataType.simpleString()

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 16):
            row, windows = [], []
            for one, (lines, likely) in enumerate(
                zip(batch.column("lines").to_pylist(), batch.column("likely").to_pylist(), strict=True)
            ):
                places: dict[bytes, list[int]] = defaultdict(list)
                for at, line in enumerate(lines):
                    places[line].append(at)
                for each in likely:
                    last = -1
                    for line in each["inside"]:
                        at = places.get(line, [])
                        after = bisect_left(at, last + 1)
                        if after == len(at):
                            break
                        last = at[after]
                    else:
                        row.append(one)
                        windows.append(each["window"])
            taken = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(windows, pa.binary()),
                    batch.column("kind").take(taken),
                    batch.column("doc").take(taken),
                ],
                names=["window", "kind", "doc"],
            )

    asked = salted.join(documents.select("doc", "lines", "kind"), "doc").drop("_group")
    held = map_batches(asked, hold, f"window binary, kind binary, doc {schema}")
    return held.groupBy("window", "kind").agg(F.min("doc").alias("other")).drop("kind")


def deleted_by(pairs: DataFrame, documents: DataFrame, min_words: int) -> DataFrame:
    """``doc`` and the places (``gone``) of the blocks that it has in common with its ``other`` ones.

    Every pair is aligned on all lines that the two share, and only runs with
    enough words within one pair count.
    """
    schema = documents.schema["doc"].dataType.simpleString()
    other = documents.select(F.col("doc").alias("other"), F.col("lines").alias("other_lines"))
    rows = pairs.join(documents.select("doc", "places", "words", "lines"), "doc").join(other, "other")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            gone = []
            for places, words, own, others in zip(
                *[batch.column(name).to_pylist() for name in ("places", "words", "lines", "other_lines")],
                strict=True,
            ):
                both = (set(own) & set(others)) - {b""}
                aligned = patience(
                    {at: line for at, line in enumerate(own) if line in both},
                    {at: line for at, line in enumerate(others) if line in both},
                )
                runs = runs_to_delete(words, aligned, min_words)
                gone.append([at for a, b in runs for at in range(places[a], places[b] + 1)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(gone, pa.list_(pa.int32()))], names=["doc", "gone"]
            )

    both_lines = rows.select("doc", "places", "words", "lines", "other_lines")
    found = map_batches(both_lines, align, f"doc {schema}, gone array<int>")
    return (
        found.where(F.size("gone") > 0)
        .groupBy("doc")
        .agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone"))
    )


def united(parts: list[DataFrame]) -> DataFrame:
    """``doc`` and all its deleted places of several rounds."""
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("doc")
        .agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone"))
    )


def repeated_lines(docs: DataFrame, rare: int, min_words: int) -> DataFrame:
    """``doc`` and the places (``gone``) of the blocks that any earlier document has as well.

    The result is that of aligning every document with all earlier ones; only
    pairs that can add nothing are left out. Documents that share a line of at
    most ``rare`` documents are all aligned. Other pairs share frequent lines
    alone, and can delete a line only if the earlier one has a window around it
    (``windows_of``).

    Holders of a window are looked for in rounds, among ever more of the holders of
    its rarest line, earliest first. In a round a document is aligned with the
    earliest holder that was found of each of its windows, then, for windows with a
    line still there, with the earliest of every kind of holders. Windows of which
    nothing is left, and those whose own document the round has reached, leave the
    search, so that it ends early unless many documents have a long frequent passage
    that all their earlier ones have in another order.
    """
    lines = stage(document_lines(docs), "lines")
    held = lines.select("doc", F.explode(F.array_distinct("lines")).alias("line"))
    keys = held.groupBy("line").agg(F.count("*").alias("holders")).where("holders > 1")
    shared = stage(held.join(stage(keys, "line-holders"), "line"), "shared-lines")
    documents = stage(shared_documents(lines, shared, rare, min_words), "shared-documents")

    few = shared.where(F.col("holders") <= rare)
    others = few.select(F.col("line").alias("_line"), F.col("doc").alias("other"))
    met = few.join(others, (F.col("line") == F.col("_line")) & (F.col("doc") > F.col("other")))
    done = [stage(met.select("doc", "other").distinct(), "line-pairs")]
    gone = [stage(deleted_by(done[0], documents, min_words), "deleted-lines")]

    frequent = shared.where(F.col("holders") > rare).select("line", "doc")
    holding = stage(positions(frequent, "line", "doc", "frequent-lines"), "line-positions")
    own = holding.select(F.col("line").alias("rarest"), "doc", "pos")
    found = documents.select("doc", F.inline("windows")).join(own, ["rarest", "doc"])
    active = stage(found.where("pos > 0"), "line-windows")

    def still_there(some: DataFrame) -> DataFrame:
        none = F.array().cast("array<int>")
        left = some.join(united(gone), "doc", "left")
        left = left.where(F.size(F.array_except("at", F.coalesce("gone", none))) > 0)
        return left.drop("gone")

    def align(pairs: DataFrame) -> None:
        pairs = pairs.where(F.col("doc") > F.col("other")).select("doc", "other").distinct()
        known = reduce(DataFrame.unionByName, done)
        done.append(stage(pairs.join(known, ["doc", "other"], "left_anti"), "line-pairs"))
        gone.append(stage(deleted_by(done[-1], documents, min_words), "deleted-lines"))

    first, last = 0, FIRST_HOLDERS
    active = stage(still_there(active), "windows-left")
    while not active.isEmpty():
        asked = active.groupBy("window").agg(
            F.min("rarest").alias("rarest"),
            F.min("inside").alias("inside"),
            F.max("pos").alias("furthest"),
        )
        looked = holding.where((F.col("pos") >= first) & (F.col("pos") < last))
        holders = stage(window_holders(asked, looked, documents), "window-holders")
        firsts = holders.groupBy("window").agg(F.min("other").alias("other"))
        align(active.select("doc", "window").join(firsts, "window"))
        left = stage(still_there(active), "windows-left")
        align(left.select("doc", "window").join(holders, "window"))
        active = stage(still_there(left.where(F.col("pos") > last)), "windows-left")
        first, last = last, last * MORE_HOLDERS
    return united(gone)


def delete_repeats(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    rare: int = RARE,
    min_words: int = MIN_WORDS,
    deleted: str | None = None,
) -> DataFrame:
    """``docs`` without the blocks of lines that an earlier document already has.

    A document is later than another if its id is larger, or, with equal ids, the
    hash of its text. Two documents that share lines are aligned by ``patience``;
    lines of the later one that are aligned with one earlier document and stand
    together form a block, and a block of at least ``min_words`` words is deleted
    with its line breaks. Shorter shared lines stay. ``rare`` changes the work,
    not the result (``repeated_lines``). ``deleted`` names an additional column
    for the number of deleted lines.

    Null texts stay null and texts without words stay as they are; null ids count
    as the earliest; rows that repeat an id and a text are one document and keep
    the same text; an empty table gives no rows; all other columns are kept,
    whatever their names. A document whose every line is deleted keeps its row
    with an empty text. Lines and their places are written when this is called.
    """
    texts = pick(docs, id=id, text=text)
    texts = texts.select("id", F.xxhash64("text").alias("text_hash"), "text")
    gone = stage(repeated_lines(texts, rare, min_words), "repeated-lines").select(
        F.col("doc.id").alias("_id"), F.col("doc.text_hash").alias("_hash"), F.col("gone").alias("_gone")
    )
    rows = by_place(docs)
    places_of = rows.columns
    own = places_of[docs.columns.index(text)]
    # The same join at every size: what is deleted grows with the documents.
    joined = rows.join(
        gone.hint("merge"),
        place(docs, id).eqNullSafe(F.col("_id")) & (F.xxhash64(own) == F.col("_hash")),
        "left",
    ).drop("_id", "_hash")

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, counts = [], []
            for one, places in zip(
                batch.column(own).to_pylist(), batch.column("_gone").to_pylist(), strict=True
            ):
                gone = set(places or ())
                if gone:
                    one = "\n".join(line for at, line in enumerate(one.split("\n")) if at not in gone)
                texts.append(one)
                counts.append(len(gone))
            columns = {name: batch.column(name) for name in places_of}
            columns[own] = pa.array(texts, batch.schema.field(own).type)
            if deleted:
                columns["_deleted"] = pa.array(counts, pa.int32())
            yield pa.RecordBatch.from_pydict(columns)

    counted = [StructField("_deleted", IntegerType())] if deleted else []
    schema = StructType([*rows.schema.fields, *counted])
    names = [*docs.columns, deleted] if deleted else docs.columns
    return map_batches(joined, shorten, schema).toDF(*names)


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return delete_repeats(docs, deleted="deleted_lines")
