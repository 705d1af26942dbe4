"""Best-fit packing planned on a histogram of lengths (operator 8)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlake.llm.common import by_bytes, map_batches, pick, rank_within, table
from loanlake.llm.tokens import encoder, text_list, tokenizer_path
from loanlake.session import stage

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
CAPACITY = 1024
#: Bytes of text that are encoded at a time.
BATCH_BYTES = 1 << 17


def id_bytes(ids: list[int]) -> bytes:
    """Token ids as little-endian unsigned 32-bit numbers."""
    return np.array(ids, "<u4").tobytes()


def short_id_bytes(ids: list[int]) -> bytes:
    """Token ids below 65,536 as little-endian unsigned 16-bit numbers."""
    return np.array(ids, "<u2").tobytes()


def wide_ids(ids: pa.Array) -> pa.Array:
    """Ids of 16 bits, as ``short_id_bytes`` writes them, with 32 bits; no nulls."""
    _, offsets, data = ids.buffers()
    ends = np.frombuffer(offsets, np.int32)[ids.offset : ids.offset + len(ids) + 1]
    wide = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].view("<u2").astype("<u4")
    moved = pa.py_buffer(((ends - ends[0]) * 2).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(ids), [None, moved, pa.py_buffer(wide)])


def widened(pieces: DataFrame) -> DataFrame:
    """Pieces whose ``ids`` have 16 bits with the same ids in 32 bits."""

    def widen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("ids")
            yield batch.set_column(at, "ids", wide_ids(batch.column(at)))

    return map_batches(pieces, widen, pieces.schema)


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of each piece: whole capacities, but for a shorter first piece."""
    first = length % capacity or min(length, capacity)
    starts = [0, *range(first, length, capacity)]
    return list(zip(starts, [b - a for a, b in zip(starts, [*starts[1:], length], strict=True)], strict=True))


def tokenised_pieces(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
    capacity: int = CAPACITY,
    short: bool = False,
) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length`` and ``ids`` of every piece of every row.

    A document is its token ids and ``end_id``; only a longer one than
    ``capacity`` is cut. ``ids`` are little-endian 32-bit numbers in binary, or, if
    ``short``, 16-bit ones, for vocabularies and ends below 65,536. Texts are encoded
    in batches of equal bytes; one without a safe cut is encoded whole and takes
    memory in proportion to its length. No shuffle. A null or empty text is a document of ``end_id`` alone, a null id
    stays null, repeated rows give repeated pieces, other columns are not read.
    """
    rows = pick(docs, doc_id=id, text=text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids"]

    keep, width = (short_id_bytes, 2) if short else (id_bytes, 4)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces_of = encoder(tokenizer_path(tokenizer), keep)
        end = keep([end_id])

        def output(batch: pa.RecordBatch, found: list[tuple[int, bytes]]) -> pa.RecordBatch:
            row, number, start, length, ids = [], [], [], [], []
            for one, tokens in found:
                for piece, (begin, size) in enumerate(cut(len(tokens) // width, capacity)):
                    row.append(one)
                    number.append(piece)
                    start.append(begin)
                    length.append(size)
                    ids.append(tokens[width * begin : width * (begin + size)])
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row, pa.int64())),
                    pa.array(number, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                names=names,
            )

        for batch in by_bytes(batches, "text", BATCH_BYTES):
            done: list[tuple[int, bytes]] = []
            held, current = [], 0
            for number, kept in pieces_of.encode(text_list(batch.column("text"))):
                if number != current:
                    done.append((current, b"".join([*held, end])))
                    held, current = [], number
                held.extend(kept)
            if batch.num_rows:
                done.append((current, b"".join([*held, end])))
            yield output(batch, done)

    return map_batches(
        rows, encoded, f"doc_id {kind}, piece int, start long, length long, ids binary"
    )


def plan_slots(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts of lengths, not over pieces.

    Returns runs ``(length, first_rank, items, sequence, sequences, offset)``: the
    ``items`` pieces of ``length`` that have ranks from ``first_rank`` on are dealt
    in turn to ``sequences`` sequences from ``sequence`` on, the first round at
    ``offset`` and each later one ``length`` further. Sequences with the same
    content are one group. Each length, longest first, goes to the groups with
    the least sufficient space, as best fit would place its pieces one by one; it
    splits at most one group that exists and leaves at most two new ones, so the
    plan has at most about ``capacity`` squared runs whatever the counts.
    """
    runs = []
    open_groups: dict[int, list[tuple[int, int, int]]] = {}
    next_sequence = 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        spaces = sorted(space for space in open_groups if space >= length)
        while left:
            if spaces:
                space = spaces[0]
                sequence, sequences, used = open_groups[space].pop()
                if not open_groups[space]:
                    del open_groups[space]
                    spaces.pop(0)
            else:
                space, used = capacity, 0
                sequences = -(-left // (capacity // length))
                sequence = next_sequence
                next_sequence += sequences
            each = space // length
            full = min(sequences, left // each)
            filled = [(full, full * each)] if full else []
            if full < sequences and full * each < left:
                filled.append((1, left - full * each))
            for number, items in filled:
                runs.append((length, rank, items, sequence, number, used))
                per_sequence = items // number
                rest = space - per_sequence * length
                if rest:
                    open_groups.setdefault(rest, []).append(
                        (sequence, number, used + per_sequence * length)
                    )
                rank += items
                left -= items
                sequence += number
                sequences -= number
            if sequences:
                open_groups.setdefault(space, []).append((sequence, sequences, used))
    return runs


def pack(
    pieces: DataFrame, order: list[str], capacity: int = CAPACITY, short: str | None = None
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of 1 to ``capacity`` tokens in ``length``.

    Only the histogram, at most ``capacity`` counts, reaches the driver, and only
    the plan made from it goes to the tasks. Pieces then take the planned slots by
    their rank within their length, which ``rank_within`` spreads over tasks, so
    that a length which a third of all pieces have is no hot spot. ``order`` names
    columns that tell pieces apart; any other columns are carried along. The column
    ``short`` names, if any, has ids of 16 bits and gets them with 32: in the step that
    tells the slots, since a task needs a Python worker for each step in Python, and
    the workers stay with what they have loaded. Give a staged frame: it is read four
    times.
    """
    histogram = {
        row["length"]: row["n"]
        for row in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()
    }
    runs = np.array(plan_slots(histogram, capacity), dtype=np.int64).reshape(-1, 6)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    longest = max(histogram.values(), default=0) + 1
    keys = runs[:, 0] * longest + runs[:, 1]

    def slot(*given: pa.Array) -> pa.Array:
        length, rank = (column.to_numpy() for column in given[:2])
        run = runs[np.searchsorted(keys, length * longest + rank, side="right") - 1]
        within = rank - run[:, 1]
        found = {
            "sequence_id": pa.array(run[:, 3] + within % run[:, 4]),
            "offset": pa.array(run[:, 5] + within // run[:, 4] * run[:, 0]),
        }
        if len(given) > 2:
            found["ids"] = wide_ids(given[2])
        return pa.StructArray.from_arrays(list(found.values()), names=list(found))

    ranked = rank_within(pieces, "length", order)
    keyed = [F.col("length").cast("long"), F.col("rank")]
    if short is None:
        own = [F.col(name) for name in pieces.columns]
        slots = F.arrow_udf(slot, "sequence_id long, offset long")(*keyed)
    else:
        own = [F.col("_slot.ids").alias(name) if name == short else F.col(name) for name in pieces.columns]
        slots = F.arrow_udf(slot, "sequence_id long, offset long, ids binary")(*keyed, F.col(short))
    return ranked.withColumn("_slot", slots).select(*own, "_slot.sequence_id", "_slot.offset")


def packed_documents(docs: DataFrame, name: str = "pieces") -> DataFrame:
    """Placed pieces of all documents with their ``ids``, from which ``sequences`` are built.

    Null and empty texts are documents of one token; an empty table gives no
    rows; repeated rows are packed each. The pieces are written when this is
    called, so texts are encoded once. They are written and shuffled with ids of 16
    bits, as the vocabulary has fewer than 65,536, and get their 32 bits at the end.
    Ranks need only a checksum of the ids.
    """
    pieces = tokenised_pieces(docs, short=True).withColumn("_tie", F.crc32("ids"))
    return pack(stage(pieces, name), ["doc_id", "piece", "_tie"], short="ids").drop("_tie")


def sequences(placed: DataFrame) -> DataFrame:
    """``sequence_id``, the concatenated ``ids`` and the ``doc_ids`` of placed pieces with ids."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    return (
        placed.groupBy("sequence_id")
        .agg(inside.alias("inside"))
        .select(
            "sequence_id",
            F.aggregate(
                "inside", F.lit(b"").cast("binary"), lambda ids, one: F.concat(ids, one["ids"])
            ).alias("ids"),
            F.transform("inside", lambda one: one["doc_id"]).alias("doc_ids"),
        )
    )


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    placed = packed_documents(table(spark, folder, "documents"))
    return placed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
