"""SimHash near-duplicates by a self-join of binary tries (operator 5)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlake.llm.common import by_place, map_batches, pick, place, slices, table
from loanlake.llm.components import components
from loanlake.session import stage

SHINGLE = 4
MAX_BITS = 4
SEED = 42
BITS = 64
#: Shingles whose bits are counted at a time.
CHUNK = 1 << 15
#: Depths of the trie at which node pairs are compared.
DEPTHS = (12, 19, 25, 38, 64)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of a text's shingles; 0 for a text without words."""
    words = text.lower().split()
    if not words:
        return 0
    count = max(1, len(words) - shingle + 1)
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, count, CHUNK):
        stop = min(count, start + CHUNK)
        hashes = np.fromiter(
            (xxhash.xxh64_intdigest(b" ".join(words[i : i + shingle]), SEED) for i in range(start, stop)),
            dtype=np.uint64,
            count=stop - start,
        )
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big", signed=True)


def fingerprints(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """``doc_id``, ``text_hash`` and the signed ``fp`` of every row; no shuffle."""
    rows = pick(docs, doc_id=id, text=text)
    rows = rows.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [fingerprint(one.as_py(), shingle) for one in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(found, pa.int64())],
                names=["doc_id", "text_hash", "fp"],
            )

    return map_batches(rows, hashed, f"doc_id {kind}, text_hash long, fp long")


def rotated(fp: Column, by: Column | int) -> Column:
    """``fp`` with its bits turned ``by`` places to the left."""
    by = F.lit(by) if isinstance(by, int) else by
    left = F.call_function("shiftleft", fp, by)
    right = F.call_function("shiftrightunsigned", fp, F.lit(BITS) - by)
    return left.bitwiseOR(right)


def block_starts(blocks: int) -> list[int]:
    """First bits of ``blocks`` blocks that are equal but for the last, shorter ones."""
    size, longer = divmod(BITS, blocks)
    return [i * size + min(i, longer) for i in range(blocks)]


def budget(start: int, depth: int, blocks: int, max_bits: int) -> int:
    """Differing bits allowed in the first ``depth`` bits of a trie that begins at ``start``.

    Take two fingerprints that differ in at most ``max_bits`` bits and go round
    their ``blocks`` blocks. From at least one of the blocks on, the differing
    bits of the next j blocks are never more than j * max_bits / blocks, for every
    j. So one trie for each first block, pruned by that budget, finds every pair.
    """
    starts = block_starts(blocks)
    ends = [(begin - start) % BITS for begin in starts if begin != start] + [BITS]
    covered = sum(end < depth for end in sorted(ends)) + 1
    return covered * max_bits // blocks


def trie_level(leaves: DataFrame, depth: int) -> DataFrame:
    """Nodes of all tries at ``depth``: leaves below each, and the leaf if it is the only one."""
    node = F.call_function("shiftrightunsigned", "leaf", F.lit(BITS - depth))
    return leaves.groupBy("start", node.alias("node")).agg(
        F.count("*").alias("n"), F.min("leaf").alias("leaf")
    )


def close_pairs(
    fps: DataFrame, max_bits: int = MAX_BITS, depths: tuple[int, ...] = DEPTHS
) -> DataFrame:
    """All pairs ``u``, ``v`` of distinct fingerprints that differ in ``max_bits`` bits or fewer.

    ``fps`` has one column ``fp`` without repeats. ``max_bits`` + 1 tries begin at
    different bits (see ``budget``). Pairs of nodes go down the tries together:
    the pairs of a level are joined with the children of either node, the bits in
    which the children differ are added up, and a pair over budget is pruned. A
    pair of nodes with one leaf each is compared at once, and a node with one
    leaf is not paired with itself. A node has no more children than its depth
    step allows, so no key of these joins is hot, whatever the texts.
    """
    blocks = max_bits + 1
    starts = block_starts(blocks)
    shortest = min(BITS - starts[-1], starts[1] if blocks > 1 else BITS)
    depths = (min(shortest, depths[0]), *depths[1:])
    leaves = fps.select(F.explode(F.array(*map(F.lit, starts))).alias("start"), "fp")
    leaves = stage(leaves.select("start", rotated(F.col("fp"), F.col("start")).alias("leaf")), "trie")
    roots = trie_level(leaves, depths[0]).where("n > 1")
    frontier = roots.select(
        "start", F.col("node").alias("a"), F.col("node").alias("b"), F.lit(0).alias("differing")
    )
    found = []
    for above, depth in zip(depths, depths[1:], strict=False):
        level = trie_level(leaves, depth)
        parent = F.call_function("shiftrightunsigned", "node", F.lit(depth - above))
        low = F.lit((1 << (depth - above)) - 1)
        child = {
            side: level.select(
                F.col("start").alias(f"start_{side}"),
                parent.alias(f"{side}_parent"),
                *[F.col(c).alias(f"{side}_{c}") for c in ("node", "n", "leaf")],
            )
            for side in "ab"
        }
        allowed = F.create_map(
            *[F.lit(x) for s in starts for x in (s, budget(s, depth, blocks, max_bits))]
        )
        new = F.bit_count(F.col("a_node").bitwiseXOR(F.col("b_node")).bitwiseAND(low))
        within = F.col("differing") + new <= allowed[F.col("start")]
        once = (F.col("a") != F.col("b")) | (F.col("a_node") <= F.col("b_node"))
        itself = (F.col("a_node") == F.col("b_node")) & (F.col("a_n") == 1)
        single = (F.col("a_n") == 1) & (F.col("b_n") == 1)
        close = F.bit_count(F.col("a_leaf").bitwiseXOR(F.col("b_leaf"))) <= max_bits
        met = (
            frontier.join(
                child["a"], (F.col("start") == F.col("start_a")) & (F.col("a") == F.col("a_parent"))
            )
            .join(
                child["b"],
                (F.col("start") == F.col("start_b"))
                & (F.col("b") == F.col("b_parent"))
                & within
                & once
                & ~itself
                & (~single | close),
            )
            .select(
                "start",
                F.col("a_node").alias("a"),
                F.col("b_node").alias("b"),
                (F.col("differing") + new).alias("differing"),
                single.alias("single"),
                *[rotated(F.col(f"{s}_leaf"), F.lit(BITS) - F.col("start")).alias(f"{s}_leaf") for s in "ab"],
            )
        )
        met = stage(met, f"trie-pairs-{depth}")
        found.append(met.where("single"))
        frontier = met.where("not single").select("start", "a", "b", "differing")
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs.select(
        F.least("a_leaf", "b_leaf").alias("u"), F.greatest("a_leaf", "b_leaf").alias("v")
    ).distinct()


def near_duplicates(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """``doc_id``, ``text_hash``, ``fp`` and ``component_id`` of every row.

    Equal fingerprints are joined as one, so a group of copies of any size is one
    leaf of the tries. ``component_id`` is the smallest ``doc_id`` that links of at
    most ``max_bits`` differing bits reach, the row's own included.

    Null, empty and wordless texts all have fingerprint 0 and are linked like any
    other. A null id is never a component's id unless it has no other; repeated
    rows get the same component; an empty table gives no rows; other columns are
    not read. Whole texts of any length are hashed in pieces. Intermediate tables
    are written when this is called.
    """
    rows = stage(fingerprints(docs, id, text, shingle), "fingerprints")
    distinct = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-groups")
    linked = stage(components(close_pairs(distinct.select("fp"), max_bits)), "fingerprint-links")
    # Staged sides make each of these a join of two scans, whose hot keys Spark splits.
    members = stage(
        distinct.join(linked, F.col("fp") == F.col("node")).select("fp", "root", "least"),
        "fingerprint-members",
    )
    ids = stage(members.groupBy("root").agg(F.min("least").alias("reached")), "fingerprint-ids")
    labels = members.join(ids, "root").select(F.col("fp").alias("_fp"), "root", "reached")
    named = distinct.join(stage(labels, "fingerprint-labels"), F.col("fp") == F.col("_fp"), "left")
    named = named.select(
        F.col("fp").alias("_fp"),
        F.coalesce("reached", "least").alias("component_id"),
        F.coalesce("root", "fp").alias("root"),
    )
    named = stage(named, "fingerprint-names")
    return rows.join(named, F.col("fp") == F.col("_fp")).drop("_fp")


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of near-duplicates, with all columns of ``docs``.

    The row with the smallest id stays (rows without an id come last, ties go by
    the hash of the text, and of equal rows any one).
    """
    groups = near_duplicates(docs, id, text)
    kept = groups.groupBy("root").agg(
        F.min(
            F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
        ).alias("kept")
    )
    kept = kept.select(F.col("kept.doc_id").alias("_id"), F.col("kept.text_hash").alias("_hash"))
    rows = by_place(docs).withColumn("_text_hash", F.xxhash64(place(docs, text)))
    same = place(docs, id).eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_hash"))
    one = rows.join(kept, same, "left_semi").dropDuplicates(
        [f"_col{docs.columns.index(id)}", "_text_hash"]
    )
    return one.drop("_text_hash").toDF(*docs.columns)


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    groups = near_duplicates(table(spark, folder, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return groups.select("doc_id", digits.alias("fingerprint"), "component_id")
