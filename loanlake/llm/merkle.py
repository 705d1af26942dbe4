"""Merkle manifest of a dataset with proofs per row (operator 12)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanlake.llm.common import pick, table
from loanlake.session import stage

#: Children of a node.
FANOUT = 8
#: Nodes of one level of a tree that a window holds; a multiple of the fanout.
BUCKET = FANOUT**4
#: Characters of a digest.
DIGEST = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def field(value: Column) -> Column:
    """A value with its length in bytes before it, so that no two rows read alike; null is ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(value) for value in values]), 256)


def in_order(rows: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """Add ``tree``, ``pos`` and ``nodes``: number of the group, place in it and its size.

    Groups and the rows of each are numbered from 0 in ascending order, nulls
    first. Rows are sorted by ranges of group and order together, so that a group
    with a third of all rows lies in many tasks; a row's place is its offset in
    the sorted part, and only one row per part and group is summed up and joined.
    The sorted rows are written when this is called.
    """
    keys = [F.col(one).asc_nulls_first() for one in (group, *order)]
    placed = stage(
        rows.orderBy(*keys).withColumn("_place", F.monotonically_increasing_id()), name
    ).withColumn("_part", F.shiftright("_place", 33))
    sizes = placed.groupBy("_part", group).agg(
        F.min("_place").alias("_first"), F.count("*").alias("_size")
    )
    sizes = stage(sizes.withColumnRenamed(group, "_group"), f"{name}-parts")
    # Summed over the parts of all groups: a few numbers per task of the sort.
    earlier = Window.partitionBy("_group").orderBy("_part")
    runs = sizes.select(
        F.col("_part").alias("_of"),
        "_group",
        "_first",
        (F.sum("_size").over(earlier) - F.col("_size")).alias("_before"),
        F.sum("_size").over(Window.partitionBy("_group")).alias("nodes"),
    )
    begins = sizes.groupBy("_group").agg(F.min(F.struct("_part", "_first")).alias("_at"))
    begins = begins.select(F.col("_group").alias("_named"), "_at._part", "_at._first")
    begun = begins.groupBy("_part").agg(F.count("*").alias("_groups"))
    # One row per task of the sort.
    begun = begun.withColumn(
        "_earlier", F.sum("_groups").over(Window.orderBy("_part")) - F.col("_groups")
    )
    inside = F.row_number().over(Window.partitionBy("_part").orderBy("_first")) - 1
    numbers = begins.join(begun, "_part").select(
        "_named", (F.col("_earlier") + inside).cast("long").alias("tree")
    )
    runs = runs.join(numbers, F.col("_group").eqNullSafe(F.col("_named"))).drop("_named")
    joined = placed.join(
        stage(runs, f"{name}-runs"),
        (F.col("_part") == F.col("_of")) & F.col(group).eqNullSafe(F.col("_group")),
    )
    pos = F.col("_before") + F.col("_place") - F.col("_first")
    return joined.select(*rows.columns, "tree", pos.alias("pos"), "nodes")


def with_siblings(nodes: DataFrame) -> DataFrame:
    """Add ``siblings``: the digests of the other nodes of the run, left to right.

    Lag and lead columns of fixed offsets, masked by the slot in the run and by its
    length. Windows hold ``BUCKET`` consecutive nodes, which no run crosses.
    """
    slot = F.col("pos") % FANOUT
    length = F.least(F.lit(FANOUT), F.col("nodes") - (F.col("pos") - slot))
    near = Window.partitionBy("tree", F.floor(F.col("pos") / BUCKET)).orderBy("pos")
    before = [
        F.when(slot >= k, F.lag("digest", k).over(near)) for k in range(FANOUT - 1, 0, -1)
    ]
    after = [F.when(slot + k < length, F.lead("digest", k).over(near)) for k in range(1, FANOUT)]
    return nodes.withColumn("siblings", F.concat_ws("", *before, *after))


def build_levels(leaves: DataFrame, largest: int, name: str) -> list[DataFrame]:
    """The levels of all trees from the leaves up, each written, with ``siblings``.

    ``leaves`` have ``tree``, ``pos``, ``nodes`` and ``digest``; ``largest`` is the
    greatest ``nodes``. The first child of a run hashes the parent; a level with one
    node is the top of its tree.
    """
    levels = [stage(with_siblings(leaves), f"{name}-0")]
    while largest > 1:
        first = levels[-1].where((F.col("nodes") > 1) & (F.col("pos") % FANOUT == 0))
        parents = first.select(
            "tree",
            F.floor(F.col("pos") / FANOUT).alias("pos"),
            F.ceil(F.col("nodes") / FANOUT).alias("nodes"),
            F.sha2(F.concat("digest", "siblings"), 256).alias("digest"),
        )
        levels.append(stage(with_siblings(parents), f"{name}-{len(levels)}"))
        largest = -(-largest // FANOUT)
    return levels


def with_paths(levels: list[DataFrame], above: DataFrame, name: str) -> DataFrame:
    """Nodes of the lowest level with ``path``: slot and siblings of every level up to the root.

    ``above`` has a row per ``tree`` with the ``path`` above its top and whatever
    else its nodes shall know. Upper levels are written; the lowest is not.
    """
    known = [one for one in above.columns if one not in ("tree", "path")]
    found = None
    for depth in range(len(levels) - 1, -1, -1):
        level = levels[depth]
        top = level.where("nodes = 1").join(above, "tree").select(*level.columns, *known, "path")
        if found is None:
            joined = top
        else:
            upper = found.select(
                F.col("tree").alias("_tree"), F.col("pos").alias("_pos"), *known, F.col("path").alias("_path")
            )
            inner = level.where("nodes > 1").join(
                upper.hint("merge"),
                (F.col("tree") == F.col("_tree")) & (F.floor(F.col("pos") / FANOUT) == F.col("_pos")),
            )
            step = F.struct((F.col("pos") % FANOUT).cast("int").alias("slot"), "siblings")
            joined = inner.select(
                *level.columns, *known, F.concat(F.array(step), "_path").alias("path")
            ).unionByName(top)
        found = stage(joined, f"{name}-paths-{depth}") if depth else joined
    return found


def fold(digest: Column, path: Column) -> Column:
    """The root that a digest and its path give."""

    def up(node: Column, step: Column) -> Column:
        left = step["slot"] * DIGEST
        others = step["siblings"]
        whole = F.concat(
            F.substr(others, F.lit(1), left), node, F.substr(others, left + 1)
        )
        return F.sha2(whole, 256)

    return F.aggregate(path, digest, up)


def proof_text(path: Column) -> Column:
    """All siblings of a path, from the leaf to the root, left to right."""
    return F.array_join(F.transform(path, lambda step: step["siblings"]), "")


def manifest(rows: DataFrame) -> DataFrame:
    """Add ``subroot``, ``root`` and ``path`` to leaves of ``id``, ``part`` and ``digest``.

    The leaves of a ``part`` ascend by ``id`` (null first), equal ids by digest, and
    form a tree whose runs of eight consecutive nodes, the last run fewer, become
    one node each until a single one, the subroot, remains. The subroots in the
    order of their parts (null first, bytewise) form the tree of the root in the
    same way. Any other columns are carried along. No text and no whole part passes
    through one task: the sort, the windows and the joins work on places. An empty
    table gives no rows. The levels are written when this is called.
    """
    placed = stage(in_order(rows, "part", ["id", "digest"], "merkle-leaves"), "merkle-placed")
    largest, trees = placed.agg(F.max("nodes"), F.max("tree")).first()
    if largest is None:
        empty = "array<struct<slot:int,siblings:string>>"
        return rows.select(
            *rows.columns,
            F.lit(None).cast("string").alias("subroot"),
            F.lit(None).cast("string").alias("root"),
            F.lit(None).cast(empty).alias("path"),
        )
    levels = build_levels(placed, largest, "merkle-level")
    subroots = None
    for level in levels:
        found = level.where("nodes = 1").select("tree", "digest")
        subroots = found if subroots is None else subroots.unionByName(found)
    tops = subroots.select(
        F.lit(0).cast("long").alias("tree"),
        F.col("tree").alias("pos"),
        F.lit(trees + 1).cast("long").alias("nodes"),
        "digest",
    )
    upper = build_levels(tops, trees + 1, "merkle-top")
    root = upper[-1].select(
        "tree",
        F.col("digest").alias("root"),
        F.array().cast("array<struct<slot:int,siblings:string>>").alias("path"),
    )
    above = with_paths(upper, root, "merkle-top").select(
        F.col("pos").alias("tree"), F.col("digest").alias("subroot"), "root", "path"
    )
    known = with_paths(levels, stage(above, "merkle-subroots"), "merkle-level")
    return known.select(*rows.columns, "subroot", "root", "path")


def document_leaves(
    docs: DataFrame,
    id: str = "doc_id",
    part: str = "lang",
    fields: Sequence[str] = FIELDS,
    tampered: dict[str, Column] | None = None,
) -> DataFrame:
    """``id``, ``part``, ``digest`` of every row and ``claimed``, its digest after tampering.

    ``tampered`` gives the tampered form of fields, in terms of columns ``f0``,
    ``f1``, ... for ``fields`` in order, and of ``id``. Nulls are a value of their
    own, empty texts another; repeated rows are leaves each; other columns are not
    read, whatever their names.
    """
    names = {f"f{at}": one for at, one in enumerate(fields)}
    rows = pick(docs, id=id, part=part, **names)
    changed = tampered or {}
    return rows.select(
        "id",
        "part",
        row_digest([F.col(one) for one in names]).alias("digest"),
        row_digest([changed.get(names[one], F.col(one)) for one in names]).alias("claimed"),
    )


def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """Leaves, roots and proofs of ``documents``, and what a third of them fold to once tampered with."""
    text = F.col(f"f{FIELDS.index('text')}")
    hit = F.crc32(F.col("id").cast("string").cast("binary")) % 3 == 0
    lowered = F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())
    leaves = document_leaves(
        table(spark, folder, "documents"), tampered={"text": F.when(hit, lowered).otherwise(text)}
    )
    known = manifest(leaves).withColumn("folded_root", fold(F.col("claimed"), F.col("path")))
    return known.select(
        F.col("id").alias("doc_id"),
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        F.sha2(proof_text(F.col("path")), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _tree_sql(name: str, leaves: str, group: str, depth: int) -> str:
    """Levels ``name_0`` to ``name_depth`` as steps; a run's digests stand together in ``whole``."""
    steps = []
    for level in range(depth + 1):
        nodes = leaves if level == 0 else (
            f"select distinct {group}, run as pos, sha256(whole) as digest from {name}_{level - 1} where nodes > 1"
        )
        steps.append(f"""
{name}_{level} as (
  select *, pos // {FANOUT} as run, count(*) over (partition by {group}) as nodes,
    string_agg(digest, '' order by pos) over (partition by {group}, pos // {FANOUT}
      order by pos rows between unbounded preceding and unbounded following) as whole,
    {DIGEST} * (pos % {FANOUT}) as skip
  from ({nodes})
)""")
    return ",".join(steps)


def _folded_sql(name: str, depth: int, digest: str) -> str:
    for level in range(depth):
        one = f"{name}{level}"
        whole = f"substr({one}.whole, 1, {one}.skip) || ({digest}) || substr({one}.whole, {one}.skip + {DIGEST + 1})"
        digest = f"case when {one}.nodes > 1 then sha256({whole}) else {digest} end"
    return digest


def _proof_sql(name: str, depth: int) -> str:
    return " || ".join(
        f"case when {name}{level}.nodes > 1 then substr({name}{level}.whole, 1, {name}{level}.skip)"
        f" || substr({name}{level}.whole, {name}{level}.skip + {DIGEST + 1}) else '' end"
        for level in range(depth)
    )


def _joined_sql(name: str, depth: int, group: str, first: str) -> str:
    return " ".join(
        f"left join {name}_{level} {name}{level} on {name}{level}.{group} is not distinct from {first}.{group}"
        f" and {name}{level}.pos = {first}.pos // {FANOUT**level}"
        for level in range(depth)
    )


def oracle(depth: int = 8) -> str:
    """SQL for parts of up to ``8 ** depth`` rows and as many parts."""
    crc_bit = "lambda a, i: xor(a >> 1, 3988292384 * (a & 1))"
    crc_byte = f"lambda s, b: list_reduce(list_prepend(xor(s, b), range(8)), {crc_bit})"
    crc = (
        "xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform("
        f"string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)), {crc_byte}))"
    )
    fields = " || ".join(
        f"coalesce(strlen({one}::varchar) || ':' || {one}::varchar, '-')" for one in FIELDS[:-1]
    )
    text = "coalesce(strlen({0}) || ':' || {0}, '-')"
    lowered = f"translate(text, '{ASCII_UPPER}', '{ASCII_UPPER.lower()}')"
    return f"""
with hashed as (
  select doc_id, lang, sha256({fields} || {text.format('text')}) as digest,
    case when doc_id is not null and {crc} % 3 = 0
      then sha256({fields} || {text.format(lowered)})
      else sha256({fields} || {text.format('text')}) end as claimed
  from documents
),
leaves as (
  select *, row_number() over (partition by lang order by doc_id nulls first, digest) - 1 as pos from hashed
),
{_tree_sql('part', 'select lang, pos, digest from leaves', 'lang', depth)},
subroots as (
  {' union all '.join(f'select lang, digest from part_{level} where nodes = 1' for level in range(depth + 1))}
),
tops as (select 0 as whole_set, lang, digest, row_number() over (order by lang nulls first) - 1 as pos from subroots),
{_tree_sql('top', 'select whole_set, pos, digest from tops', 'whole_set', depth)},
root as (
  {' union all '.join(f'select digest as root from top_{level} where nodes = 1' for level in range(depth + 1))}
),
above as (
  select tops.lang, tops.digest as subroot, {_proof_sql('top', depth)} as upper_proof,
    {', '.join(f'top{level}.nodes as n{level}, top{level}.whole as w{level}, top{level}.skip as s{level}' for level in range(depth))}
  from tops {_joined_sql('top', depth, 'whole_set', 'tops')}
),
folded as (
  select leaves.doc_id, leaves.digest as leaf, above.subroot, ({_proof_sql('part', depth)}) || upper_proof as proof,
    {_folded_sql('part', depth, 'leaves.claimed')} as folded_subroot, above.*
  from leaves {_joined_sql('part', depth, 'lang', 'leaves')}
  join above on above.lang is not distinct from leaves.lang
),
ended as (
  select *, {_upper_sql(depth)} as folded_root from folded
)
select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, folded_root, folded_root = root as verified
from ended, root
"""


def _upper_sql(depth: int) -> str:
    digest = "folded_subroot"
    for level in range(depth):
        whole = f"substr(w{level}, 1, s{level}) || ({digest}) || substr(w{level}, s{level} + {DIGEST + 1})"
        digest = f"case when n{level} > 1 then sha256({whole}) else {digest} end"
    return digest
