"""Ranked lexical search by a dual tree (operator 11).

Items and documents are sparse vectors over terms, and a score is their product.
Hierarchies over both hold the largest value of each coordinate in a node, so the
product of two nodes bounds the scores of all their pairs. A pair of nodes whose
bound is below the weakest kth score of the node's items is left out as a whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanlake.llm.common import pick, slices, table
from loanlake.session import stage

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
BEST = 10
#: Bytes of item texts that are searched for at a time; a block is all that tasks are sent.
BLOCK_BYTES = 1 << 22
#: Documents and coordinates of a tree, documents of a leaf and leaves of an upper node.
TREE_DOCUMENTS = 4_096
TREE_COORDINATES = 1 << 20
LEAF_DOCUMENTS = 32
NODE_LEAVES = 16
#: Children of an item node, and leaves that are scored at a time.
ITEM_CHILDREN = 8
SCORED_LEAVES = 8


def terms_of(text: str | None) -> list[str]:
    """Terms in order, with only A-Z lower-cased."""
    return TERM.findall((text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))


def ranges(starts: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the coordinates of ``nodes``, and where each node's begin among them."""
    sizes = starts[nodes + 1] - starts[nodes]
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    return np.repeat(starts[nodes] - begins, sizes) + np.arange(sizes.sum()), begins


class Level:
    """Sparse vectors of nodes one behind the other."""

    def __init__(self, starts: np.ndarray, terms: np.ndarray, values: np.ndarray):
        self.starts = starts
        self.terms = terms
        self.values = values

    def __len__(self) -> int:
        return len(self.starts) - 1

    def above(self, children: int) -> Level:
        """Nodes of ``children`` consecutive ones, with the largest value of each coordinate."""
        owner = np.repeat(np.arange(len(self)) // children, np.diff(self.starts))
        order = np.lexsort((self.terms, owner))
        owner, terms, values = owner[order], self.terms[order], self.values[order]
        new = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (terms[1:] != terms[:-1])])
        counts = np.bincount(owner[new], minlength=-(-len(self) // children))
        return Level(
            np.r_[0, np.cumsum(counts)], terms[new], np.maximum.reduceat(values, new)
        )

    def products(self, nodes: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """Product of each of ``nodes`` with a dense vector; nodes are never empty."""
        at, begins = ranges(self.starts, nodes)
        return np.add.reduceat(dense[self.terms[at]] * self.values[at], begins)


class Items:
    """A hierarchy over items: level 0 holds them, each further one nodes of the one below.

    Items are ordered by their heaviest term, so that those of one node share terms.
    """

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int):
        self.n_terms = n_terms
        heaviest = [int(terms[weights.argmax()]) for terms, weights in vectors]
        self.order = sorted(range(len(vectors)), key=lambda one: heaviest[one])
        ordered = [vectors[one] for one in self.order]
        sizes = [len(terms) for terms, _ in ordered]
        levels = [
            Level(
                np.r_[0, np.cumsum(sizes)],
                np.concatenate([terms for terms, _ in ordered]),
                np.concatenate([weights for _, weights in ordered]),
            )
        ]
        while len(levels[-1]) > 1:
            levels.append(levels[-1].above(ITEM_CHILDREN))
        self.levels = levels

    def dense(self, level: int, node: int) -> np.ndarray:
        vector = np.zeros(self.n_terms, np.int64)
        of = self.levels[level]
        part = slice(of.starts[node], of.starts[node + 1])
        vector[of.terms[part]] = of.values[part]
        return vector

    def members(self, level: int, node: int) -> tuple[int, int]:
        each = ITEM_CHILDREN**level
        return node * each, min((node + 1) * each, len(self.order))


class Documents:
    """A hierarchy over some documents: the documents, leaves of them, and nodes of leaves.

    Documents are ordered by their rarest term, so that a leaf has few coordinates.
    """

    def __init__(self, ids: list, starts: np.ndarray, terms: np.ndarray, values: np.ndarray, rarity: np.ndarray):
        rarest = np.maximum.reduceat(rarity[terms], starts[:-1])
        order = np.argsort(rarest, kind="stable")
        at, begins = ranges(starts, order)
        self.ids = [ids[one] for one in order]
        self.level = Level(np.r_[begins, len(at)], terms[at], values[at])
        self.leaves = self.level.above(LEAF_DOCUMENTS)
        self.nodes = self.leaves.above(NODE_LEAVES)
        #: Places of the documents in the order of their ids, nulls first.
        by_id = sorted(range(len(ids)), key=lambda one: (self.ids[one] is not None, self.ids[one] or 0))
        self.place = np.empty(len(ids), np.int64)
        self.place[by_id] = np.arange(len(ids))


def below(nodes: np.ndarray, children: int, limit: int) -> np.ndarray:
    found = (nodes[:, None] * children + np.arange(children)).ravel()
    return found[found < limit]


class Search:
    """The best documents of every item so far, over as many trees of documents as come."""

    def __init__(self, items: Items, weakest: np.ndarray, best: int):
        self.items = items
        self.best = best
        self.found: list[list[tuple]] = [[] for _ in items.order]
        #: Least score that may still enter, of each item.
        self.weakest = np.maximum(weakest[items.order], 1)

    def enter(self, item: int, docs: Documents, rows: np.ndarray, scores: np.ndarray) -> None:
        keep = scores >= self.weakest[item]
        rows, scores = rows[keep], scores[keep]
        if not len(rows):
            return
        first = np.lexsort((docs.place[rows], -scores))[: self.best]
        found = self.found[item]
        for at in first:
            one = docs.ids[rows[at]]
            found.append((-int(scores[at]), one is not None, one))
        found.sort(key=lambda row: (row[0], row[1], row[2] if row[1] else 0))
        del found[self.best :]
        if len(found) == self.best:
            self.weakest[item] = max(self.weakest[item], -found[-1][0])

    def score(self, item: int, docs: Documents, leaves: np.ndarray, dense: np.ndarray) -> None:
        rows = below(leaves, LEAF_DOCUMENTS, len(docs.ids))
        self.enter(item, docs, rows, docs.level.products(rows, dense))

    def probe(self, docs: Documents) -> None:
        """Score the most promising leaf of each item only."""
        every = np.arange(len(docs.leaves))
        for item in range(len(self.items.order)):
            dense = self.items.dense(0, item)
            best = docs.leaves.products(every, dense).argmax()
            self.score(item, docs, np.array([best]), dense)

    def visit(self, docs: Documents) -> None:
        """Score whatever no bound rules out."""
        top = len(self.items.levels) - 1
        work = [(top, 0, False, np.arange(len(docs.nodes)))]
        while work:
            level, node, at_leaves, nodes = work.pop()
            dense = self.items.dense(level, node)
            bounds = (docs.leaves if at_leaves else docs.nodes).products(nodes, dense)
            first, last = self.items.members(level, node)
            left = np.flatnonzero(bounds >= self.weakest[first:last].min())
            if not len(left):
                continue
            left = left[np.argsort(-bounds[left], kind="stable")]
            nodes, bounds = nodes[left], bounds[left]
            if level:
                children = below(np.array([node]), ITEM_CHILDREN, len(self.items.levels[level - 1]))
                if not at_leaves and level <= 2:
                    nodes, at_leaves = below(nodes, NODE_LEAVES, len(docs.leaves)), True
                work.extend((level - 1, int(child), at_leaves, nodes) for child in children)
            elif not at_leaves:
                work.append((0, node, True, below(nodes, NODE_LEAVES, len(docs.leaves))))
            else:
                for start in range(0, len(nodes), SCORED_LEAVES):
                    if bounds[start] < self.weakest[node]:
                        break
                    self.score(node, docs, nodes[start : start + SCORED_LEAVES], dense)


def document_terms(docs: DataFrame, numbers: dict[str, int]) -> DataFrame:
    """``doc_id``, ``n`` (all terms) and, of the numbered ones, ``terms`` and how often (``tf``).

    ``numbers`` are the terms of one block of items, so their size is bounded.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(numbers)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in slices(batches):
            sizes, terms, often = [], [], []
            for text in batch.column("text").to_pylist():
                found = terms_of(text)
                counted = Counter(map(number, found))
                counted.pop(None, None)
                sizes.append(len(found))
                terms.append(list(counted))
                often.append(list(counted.values()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(terms, pa.list_(pa.int32())),
                    pa.array(often, pa.list_(pa.int32())),
                ],
                names=["doc_id", "n", "terms", "tf"],
            )

    return docs.mapInArrow(count, f"doc_id {kind}, n long, terms array<int>, tf array<int>")


def trees(batches: Iterator[pa.RecordBatch], n_docs: int, n_terms: int, rarity: np.ndarray) -> Iterator[Documents]:
    """Trees of the documents of a task, some thousands each."""
    ids: list = []
    sizes: list[np.ndarray] = []
    terms: list[np.ndarray] = []
    values: list[np.ndarray] = []
    held = 0

    def tree() -> Documents:
        starts = np.r_[0, np.cumsum(np.concatenate(sizes))]
        return Documents(ids, starts, np.concatenate(terms), np.concatenate(values), rarity)

    for batch in slices(batches, 1024):
        found, tf = batch.column("terms"), batch.column("tf")
        each = np.diff(found.offsets.to_numpy())
        n = batch.column("n").to_numpy().astype(np.int64)
        length = 100 - 90 + (90 * n * n_docs) // n_terms
        often = tf.flatten().to_numpy().astype(np.int64)
        ids += batch.column("doc_id").to_pylist()
        sizes.append(each)
        terms.append(found.flatten().to_numpy().astype(np.int64))
        values.append((1_000_000_000 * often) // (1000 * often + 8 * np.repeat(length, each)))
        held += len(often)
        if len(ids) >= TREE_DOCUMENTS or held >= TREE_COORDINATES:
            yield tree()
            ids, sizes, terms, values, held = [], [], [], [], 0
    if ids:
        yield tree()


def search_block(docs: DataFrame, rows: list, best: int) -> DataFrame | None:
    """Best documents of the items of one block, given as collected rows; None without any."""
    texts = sorted({(row["id"], row["text"]) for row in rows}, key=repr)
    texts = [(id, sorted(set(terms_of(text)))) for id, text in texts]
    texts = [(id, terms) for id, terms in texts if terms]
    if not texts:
        return None
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = sorted({term for _, terms in texts for term in terms})
    numbers = {term: number for number, term in enumerate(names)}
    counted = stage(document_terms(docs, numbers), "search-terms")
    n_docs, n_terms = counted.where("n > 0").agg(F.count("*"), F.sum("n")).first()
    if not n_docs:
        return None
    holders = np.zeros(len(names), np.int64)
    for row in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        holders[row["term"]] = row["count"]
    weights = np.array(
        [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) for df in holders], np.int64
    )
    vectors = []
    for _, terms in texts:
        own = np.array([numbers[term] for term in terms], np.int64)
        vectors.append((own, weights[own]))
    items = Items(vectors, len(names))
    ids = pa.array([id for id, _ in texts])
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((items, weights))
    schema = f"item long, score long, doc_id {kind}"
    candidates = counted.where(F.size("terms") > 0)

    def searched(weakest: np.ndarray, probe: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items, weights = shared.value
            search = Search(items, weakest, best)
            id_kind = None

            def told() -> Iterator[pa.RecordBatch]:
                nonlocal id_kind
                for batch in batches:
                    id_kind = batch.schema.field("doc_id").type
                    yield batch

            for docs in trees(told(), n_docs, n_terms, weights):
                search.probe(docs) if probe else search.visit(docs)
            found = [
                (item, -row[0], row[2])
                for item, rows in zip(items.order, search.found, strict=True)
                for row in rows
            ]
            if found:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row[0] for row in found], pa.int64()),
                        pa.array([row[1] for row in found], pa.int64()),
                        pa.array([row[2] for row in found], id_kind),
                    ],
                    names=["item", "score", "doc_id"],
                )

        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
        found = candidates.mapInArrow(run, schema)
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)

    weakest = np.zeros(len(texts), np.int64)
    for row in searched(weakest, probe=True).where(F.col("rank") == best).collect():
        weakest[row["item"]] = row["score"]
    result = stage(searched(weakest, probe=False), "search-block")
    named = docs.sparkSession.createDataFrame(
        [(number, id) for number, id in enumerate(ids.to_pylist())], f"item long, item_id {rows_kind(rows)}"
    )
    return result.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score")


def rows_kind(rows: list) -> str:
    """Spark type of the items' ids."""
    return "string" if any(isinstance(row["id"], str) for row in rows) else "long"


def search(
    docs: DataFrame,
    items: DataFrame,
    best: int = BEST,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id`` and ``score`` of the best documents of each item.

    Items are searched for in blocks of bounded size, each against all documents.
    A first pass scores one leaf per tree and item, which gives every item a kth
    score over all documents; the second visits only what that cannot rule out, so
    the result is exact. Tasks keep ``best`` documents of an item, whatever their
    number.

    Null texts have no terms: such items find nothing and such documents are never
    found or counted. Equal scores rank by id, nulls first; repeated documents rank
    each; items with equal id and text are one, with different texts ranked apart.
    Ids are integers or text. An empty table gives no rows, other columns are not
    read. Terms and results are written when this is called.
    """
    rows = pick(docs, doc_id=id, text=text)
    wanted = pick(items, id=item_id, text=item_text).where(F.col("text").isNotNull())
    size = wanted.agg(F.sum(F.octet_length("text").cast("long") + 64)).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    found = None
    for block in range(blocks):
        own = wanted.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).distinct().collect()
        one = search_block(rows, own, best)
        if one is not None:
            found = one if found is None else found.unionByName(one)
    if found is None:
        kinds = [wanted.schema["id"].dataType.simpleString(), rows.schema["doc_id"].dataType.simpleString()]
        schema = f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score long"
        return docs.sparkSession.createDataFrame([], schema)
    kind = wanted.schema["id"].dataType
    return found.withColumn("item_id", F.col("item_id").cast(kind))


def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TERMS = (
    r"regexp_extract_all(translate({0}, '" + _UPPER + "', '" + _UPPER.lower() + r"'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)
ORACLE = f"""
with words as (
  select row_number() over () as doc, doc_id, unnest({_TERMS.format('text')}) as term from documents
),
lengths as (select doc, any_value(doc_id) as doc_id, count(*) as n from words group by doc),
totals as (select count(*) as n_docs, sum(n)::bigint as n_terms from lengths),
asked as (
  select distinct item_id, text, unnest({_TERMS.format('text')}) as term from (select distinct item_id, text from benchmark)
),
often as (
  select doc, term, count(*) as tf from words where term in (select term from asked) group by doc, term
),
weights as (
  select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w
  from often, totals group by term, n_docs
),
scored as (
  select item_id, asked.text, doc,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))))::bigint as score
  from asked join often using (term) join weights using (term) join lengths using (doc), totals
  group by item_id, asked.text, doc
),
ranked as (
  select item_id, doc_id, score,
    row_number() over (partition by item_id, scored.text order by score desc, doc_id nulls first) as rank
  from scored join lengths using (doc) where score > 0
)
select item_id, rank::integer as rank, doc_id, score from ranked where rank <= {BEST}
"""
