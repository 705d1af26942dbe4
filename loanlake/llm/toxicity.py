"""Toxicity classifier that ignores who is mentioned (operator 4).

A logistic regression on the distinct words of a text and their stems. Beside the
usual loss it pays for every score that changes when the identity terms of a labelled sentence
are swapped for others of their kind or for a neutral word, so a mere mention of
a group cannot raise a score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlake.llm.common import by_place, map_batches, pick, slices, table
from loanlake.session import stage

WORD = re.compile(r"[^\W\d_]+")
SENTENCE_END = re.compile(r"[.!?\n]+")
#: Kinds of identity terms; a term is swapped for the others of its kind.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men", "girls", "boys", "transgender", "nonbinary"),
    ("woman", "man", "girl", "boy"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "sikhs", "atheists", "catholics"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic"),
    ("black", "white", "asian", "latino", "arab", "african", "european", "indigenous"),
    ("gay", "lesbian", "bisexual", "heterosexual", "queer", "straight"),
    ("immigrants", "refugees", "foreigners", "natives", "citizens"),
    ("disabled", "deaf", "blind", "autistic"),
    ("elderly", "young", "old"),
)
#: Labelled rows the model is fitted on, at most: the smallest hashes of doc_id.
MAX_TRAINING_ROWS = 20_000
#: Words and stems the model may weigh beside the identity terms, the texts that one
#: needs, and how many may be picked by chance though they tell nothing.
MAX_FEATURES = 4_096
MIN_TEXTS = 5
FALSE_PICKS = 1.0
#: Characters of the stems of a word, which stand for its inflected forms.
STEMS = (4, 5, 6)
FAIRNESS = 20.0
RIDGE = 1e-4
THRESHOLD = 0.5


def features_of(word: str) -> list[str]:
    """The word and its stems, marked as such."""
    return [word, *[f"{word[:size]}-" for size in STEMS if len(word) > size]]


class Model:
    """Weight of every known word or stem and the bias; at most a few thousand entries."""

    def __init__(self, weights: Mapping[str, float], bias: float):
        self.weights = dict(weights)
        self.bias = bias
        # Words that begin otherwise have no known feature.
        self.heads = {feature.removesuffix("-")[: STEMS[0]] for feature in self.weights}

    def score(self, text: str) -> float:
        heads, weights = self.heads, self.weights
        found = {
            feature
            for word in set(WORD.findall(text.lower()))
            if word[: STEMS[0]] in heads
            for feature in features_of(word)
            if feature in weights
        }
        logit = self.bias + sum(weights[feature] for feature in sorted(found))
        return float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))


def held_out(id: Column) -> Column:
    """Whether a row's label is kept for testing: crc32 of the id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def distinct_features(rows: DataFrame, identity: tuple[tuple[str, ...], ...]) -> DataFrame:
    """``toxic``, the distinct ``features`` and, per sentence, the ``mentions`` of identity terms."""
    terms = {term for kind in identity for term in kind}

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            features, mentions = [], []
            for text in batch.column("text").to_pylist():
                lowered = (text or "").lower()
                own = set(WORD.findall(lowered))
                features.append(sorted({one for word in own for one in features_of(word)}))
                met: list[list[str]] = []
                if own & terms:
                    for sentence in SENTENCE_END.split(lowered):
                        if here := sorted(terms.intersection(WORD.findall(sentence))):
                            met.append(here)
                mentions.append(met)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("toxic"),
                    pa.array(features, pa.list_(pa.string())),
                    pa.array(mentions, pa.list_(pa.list_(pa.string()))),
                ],
                names=["row", "toxic", "features", "mentions"],
            )

    return map_batches(
        rows, found, "row long, toxic int, features array<string>, mentions array<array<string>>"
    )


def training_rows(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """``row``, ``text`` and ``toxic`` of at most ``rows`` labelled rows, none held out.

    The sample is picked on ids and labels alone. It goes to the executors, ``rows``
    ids at most, so that only its own texts are shuffled. Of
    several labels of one id the largest counts, and of several texts the smallest.
    """
    known = (
        pick(labels, id="doc_id", toxic="toxic")
        .where(F.col("id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    texts = pick(docs, id="doc_id", text="text").where(F.col("id").isNotNull())
    sample = known.join(texts.select("id"), "id", "left_semi")
    sample = sample.orderBy(F.xxhash64("id"), "id").limit(rows)
    return (
        texts.join(F.broadcast(sample), "id")
        .groupBy("id")
        .agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))
        .select(F.xxhash64("id").alias("row"), "toxic", "text")
    )


def pick_features(rows: DataFrame, positives: int, n: int, features: int) -> list[str]:
    """Words and stems that tell toxic texts from others beyond chance, the best first.

    The chance that a word is in so many toxic texts though it tells nothing is
    about exp(-evidence), with the divergence of its share of toxic texts from
    the overall share. Over all candidates these chances may add up to
    ``FALSE_PICKS`` words.
    """
    share = positives / n
    counts = (
        rows.select("toxic", F.explode("features").alias("feature"))
        .groupBy("feature")
        .agg(F.count("*").alias("n"), F.sum("toxic").alias("k"))
        .where(F.col("n") >= MIN_TEXTS)
    )
    own = F.col("k") / F.col("n")

    def part(given: Column, overall: float) -> Column:
        return F.when(given > 0, given * F.log(given / overall)).otherwise(0.0)

    evidence = F.col("n") * (part(own, share) + part(1 - own, 1 - share))
    candidates = stage(counts.select("feature", evidence.alias("evidence")), "toxicity-features")
    least = float(np.log(max(1, candidates.count()) / FALSE_PICKS))
    best = candidates.where(F.col("evidence") > least).orderBy(F.desc("evidence"), "feature")
    return [row["feature"] for row in best.limit(features).collect()]


def swaps(mentions: list[list[str]], identity: tuple[tuple[str, ...], ...]) -> list[dict[str, int]]:
    """Feature changes of every swap of every labelled sentence, without empty ones.

    Each term goes to every other of its kind in turn, and to a neutral word that
    has no weight; its stems go with it.
    """
    kind_of = {term: kind for kind in identity for term in kind}
    longest = max(map(len, identity))

    def features(terms: list[str]) -> set[str]:
        return {feature for term in terms for feature in features_of(term)}

    changes = []
    for here in mentions:
        before = features(here)
        changes.append(dict.fromkeys(sorted(before), -1))
        for step in range(1, longest):
            others = [
                kind_of[term][(kind_of[term].index(term) + step) % len(kind_of[term])]
                for term in here
            ]
            after = features(others)
            change = dict.fromkeys(sorted(after - before), 1)
            change |= dict.fromkeys(sorted(before - after), -1)
            if change:
                changes.append(change)
    return changes


def swap_sums(
    texts: DataFrame, identity: tuple[tuple[str, ...], ...]
) -> tuple[list[str], np.ndarray, int]:
    """Features of the identity terms, sums of the products of their changes, number of swaps.

    The penalty of a swap is the square of a weighted sum of its changes, so these
    sums over all swaps of all ``mentions`` give the whole penalty. They are added up
    on the executors: the driver gets one number for a pair of features at most,
    however many sentences mention a group.
    """
    names = sorted({one for kind in identity for term in kind for one in features_of(term)})
    at = {name: i for i, name in enumerate(names)}

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, swapped = np.zeros((len(names), len(names)), dtype=np.int64), 0
        for batch in slices(batches):
            rows = batch.column("mentions").to_pylist()
            for here, times in Counter(tuple(one) for met in rows for one in met).items():
                for change in swaps([list(here)], identity):
                    own = [at[feature] for feature in change]
                    by = np.array(list(change.values()))
                    sums[np.ix_(own, own)] += times * np.outer(by, by)
                    swapped += times
        left, right = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(left, -1), pa.int32()),
                pa.array(np.append(right, -1), pa.int32()),
                pa.array(np.append(sums[left, right], swapped), pa.int64()),
            ],
            names=["a", "b", "total"],
        )

    parts = map_batches(texts.select("mentions"), added, "a int, b int, total long")
    sums, swapped = np.zeros((len(names), len(names))), 0
    for row in parts.groupBy("a", "b").agg(F.sum("total").alias("total")).collect():
        if row["a"] < 0:
            swapped = row["total"]
        else:
            sums[row["a"], row["b"]] = row["total"]
    return names, sums, swapped


def fit_weights(
    toxic: np.ndarray,
    row: np.ndarray,
    column: np.ndarray,
    features: int,
    moving: np.ndarray,
    sums: np.ndarray,
    swapped: int,
    fairness: float,
    steps: int = 400,
) -> tuple[np.ndarray, float]:
    """Minimise log loss + fairness * mean squared score change + ridge, by Adam.

    Text ``row[i]`` has feature ``column[i]``; ``sums`` are those of the changes of
    the features ``moving`` over ``swapped`` swaps.
    """
    y = toxic.astype(float)
    w = np.zeros(features + 1)
    w[-1] = np.log((y.sum() + 0.1) / (len(y) - y.sum() + 0.9))
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        logit = np.bincount(row, w[column], len(y)) + w[-1]
        error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) / len(y)
        slope = np.append(np.bincount(column, error[row], features), error.sum())
        slope[:-1] += RIDGE * w[:-1]
        if swapped:
            slope[moving] += 2 * fairness / swapped * (sums @ w[moving])
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        w -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    return w[:-1], float(w[-1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    identity: tuple[tuple[str, ...], ...] = IDENTITY_TERMS,
    fairness: float = FAIRNESS,
    max_rows: int = MAX_TRAINING_ROWS,
    max_features: int = MAX_FEATURES,
) -> Model:
    """Fit the classifier on a bounded sample of the labelled rows.

    The driver gets the known features of at most ``max_rows`` texts, and one number
    for a pair of features of identity terms, whatever the size of ``docs``. Without labelled rows, or with one class only, the model is
    a constant.
    """
    rows = training_rows(docs, labels, max_rows)
    texts = stage(distinct_features(rows, identity), "toxicity-texts")
    n, positives = texts.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < positives < n:
        return Model({}, float(np.log((positives + 0.1) / (n - positives + 0.9))))
    terms = sorted({term for kind in identity for term in kind})
    chosen = pick_features(texts, positives, n, max_features)
    names = sorted({*chosen, *terms})
    place = {name: i for i, name in enumerate(names)}
    swapped_names, sums, swapped = swap_sums(texts, identity)
    known = [i for i, name in enumerate(swapped_names) if name in place]
    weights, bias = fit_weights(
        *collect_examples(texts, place),
        len(names),
        np.array([place[swapped_names[i]] for i in known], dtype=np.int64),
        sums[np.ix_(known, known)],
        swapped,
        fairness,
    )
    return Model({name: float(weights[i]) for name, i in place.items()}, bias)


def collect_examples(
    texts: DataFrame, place: Mapping[str, int]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labels of the training rows in a fixed order, and the row and number of every known feature."""
    known = dict(place)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [
                [known[one] for one in own if one in known]
                for own in batch.column("features").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("toxic"), pa.array(found, pa.list_(pa.int32()))],
                names=["row", "toxic", "found"],
            )

    rows = map_batches(
        texts.select("row", "toxic", "features"), numbered, "row long, toxic int, found array<int>"
    )
    told = rows.toArrow().sort_by("row")
    found = told.column("found")
    sizes = pc.list_value_length(found).to_numpy()
    return (
        told.column("toxic").to_numpy(),
        np.repeat(np.arange(told.num_rows), sizes),
        pc.list_flatten(found).to_numpy().astype(np.int64),
    )


def score(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1) of every row; whole texts, no shuffle.

    A null or empty text gets the score of no words. Repeated rows are scored
    alike, a null id stays null, an empty table gives no rows, and other columns
    are not read.
    """
    rows = pick(docs, doc_id=id, text=text)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            scores = [model.score(one or "") for one in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64())],
                names=["doc_id", "score"],
            )

    return map_batches(rows, scored, f"doc_id {kind}, score double")


def reject(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that score under the threshold, with all their columns."""
    rows = by_place(docs)
    column = f"_col{docs.columns.index(text)}"
    schema = rows.schema

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(column)
            yield batch.filter(
                pa.array([model.score(one.as_py() or "") < THRESHOLD for one in texts], pa.bool_())
            )

    return map_batches(rows, clean, schema).toDF(*docs.columns)


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = fit(docs, table(spark, folder, "labels"))
    return score(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
