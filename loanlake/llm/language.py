"""Language identification by a convolutional network on bytes (operator 13).

Text is read as UTF-8 bytes in windows of a fixed length. Filters of several
widths slide over the embedded bytes; the largest response of each filter in the
window goes to a softmax over the languages. Trained in numpy on labelled text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlake.llm.common import pick, slices, table

#: Bytes of a window, and the byte value that fills a short one up.
WINDOW = 256
PAD = 256
WIDTHS = (2, 3, 4)
FILTERS = 24
EMBEDDING = 8
#: Bounds of the training sample: languages (the most frequent), texts of each, texts in
#: all, and windows taken of a text.
MAX_LANGUAGES = 256
ROWS_PER_LANGUAGE = 1_500
MAX_TRAINING_ROWS = 24_000
CROPS = 4
STEPS = 1_500
BATCH = 64
RATE = 0.004
SHORTEST = 8
#: Windows that go through the network at a time.
GROUP = 64
UNKNOWN = "und"


class Network:
    """Byte embedding, filters per width, and the weights of the softmax."""

    def __init__(self, languages: Sequence[str], seed: int = 13):
        rng = np.random.default_rng(seed)
        self.languages = list(languages)
        self.weights = {"embedding": rng.normal(0, 0.5, (PAD + 1, EMBEDDING)).astype(np.float32)}
        for width in WIDTHS:
            shape = (width, EMBEDDING, FILTERS)
            self.weights[f"filter{width}"] = rng.normal(0, 0.3, shape).astype(np.float32)
            self.weights[f"bias{width}"] = np.zeros(FILTERS, np.float32)
        shape = (len(WIDTHS) * FILTERS, len(languages))
        self.weights["output"] = rng.normal(0, 0.1, shape).astype(np.float32)
        self.weights["output_bias"] = np.zeros(len(languages), np.float32)
        self.weights["embedding"][PAD] = 0

    def tables(self) -> dict[int, np.ndarray]:
        """Response of every filter at each of its places to each byte."""
        embedding = self.weights["embedding"]
        return {
            width: np.stack([embedding @ part for part in self.weights[f"filter{width}"]])
            for width in WIDTHS
        }

    @staticmethod
    def responses(windows: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Response of each filter at each place of the windows."""
        places = windows.shape[1] - len(table) + 1
        summed = np.take(table[0], windows[:, :places], axis=0)
        for at in range(1, len(table)):
            summed += np.take(table[at], windows[:, at : at + places], axis=0)
        return summed

    def probabilities(self, windows: np.ndarray, tables: dict[int, np.ndarray]) -> np.ndarray:
        pooled = [
            self.responses(windows, tables[width]).max(axis=1) + self.weights[f"bias{width}"]
            for width in WIDTHS
        ]
        features = np.maximum(np.concatenate(pooled, axis=1), 0)
        return softmax(features @ self.weights["output"] + self.weights["output_bias"])

    def gradients(self, windows: np.ndarray, wanted: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the cross entropy; only the place of the largest response passes it on."""
        tables = self.tables()
        pooled, places = [], []
        for width in WIDTHS:
            found = self.responses(windows, tables[width])
            best = found.argmax(axis=1)
            places.append(best)
            largest = np.take_along_axis(found, best[:, None, :], axis=1)[:, 0]
            pooled.append(largest + self.weights[f"bias{width}"])
        before = np.concatenate(pooled, axis=1)
        features = np.maximum(before, 0)
        error = softmax(features @ self.weights["output"] + self.weights["output_bias"])
        error[np.arange(len(wanted)), wanted] -= 1
        error /= len(wanted)
        back = (error @ self.weights["output"].T) * (before > 0)
        embedding = self.weights["embedding"]
        found = {
            "output": features.T @ error,
            "output_bias": error.sum(axis=0),
            "embedding": np.zeros_like(embedding),
        }
        rows = np.arange(len(windows))[:, None]
        for number, width in enumerate(WIDTHS):
            share = back[:, number * FILTERS : (number + 1) * FILTERS]
            filters = self.weights[f"filter{width}"]
            change = np.zeros_like(filters)
            for at in range(width):
                met = windows[rows, places[number] + at]
                change[at] = np.einsum("bf,bfe->ef", share, embedding[met])
                np.add.at(found["embedding"], met, share[:, :, None] * filters[at].T[None])
            found[f"filter{width}"] = change
            found[f"bias{width}"] = share.sum(axis=0)
        found["embedding"][PAD] = 0
        return found


def softmax(logits: np.ndarray) -> np.ndarray:
    shifted = np.exp(logits - logits.max(axis=1, keepdims=True))
    return shifted / shifted.sum(axis=1, keepdims=True)


def crop(data: bytes, rng: np.random.Generator) -> np.ndarray:
    """A window from a random place, at times a short one, as short texts are met too."""
    size = WINDOW if rng.random() < 0.5 else int(rng.integers(SHORTEST, WINDOW + 1))
    start = int(rng.integers(0, max(1, len(data) - size + 1)))
    part = np.frombuffer(data[start : start + size], np.uint8)
    return np.concatenate([part, np.full(WINDOW - len(part), PAD)])


def train(texts: list[tuple[str, str]], steps: int = STEPS, seed: int = 13) -> Network:
    """Network fitted to (language, text) pairs by Adam, languages drawn equally often."""
    languages = sorted({language for language, _ in texts})
    network = Network(languages, seed)
    if len(languages) < 2:
        return network
    rng = np.random.default_rng(seed)
    by_language = [[text.encode() for one, text in texts if one == name] for name in languages]
    first = {name: np.zeros_like(one) for name, one in network.weights.items()}
    second = {name: np.zeros_like(one) for name, one in network.weights.items()}
    for step in range(1, steps + 1):
        wanted = rng.integers(0, len(languages), BATCH)
        windows = np.stack(
            [crop(by_language[one][rng.integers(0, len(by_language[one]))], rng) for one in wanted]
        )
        rate = RATE * (1 - step / (steps + 1))
        for name, change in network.gradients(windows, wanted).items():
            first[name] += 0.1 * (change - first[name])
            second[name] += 0.001 * (change * change - second[name])
            mean = first[name] / (1 - 0.9**step)
            spread = np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8
            network.weights[name] -= (rate * mean / spread).astype(np.float32)
    return network


def windows_of(data: bytes) -> np.ndarray:
    """All windows of a text, overlapping by so much that every filter sees every place."""
    stride = WINDOW - max(WIDTHS) + 1
    count = max(1, -(-(len(data) - max(WIDTHS) + 1) // stride))
    padded = np.full(stride * (count - 1) + WINDOW, PAD, np.int16)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::stride]


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def held_out(id: Column, modulus: int = 4, remainder: int = 2) -> Column:
    """Whether a row is kept for testing: by crc32 of the id as text; never for a null id."""
    return F.coalesce(
        F.crc32(id.cast("string").cast("binary")) % modulus == remainder, F.lit(False)
    )


def training_texts(labelled: DataFrame) -> list[tuple[str, str]]:
    """A bounded sample of ``lang`` and crops of ``text``, drawn by a hash of the text.

    Rows are counted per language, so that only about as many as are wanted leave
    the tasks; equal texts count once. Crops lie evenly over a text.
    """
    counts = (
        labelled.groupBy("lang").agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES).collect()
    )
    if not counts:
        return []
    shares = F.create_map(
        *[F.lit(part) for row in counts for part in (row["lang"], min(1.0, ROWS_PER_LANGUAGE / row["n"]))]
    )
    key = F.xxhash64("text")
    spare = F.greatest(F.length("text") - WINDOW, F.lit(0))
    crops = [
        F.substr("text", (F.floor(spare * at / (CROPS - 1)) + 1).cast("int"), F.lit(WINDOW))
        for at in range(CROPS)
    ]
    drawn = (
        labelled.where(F.pmod(key, F.lit(1 << 30)) < shares[F.col("lang")] * (1 << 30))
        .select("lang", key.alias("key"), F.array_distinct(F.array(*crops)).alias("crops"))
        .groupBy("key", "lang").agg(F.min("crops").alias("crops"))
        .orderBy("key", "lang").limit(MAX_TRAINING_ROWS)
    )
    return [(row["lang"], text) for row in drawn.collect() for text in row["crops"]]


def fit(
    docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> Network:
    """Network trained on rows with a language and a letter that are not held out.

    The sample (``training_texts``) is bounded by parameters, and so is what it
    brings to the driver. Rows without an id, a text or a language teach nothing.
    """
    rows = pick(docs, id=id, text=text, lang=lang)
    usable = rows.where(
        F.col("id").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    ).where(~held_out(F.col("id")))
    return train(training_texts(usable.select("lang", "text")))


def identify(
    docs: DataFrame, network: Network, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of every row, from all windows of its text.

    The probabilities of a text are the means over its windows, weighed by their
    bytes; the best language is predicted and its probability is the score. A null
    text, or one without a letter, is ``und`` with score 0, as is every text if the
    network has learned no language. A long text passes a group of windows at a
    time. A null id stays null, repeated rows are judged each, an empty table gives
    no rows, and other columns are not read. No shuffle.
    """
    rows = pick(docs, doc_id=id, text=text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    languages = network.languages

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = network.tables()
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            sums = np.zeros((len(texts), len(languages)))
            waiting: list[np.ndarray] = []
            owners: list[np.ndarray] = []
            size = 0

            def pass_on():
                windows, of = np.concatenate(waiting), np.concatenate(owners)
                for start in range(0, len(windows), GROUP):
                    part = windows[start : start + GROUP]
                    weight = (part != PAD).sum(axis=1)[:, None]
                    np.add.at(sums, of[start : start + GROUP], network.probabilities(part, tables) * weight)

            for number, one in enumerate(texts):
                if not languages or not one or not has_letter(one):
                    continue
                found = windows_of(one.encode())
                for start in range(0, len(found), 16 * GROUP):
                    waiting.append(found[start : start + 16 * GROUP])
                    owners.append(np.full(len(waiting[-1]), number))
                    size += len(waiting[-1])
                    if size >= 16 * GROUP:
                        pass_on()
                        waiting, owners, size = [], [], 0
            if waiting:
                pass_on()
            totals = sums.sum(axis=1)
            shares = sums / np.where(totals > 0, totals, 1)[:, None]
            best = shares.argmax(axis=1) if languages else np.zeros(len(texts), int)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(
                        [languages[b] if t > 0 else UNKNOWN for b, t in zip(best, totals, strict=True)],
                        pa.string(),
                    ),
                    pa.array(shares.max(axis=1, initial=0), pa.float64()),
                ],
                names=["doc_id", "lang_pred", "score"],
            )

    return rows.mapInArrow(predict, f"doc_id {kind}, lang_pred string, score double")


def op13_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = identify(docs, fit(docs))
    return found.withColumn("held_out", held_out(F.col("doc_id")))
