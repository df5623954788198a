"""Quality classifier: random-indexing word vectors, pooled, and a small network.

1. Word vectors. Every hashed word has a sparse random index vector of +1 and -1. The vector of a word is the
   sum of its neighbours' index vectors over all documents. Each task sums its own documents;
   the sums of all tasks are added by word slot. The table has ``SLOTS`` rows whatever the input.
2. Pooling. A document is the mean and the spread of its words' vectors and the mean
   product of neighbouring ones, which is large where words repeat.
3. Network. One hidden layer, trained in numpy on at most ``FIT_ROWS`` labelled documents; a fifth of those
   is kept back to choose the temperature that divides the logit.

Null and empty texts pool to zeros and get a score like any other text. Of several labels for
one document the largest counts; null labels are left out. With labels of only one class, or
none, every score is the smoothed share of positive labels. Repeated rows are scored alike,
extra columns of the input are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import emptied_with_task, ending, map_batches, remainder, series_udf, texts_of

SLOTS, DIM, NONZERO, REACH = 1 << 15, 32, 4, 2
#: Labelled documents that the network is fitted on, at most.
FIT_ROWS = 12_000
HIDDEN, STEPS, RATE, SEED = 24, 400, 0.02, 7
THRESHOLD = 0.7
#: Words worked on at a time.
AT_ONCE = 100_000
#: Words whose slot one worker remembers before it starts anew.
REMEMBERED = 150_000

_WORDS = re.compile(r"\w+|[^\w\s]+").findall


class _Slots(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        slot = self[word] = zlib.crc32(word.encode()) % SLOTS
        return slot


_SLOTS = emptied_with_task(_Slots())


def word_slots(text: str) -> np.ndarray:
    words = _WORDS(text.lower())
    return np.fromiter(map(_SLOTS.__getitem__, words), np.int32, len(words))


def groups(texts: list[str]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Word slots of some texts at a time, with the texts' places; texts without words are left out."""
    places, slots, size = [], [], 0
    for place, text in enumerate(texts):
        found = word_slots(text)
        if len(found):
            places.append(place)
            slots.append(found)
            size += len(found)
        if size >= AT_ONCE:
            yield places, slots
            places, slots, size = [], [], 0
    if slots:
        yield places, slots


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of each slot's nonzero entries; the last row, between texts, has sign 0."""
    random = np.random.default_rng(SEED)
    places = random.integers(0, DIM, (SLOTS + 1, NONZERO), np.int32)
    signs = random.choice(np.array([-1.0, 1.0]), (SLOTS + 1, NONZERO))
    signs[SLOTS] = 0
    return places, signs


def add_contexts(sums: np.ndarray, slots: list[np.ndarray], places: np.ndarray, signs: np.ndarray) -> None:
    """Add to ``sums`` the index vectors of the up to ``REACH`` words on each side."""
    gap = np.full(REACH, SLOTS, np.int32)
    joined = np.concatenate([part for s in slots for part in (s, gap)])
    for reach in range(1, REACH + 1):
        left, right = joined[:-reach], joined[reach:]
        for word, context in ((left, right), (right, left)):
            base = word.astype(np.int64) * DIM
            for k in range(NONZERO):
                sums += np.bincount(base + places[context, k], signs[context, k], sums.size)


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Vectors of all word slots over the whole of ``docs``, of length one; the last row is zero.

    Sums of whole numbers do not depend on the order of tasks.
    """
    names = [f"v{i}" for i in range(DIM)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        sums = np.zeros((SLOTS + 1) * DIM)
        for batch in batches:
            for _, slots in groups(texts_of(batch)):
                add_contexts(sums, slots, places, signs)
        table = sums.reshape(-1, DIM)[:SLOTS].astype(np.int32)
        seen = np.flatnonzero(table.any(axis=1)).astype(np.int32)
        yield pa.RecordBatch.from_pydict(
            {"slot": pa.array(seen)} | {n: pa.array(table[seen, i]) for i, n in enumerate(names)})

    parts = docs.select(docs[text].alias("text")).mapInArrow(ending(run), "slot int, " + ", ".join(f"{n} int" for n in names))
    total = parts.groupBy("slot").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
    vectors = np.zeros((SLOTS + 1, DIM), np.float32)
    if total.num_rows:
        sums = np.stack([total[n].to_numpy() for n in names], axis=1).astype(np.float64)
        sums -= sums.sum(axis=0) * (np.abs(sums).sum(axis=1) / np.abs(sums).sum())[:, None]  # less what all words share
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        vectors[total["slot"].to_numpy()] = sums / np.where(length > 0, length, 1)
    return vectors


def pooled(texts: list[str], vectors: np.ndarray) -> np.ndarray:
    """Features of each text: mean, spread and neighbour products of its word vectors."""
    made = np.zeros((len(texts), 3 * DIM), np.float32)
    for places, slots in groups(texts):
        words = vectors[np.concatenate(slots)]
        counts = np.array([len(s) for s in slots])
        starts = np.cumsum(counts) - counts
        mean = np.add.reduceat(words, starts) / counts[:, None]
        square = np.add.reduceat(words * words, starts) / counts[:, None]
        after = np.zeros_like(words)
        after[:-1] = words[1:]
        after[starts[1:] - 1] = 0
        agree = np.add.reduceat(words * after, starts) / counts[:, None]
        made[places] = np.hstack([mean, np.sqrt(np.maximum(square - mean * mean, 0)), agree])
    return made


@dataclass
class Network:
    """Two layers over standardised features; without layers it gives ``share`` for every row."""

    share: float
    centre: np.ndarray | None = None
    scale: np.ndarray | None = None
    layers: tuple[np.ndarray, ...] = ()
    temperature: float = 1.0

    def logits(self, features: np.ndarray) -> np.ndarray:
        first, bias, second, offset = self.layers
        return np.tanh((features - self.centre) / self.scale @ first + bias) @ second + offset

    def scores(self, features: np.ndarray) -> np.ndarray:
        if not self.layers:
            return np.full(len(features), self.share)
        return 1 / (1 + np.exp(-np.clip(self.logits(features) / self.temperature, -500, 500)))


def fit_network(features: np.ndarray, labels: np.ndarray, held: np.ndarray) -> Network:
    """Adam over all rows that are not ``held``; the temperature has the least log loss on those that are."""
    labels = labels.astype(np.float64)
    share = (labels.sum() + 1) / (len(labels) + 2)
    if len(np.unique(labels[~held])) < 2:
        return Network(share)
    x, y = features[~held].astype(np.float64), labels[~held]
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    random = np.random.default_rng(SEED)
    width = x.shape[1]
    layers = [random.normal(0, width ** -0.5, (width, HIDDEN)), np.zeros(HIDDEN),
              random.normal(0, HIDDEN ** -0.5, HIDDEN), np.array(np.log(share / (1 - share)))]
    x = (x - centre) / scale
    first, second = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers]
    for step in range(1, STEPS + 1):
        hidden = np.tanh(x @ layers[0] + layers[1])
        error = (1 / (1 + np.exp(-(hidden @ layers[2] + layers[3]))) - y) / len(y)
        back = np.outer(error, layers[2]) * (1 - hidden * hidden)
        slopes = [x.T @ back + 1e-4 * layers[0], back.sum(axis=0), hidden.T @ error + 1e-4 * layers[2], error.sum()]
        for i, slope in enumerate(slopes):
            first[i] = 0.9 * first[i] + 0.1 * slope
            second[i] = 0.99 * second[i] + 0.01 * slope * slope
            layers[i] = layers[i] - RATE * (first[i] / (1 - 0.9 ** step)) / (
                np.sqrt(second[i] / (1 - 0.99 ** step)) + 1e-8)
    made = Network(share, centre, scale, tuple(layers))
    if held.any():
        logits = made.logits(features[held])
        choices = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
        loss = [np.logaddexp(0, np.where(labels[held] > 0, -1, 1) * logits / t).mean() for t in choices]
        made.temperature = float(choices[int(np.argmin(loss))])
    return made


@dataclass
class Model:
    """Word vectors and network as one broadcast of fixed size."""

    parts: Broadcast

    def score(self, text: Column) -> Column:
        """Probability that the text is good, a column that fits any frame."""
        parts = self.parts

        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            vectors, network = parts.value
            for texts in batches:
                yield pd.Series(network.scores(pooled(texts.fillna("").tolist(), vectors)))

        return series_udf(run)(text)


def labelled(docs: DataFrame, labels: DataFrame, label: str, trained: Column, rows: int) -> DataFrame:
    """At most ``rows`` labelled documents of ``trained`` ids, in the order of a hash of the id, one for each id.

    The labels alone are sorted and cut to that bound; so they can be broadcast
    and the texts of others stay where they are. Of rows with one id the text with the smallest hash counts. ``held`` marks every fifth by another hash.
    """
    kept = (
        labels.filter(trained & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.max(label).alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    one = docs.select("doc_id", "text").join(F.broadcast(kept), "doc_id").groupBy("doc_id").agg(
        F.min_by("text", F.xxhash64("text")).alias("text"), F.first("label").alias("label"))
    return one.select(
        "text", F.col("label").cast("int").alias("label"), (F.pmod(F.hash("doc_id"), F.lit(5)) == 0).alias("held"))


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Word vectors over all ``docs``; a network on labels whose id has remainder 0, 1 or 3 by 4."""
    context = docs.sparkSession.sparkContext
    vectors = word_vectors(docs)
    shared = context.broadcast(vectors)
    train = labelled(docs, labels, "quality", remainder(F.col("doc_id"), 4) != 2, rows)

    def make(batch: pa.RecordBatch) -> dict:
        made = pooled(texts_of(batch), shared.value)
        return {"features": pa.array(list(made), pa.list_(pa.float32())),
                "label": batch.column("label"), "held": batch.column("held")}

    found = map_batches(train, make, "features array<float>, label int, held boolean").toArrow().to_pandas()
    if len(found):
        # One order whatever the order of tasks, so that the fitted numbers repeat.
        features = np.stack(found["features"].to_numpy())
        order = np.lexsort((found["label"], *features.T[:4]))
        network = fit_network(features[order], found["label"].to_numpy()[order], found["held"].to_numpy()[order])
    else:
        network = Network(0.5)
    return Model(context.broadcast((vectors, network)))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every document."""
    model = fit(docs, labels)
    return docs.select(
        "doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), model.score(F.col("text")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
