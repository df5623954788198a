"""Toxicity: bags of subwords, averaged, and a linear softmax, trained together.

A word is the sum of the vectors of its character n-grams and of itself as a whole, all in ``BUCKETS`` hashed
slots, so a misspelling unseen in training shares most of its vectors with the word
it comes from. A document is the average of its words, and a softmax over the two classes reads it.
Vectors and softmax are trained together in numpy on at most ``FIT_ROWS`` labelled
documents, as many of either class as there are up to half of that; the loss weighs the classes as all labels have
them. Training starts from the subwords'
log odds where those speak for the toxic class beyond chance; the step with the least loss on every fifth document is kept.

Because the softmax is linear, a word adds a single number to the logit. A worker works that number out once
for each word it meets. Null and empty texts have the offset alone. Of several
labels for one document the largest counts; null labels are left out. Without labels of both classes every score is
the smoothed share of toxic labels. Repeated rows are scored alike, extra columns of the input are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import map_batches, remainder, series_udf, texts_of
from .quality import labelled

BUCKETS, DIM, SIZES = 1 << 16, 4, (3, 4, 5)
#: Labelled documents that the model is fitted on, at most.
FIT_ROWS = 4_000
STEPS, RATES, SEED = 30, (0.05, 0.05, 0.02), 11
#: Documents of the toxic class that every subword is taken to be in besides those seen.
SMOOTHING = 1.0
#: Standard deviations above an even spread from which on a subword's odds count at the start.
SURE = 6.0
THRESHOLD = 0.5
#: What recall weighs beside precision in the F measure that places the offset; a value by ``NEARLY`` below the best is as good.
RECALL, NEARLY = 2.0, 0.005
#: Words that one worker remembers before it starts anew.
REMEMBERED = 150_000
#: Words whose subwords are looked up at a time.
AT_ONCE = 20_000

_WORDS = re.compile(r"\w+").findall
_BASE = np.uint64(0x9E3779B97F4A7C15)


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed slots of the words' n-grams and of the words, and where each word's begin."""
    marked = [f"<{w}>" for w in words]
    lengths = np.array([len(w) for w in marked], np.int64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    codes = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), lengths)
    rest = ends[owner] - np.arange(len(codes))
    runs, slots, owners = codes + np.uint64(1), [], []
    for size in range(2, max(SIZES) + 1):
        runs = runs[:-1] * _BASE + codes[size - 1:]
        if size in SIZES:
            inside = rest[:len(runs)] >= size
            slots.append(_slot(runs[inside], size))
            owners.append(owner[:len(runs)][inside])
    place = (np.arange(len(codes)) - starts[owner]).astype(np.uint64)
    whole = np.add.reduceat((codes + np.uint64(1)) * _mixed(place + np.uint64(1)), starts)
    slots.append(_slot(whole, 1))
    owners.append(np.arange(len(words)))
    owners, slots = np.concatenate(owners), np.concatenate(slots)
    order = np.argsort(owners, kind="stable")
    counts = np.bincount(owners, minlength=len(words))
    return slots[order], np.cumsum(counts) - counts


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _slot(values: np.ndarray, kind: int) -> np.ndarray:
    return (_mixed(values + np.uint64(kind)) % np.uint64(BUCKETS)).astype(np.int32)


@dataclass
class Softmax:
    """What scoring needs: each subword slot's part of the logit and the offset."""

    weights: np.ndarray
    offset: float

    def words(self, words: list[str]) -> np.ndarray:
        """What each word adds to the sum that is averaged."""
        made = np.empty(len(words))
        for at in range(0, len(words), AT_ONCE):
            slots, starts = subwords(words[at:at + AT_ONCE])
            counts = np.diff(np.append(starts, len(slots)))
            made[at:at + AT_ONCE] = np.add.reduceat(self.weights[slots], starts) / counts
        return made

    def scores(self, texts: list[str], known: dict[str, float]) -> np.ndarray:
        made = np.full(len(texts), self.offset)
        for at in range(0, len(texts), 200):
            split = [_WORDS(t.lower()) for t in texts[at:at + 200]]
            new = list(set().union(*split).difference(known))
            if len(known) + len(new) > REMEMBERED:
                known.clear()
                new = list(set().union(*split))
            if new:
                known.update(zip(new, self.words(new).tolist()))
            for i, words in enumerate(split):
                if words:
                    made[at + i] += sum(map(known.__getitem__, words)) / len(words)
        return 1 / (1 + np.exp(-np.clip(made, -500, 500)))


def counted(text: str) -> tuple[list[str], list[float]]:
    """The distinct words of a text in order, and what part of its words each is."""
    words = _WORDS(text.lower())
    times = sorted(Counter(words).items())
    return [w for w, _ in times], [n / len(words) for _, n in times]


def train(texts: list[tuple[list[str], list[float]]], labels: np.ndarray, held: np.ndarray, share: float) -> Softmax:
    """Vectors and softmax by Adam over all documents (as ``counted``) that are not ``held``.

    Those that are choose the step, and the offset at which a score of one half has the best F measure at the true share of toxic documents.
    """
    constant = Softmax(np.zeros(BUCKETS), float(np.log(share / (1 - share))))
    if len(np.unique(labels[~held])) < 2:
        return constant
    numbers: dict[str, int] = {}
    docs, words, counts = [], [], []
    for i, (own, parts) in enumerate(texts):
        docs.append(np.full(len(own), i, np.int32))
        words.append(np.array([numbers.setdefault(w, len(numbers)) for w in own], np.int32))
        counts.append(np.array(parts, np.float32))
    doc, word, part = map(np.concatenate, (docs, words, counts))
    slots, starts = subwords(list(numbers)) if numbers else (np.zeros(0, np.int32), np.zeros(0, np.int64))
    sizes = np.diff(np.append(starts, len(slots))).astype(np.float32)
    by_word = np.argsort(word, kind="stable")
    doc, word, part = doc[by_word], word[by_word], part[by_word]
    word_of_slot = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes.astype(np.int64))
    def averaged(of_word: np.ndarray) -> np.ndarray:
        return np.bincount(doc, of_word[word] * part, len(texts))

    truth = np.stack([1 - labels, labels], axis=1).astype(np.float32)
    seen = np.array([1 - labels[~held].mean(), labels[~held].mean()])
    weight = (truth @ (np.array([1 - share, share]) / seen)).astype(np.float32)
    weight_fit = np.where(held, 0, weight) / weight[~held].sum()
    # The start: log odds of each subword by the documents it is in, and a softmax fitted to their averages.
    odds = _log_odds(slots, word_of_slot, doc, word, labels, held)
    start = averaged(np.bincount(word_of_slot, odds[slots], len(sizes)) / sizes)
    check = held if held.any() else ~held
    slope, shift = _line(start[check], labels[check], weight[check])
    random = np.random.default_rng(SEED)
    direction = random.normal(0, 1, DIM)
    direction /= np.linalg.norm(direction)
    params = [
        (odds[:, None] * direction + random.normal(0, 0.01, (BUCKETS, DIM))).astype(np.float32),
        np.stack([-direction, direction], axis=1).astype(np.float32) * slope / 2,
        np.array([-shift, shift], np.float32) / 2]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    best, best_loss, best_margin = None, np.inf, None
    for step in range(1, STEPS + 1):
        vectors, softmax, offset = params
        # Per dimension, so that no array is larger than the list of subwords.
        of_doc = np.stack([
            averaged(np.bincount(word_of_slot, vectors[slots, k], len(sizes)) / sizes) for k in range(DIM)], axis=1)
        logits = of_doc @ softmax + offset
        margin = logits[:, 1] - logits[:, 0]
        logits -= logits.max(axis=1, keepdims=True)
        chance = np.exp(logits)
        chance /= chance.sum(axis=1, keepdims=True)
        loss = -(weight * np.log((chance * truth).sum(axis=1) + 1e-12))[check].mean()
        if loss < best_loss:
            best, best_loss, best_margin = [p.copy() for p in params], loss, margin
        error = (chance - truth) * weight_fit[:, None]
        back = error @ softmax.T
        to_word = np.stack([np.bincount(word, back[doc, k] * part, len(sizes)) for k in range(DIM)], axis=1)
        to_word /= sizes[:, None]
        to_slot = np.stack([np.bincount(slots, to_word[word_of_slot, k], BUCKETS) for k in range(DIM)], axis=1)
        for i, slope in enumerate((to_slot, of_doc.T @ error, error.sum(axis=0))):
            # One scale for each array: subwords of many toxic words move far, rare ones hardly.
            mean, square = moments[i]
            mean += 0.1 * (slope - mean)
            square += 0.02 * ((slope * slope).max() - square)
            params[i] = (params[i] - RATES[i] * (mean / (1 - 0.9 ** step)) / (
                np.sqrt(square / (1 - 0.98 ** step)) + 1e-12)).astype(np.float32)
    vectors, softmax, offset = best
    cut = _best_cut(best_margin[check].astype(np.float64), labels[check], weight[check].astype(np.float64))
    return Softmax((vectors @ (softmax[:, 1] - softmax[:, 0])).astype(np.float64), float(offset[1] - offset[0]) - cut)


def _best_cut(values: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> float:
    """Middle of the values between which calling what lies above toxic has the best F measure, or nearly; 0 without both classes."""
    if len(np.unique(labels)) < 2:
        return 0.0
    order = np.argsort(-values, kind="stable")
    values, right = values[order], (weight * labels)[order]
    found = (1 + RECALL) * np.cumsum(right) / (np.cumsum(weight[order]) + RECALL * right.sum())
    last = np.flatnonzero(np.append(values[:-1] > values[1:], True))  # equal values are on one side
    below = np.append(values[1:], values[-1] - 2)[last]
    good = found[last] >= found[last].max() - NEARLY
    return float((values[last][good].max() + below[good].min()) / 2)


def _log_odds(slots, word_of_slot, doc, word, labels, held) -> np.ndarray:
    """Smoothed log odds of the toxic class for each subword slot; 0 where chance explains the count."""
    fit = ~held[doc]
    words = word_of_slot.max(initial=-1) + 1
    counts = [
        np.bincount(slots, np.bincount(word[fit], labels[doc[fit]] == value, words)[word_of_slot], BUCKETS)
        for value in (0, 1)]
    rest, toxic = counts
    ratio = (rest.sum() + 1) / (toxic.sum() + 1)
    expected = (toxic + rest) / (1 + ratio)
    sure = toxic - expected > SURE * np.sqrt(expected + 1)
    return np.where(sure, np.log((toxic + SMOOTHING) / (rest + SMOOTHING * ratio) * ratio), 0)


def _line(values: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic regression on one feature, by Newton's method."""
    scale = values.std() + 1e-12
    rows = np.stack([values / scale, np.ones(len(values))], axis=1)
    line = np.zeros(2)
    for _ in range(100):
        chance = 1 / (1 + np.exp(-np.clip(rows @ line, -30, 30)))
        bend = (rows * (weight * chance * (1 - chance))[:, None]).T @ rows + 1e-3 * np.eye(2)
        line += np.clip(np.linalg.solve(bend, rows.T @ (weight * (labels - chance)) - 1e-3 * line), -2, 2)
    return float(line[0] / scale), float(line[1])


_KNOWN: dict[int, dict[str, float]] = {}


@dataclass
class Model:
    """The trained softmax as a broadcast of fixed size."""

    softmax: Broadcast
    number: int

    def score(self, text: Column) -> Column:
        """Probability that the text is toxic, a column that fits any frame."""
        softmax, number = self.softmax, self.number

        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            # A worker keeps the words of one model from task to task: subwords are the dear part.
            if number not in _KNOWN:
                _KNOWN.clear()
            known = _KNOWN.setdefault(number, {})
            for texts in batches:
                yield pd.Series(softmax.value.scores(texts.fillna("").tolist(), known))

        return series_udf(run)(text)


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Model of the labels whose id does not divide by 5 (by its crc32)."""
    trained = remainder(F.col("doc_id"), 5) != 0
    marks = labels.filter(trained & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"))
    share = marks.agg(F.sum("toxic").alias("toxic"), F.count("*").alias("all")).first()
    share = ((share["toxic"] or 0) + 1) / (share["all"] + 2)

    def make(batch: pa.RecordBatch) -> dict:
        made = [counted(t) for t in texts_of(batch)]
        return {"words": pa.array([w for w, _ in made], pa.list_(pa.string())), "parts": pa.array([p for _, p in made], pa.list_(pa.float32())),
                "label": batch.column("label"), "held": batch.column("held")}

    # Words are counted in the tasks; no text comes to the driver.
    found = [
        map_batches(labelled(docs, marks.filter(F.col("toxic") == value), "toxic", trained, rows // 2), make,
                    "words array<string>, parts array<float>, label int, held boolean").toArrow().to_pylist()
        for value in (0, 1)]
    rows = sorted((r["words"], r["parts"], r["label"], r["held"]) for part in found for r in part)
    softmax = train([(w, p) for w, p, _, _ in rows], np.array([y for _, _, y, _ in rows], np.int64),
                    np.array([h for _, _, _, h in rows], bool), share)
    shared = docs.sparkSession.sparkContext.broadcast(softmax)
    return Model(shared, shared._jbroadcast.id())


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every document."""
    model = fit(docs, labels)
    return docs.select(
        "doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), model.score(F.col("text")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
