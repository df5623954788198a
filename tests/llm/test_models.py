"""Classifiers: accuracy on ids kept out of training, and rows of every kind."""

import re
import zlib

import duckdb
import numpy as np
import pytest

from hunian.llm import quality, toxicity
from tests.llm.tables import labels, no_documents, odd_documents

FOLDER = "/root/testdata/sf0.1"


@pytest.mark.parametrize("module, label, modulus, rest, accuracy, found", [
    (quality, "quality", 4, 2, 0.97, 0.9), (toxicity, "toxic", 5, 0, 0.95, 0.8)])
def test_held_out_accuracy(spark, module, label, modulus, rest, accuracy, found):
    docs, marks = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    scored = module.scored(docs, marks).join(marks, "doc_id").toPandas()
    held = [zlib.crc32(str(i).encode()) % modulus == rest for i in scored["doc_id"]]
    assert (scored["held_out"] == held).all() and scored["score"].between(0, 1).all()
    held = scored[scored["held_out"]]
    rare = held[label] == (0 if label == "quality" else 1)
    assert (held["predicted"] == held[label]).mean() >= accuracy
    assert (held["predicted"] == held[label])[rare].mean() >= found


@pytest.mark.parametrize("module", [quality, toxicity])
def test_odd_rows(spark, module):
    marks = labels(spark, [(i, i % 2, i % 2, None, None) for i in range(1, 12)] + [(None, 1, 1, "x", 0), (1, None, None, "x", 0), (1, 0, 0, "x", 0)])
    rows = module.scored(odd_documents(spark), marks).collect()
    assert len(rows) == 16 and all(0 <= r["score"] <= 1 for r in rows)
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], set()).add(r["score"])
    assert by_id[2] == by_id[3]
    assert module.scored(no_documents(spark), marks).count() == 0
    constant = {r["score"] for r in module.scored(odd_documents(spark), labels(spark)).collect()}
    assert len(constant) == 1
    one_class = labels(spark, [(i, 1, 1, None, None) for i in range(1, 8)])
    assert len({r["score"] for r in module.scored(odd_documents(spark), one_class).collect()}) == 1


def test_word_vectors_are_sums_of_neighbours():
    places, signs = quality.index_vectors()
    slots = [np.array([3, 4, 3, 9], np.int32), np.array([4], np.int32)]
    sums = np.zeros((quality.SLOTS + 1) * quality.DIM)
    quality.add_contexts(sums, slots, places, signs)
    plain = np.zeros((quality.SLOTS + 1, quality.DIM))
    for words in slots:
        for i, word in enumerate(words):
            for j in range(max(0, i - quality.REACH), min(len(words), i + quality.REACH + 1)):
                if i != j:
                    np.add.at(plain[word], places[words[j]], signs[words[j]])
    assert np.array_equal(sums.reshape(plain.shape)[:quality.SLOTS], plain[:quality.SLOTS])


def test_temperature_lowers_the_loss_on_held_rows():
    random = np.random.default_rng(0)
    features = random.normal(0, 1, (600, 4)).astype(np.float32)
    marks = (features[:, 0] + random.normal(0, 1, 600) > 0).astype(int)
    held = np.arange(600) % 5 == 0
    network = quality.fit_network(features, marks, held)

    def loss(temperature):
        z = network.logits(features[held]) / temperature
        return np.logaddexp(0, np.where(marks[held] > 0, -z, z)).mean()

    assert loss(network.temperature) <= loss(1.0) + 1e-9 and network.temperature != 1.0


def test_misspelled_words_share_subwords():
    slots, starts = toxicity.subwords(["pathetic", "pathetik", "umbrella"])
    of = [set(part.tolist()) for part in np.split(slots, starts[1:])]
    assert len(of[0] & of[1]) > 8 > 2 >= len(of[0] & of[2])


def test_unseen_misspelling_scores_like_the_word():
    texts = ["what a pathetic remark here"] * 30 + ["what a pleasant remark here"] * 30
    marks = np.array([1] * 30 + [0] * 30)
    model = toxicity.train([toxicity.counted(t) for t in texts], marks, np.arange(60) % 5 == 0, 0.5)
    bad, good = model.scores(["what a pathetik remark here", "what a pleasent remark here"], {})
    assert bad > 0.5 > good


def test_toxic_recall_over_several_splits():
    docs, marks = (duckdb.sql(f"SELECT * FROM '{FOLDER}/{t}.parquet'") for t in ("documents", "labels"))
    rows = duckdb.sql("SELECT text, toxic FROM docs JOIN marks USING (doc_id) WHERE toxic IS NOT NULL ORDER BY doc_id").fetchall()
    texts, toxic = [t or "" for t, _ in rows], np.array([y for _, y in rows])
    words = [toxicity.counted(t) for t in texts]
    recall, precision = [], []
    for seed in range(3):
        random = np.random.default_rng(seed)
        test = random.integers(0, 5, len(rows)) == 0
        fit = np.concatenate([random.permutation(np.flatnonzero(~test & (toxic == value)))[:toxicity.FIT_ROWS // 2] for value in (0, 1)])
        model = toxicity.train([words[i] for i in fit], toxic[fit], random.integers(0, 5, len(fit)) == 0, toxic[~test].mean())
        found = model.scores([texts[i] for i in np.flatnonzero(test)], {}) >= toxicity.THRESHOLD
        right = (found & (toxic[test] == 1)).sum()
        recall.append(right / (toxic[test] == 1).sum())
        precision.append(right / found.sum())
    assert np.mean(recall) >= 0.85 and min(recall) >= 0.7 and np.mean(precision) >= 0.75, (recall, precision)


def plain_quality(text, vectors, network):
    """Score of one text word by word; the vectors are those of slots."""
    rows = [vectors[zlib.crc32(w.encode()) % quality.SLOTS].astype(float) for w in re.findall(r"\w+|[^\w\s]+", text.lower())]
    pooled = np.zeros(3 * quality.DIM)
    if rows:
        mean = sum(rows) / len(rows)
        spread = np.sqrt(np.maximum(sum(r * r for r in rows) / len(rows) - mean * mean, 0))
        pooled = np.concatenate([mean, spread, sum((a * b for a, b in zip(rows, rows[1:])), np.zeros(quality.DIM)) / len(rows)])
    first, bias, second, shift = network.layers
    z = np.tanh((pooled - network.centre) / network.scale @ first + bias) @ second + shift
    return 1 / (1 + np.exp(-z / network.temperature))


def test_scores_equal_plain_versions():
    """Pooled vectors with the network, and averaged subwords with the softmax, word by word."""
    random = np.random.default_rng(4)
    texts = ["", "one", "one two, one!", "Ünï cödé a b c " * 30, "!!! ???", "x"]
    vectors = random.normal(size=(quality.SLOTS + 1, quality.DIM)).astype(np.float32)
    vectors[-1] = 0
    features = random.normal(size=(80, 3 * quality.DIM))
    network = quality.fit_network(features, (features[:, 0] > 0).astype(int), np.arange(80) % 5 == 0)
    weights, offset = random.normal(size=toxicity.BUCKETS), 0.3
    made, averaged = network.scores(quality.pooled(texts, vectors)), toxicity.Softmax(weights, offset).scores(texts, {})
    for n, text in enumerate(texts):
        assert made[n] == pytest.approx(plain_quality(text, vectors, network), rel=1e-3)
        words = re.findall(r"\w+", text.lower())
        score = sum(weights[toxicity.subwords([w])[0]].mean() for w in words) / max(len(words), 1)
        assert averaged[n] == pytest.approx(1 / (1 + np.exp(-score - offset)))
