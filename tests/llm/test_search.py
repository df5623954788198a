"""Grid join, best positions and hard negatives against plain versions, with rows of every odd kind."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from hunian.llm import bestpos, gridjoin, hardneg
from tests.llm.tables import components, no_documents, odd_documents

VECTORS = "vec_id long, embedding array<double>, label int, `row` string, vec string, `key` long, vertex string"


def odd_vectors(spark, seed=1, count=400, width=12):
    """Clusters with exact and near copies, a hot vector, repeated ids, and vectors that cannot take part."""
    random_ = np.random.default_rng(seed)
    centres = random_.normal(size=(20, width))
    rows = [
        (int(i if i % 9 else random_.integers(60)), (centres[random_.integers(20)] + random_.normal(size=width) * random_.choice([0, 0.05, 0.3])).tolist(),
         int(random_.integers(4))) for i in range(count)]
    rows[200:300] = [(r[0], rows[200][1], rows[200][2]) for r in rows[200:300]]
    rows += [
        (7, None, 1), (8, [0.0] * width, 1), (10, rows[1][1], None), (11, [None] + [0.5] * (width - 1), 1), (12, [float("nan")] * width, 1),
        (13, [float("inf")] + [0.0] * (width - 1), 2), (14, [1.0], 1), (15, [], 1), (3, rows[4][1], rows[4][2]), (3, rows[4][1], rows[4][2])]
    return rows, spark.createDataFrame([(*r, "r", None, 5, "v") for r in rows], VECTORS)


def usable(rows, width=12):
    return [(n, k, np.array(v, float), label) for n, (k, v, label) in enumerate(rows)
            if k is not None and label is not None and v is not None and len(v) == width and None not in v and np.isfinite(np.array(v, float)).all()]


# Grid join

@pytest.mark.parametrize("block, leaf", [(2048, 128), (32, 8)])
def test_grid_join_equals_all_pairs(spark, monkeypatch, block, leaf):
    monkeypatch.setattr(gridjoin, "BLOCK", block)
    monkeypatch.setattr(gridjoin, "LEAF", leaf)
    rows, df = odd_vectors(spark)
    links = []
    taking = [r for r in usable(rows) if r[2].any()]
    for n, _, a, x in taking:
        for m, _, b, y in taking:
            if n != m and x == y and a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= gridjoin.LIKE:
                links.append((n, m))
    count, part = Counter(a for a, _ in links), components(range(len(rows)), links)
    least = {}
    for n, (k, _, _) in enumerate(rows):
        least[part[n]] = min(k, least.get(part[n], k))
    wanted = sorted((k, count[n], least[part[n]], k == least[part[n]]) for n, (k, _, _) in enumerate(rows))
    assert sorted(tuple(r) for r in gridjoin.components(df).collect()) == wanted
    assert len(links) > 5000 and len(set(least.values())) > 20


def test_grid_join_of_nothing_and_of_rows_that_cannot_link(spark):
    _, df = odd_vectors(spark)
    assert gridjoin.components(df.limit(0)).collect() == []
    alone = gridjoin.components(df.filter("label is null or embedding is null").unionByName(df.limit(1).withColumn("vec_id", F.lit(None).cast("long"))))
    assert sorted(map(tuple, alone.collect()), key=str) == sorted([(7, 0, 7, True), (10, 0, 10, True), (None, 0, None, True)], key=str)


def test_grid_order_skips_distant_sequences():
    random_ = np.random.default_rng(2)
    eps = math.sqrt(2 - 2 * gridjoin.LIKE)
    centres = random_.normal(size=(16, 8))
    units = gridjoin.unit(np.repeat(centres, 256, axis=0) + random_.normal(size=(4096, 8)) * 0.02)
    low = units[np.lexsort(np.floor(units / eps).T[::-1])]
    names = np.arange(len(low)).astype(str).astype(object)
    line = gridjoin.Sequence(names, np.ones(len(low), np.int64), low, low, low)
    parts = list(gridjoin.join(line, line, eps))
    compared = np.zeros((len(low), len(low)), bool)
    for i, j, k, m in parts:
        compared[i:j, k:m] = True
    assert not ((low @ low.T >= gridjoin.LIKE) & ~compared).any()
    assert compared.mean() < 0.4


def test_links_at_the_limit_and_extreme_lengths(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.93, math.sqrt(1 - 0.93 ** 2)]), (3, [1e200, 0.0]), (4, [1e-200, 0.0]), (5, [0.92, math.sqrt(1 - 0.92 ** 2)])]
    df = spark.createDataFrame([(k, v, 0) for k, v in rows], "vec_id long, embedding array<double>, label int")
    found = {r["vec_id"]: r["n_links"] for r in gridjoin.components(df).collect()}
    near = 0.93 / math.sqrt(0.93 ** 2 + (1 - 0.93 ** 2)) >= 0.93
    assert found[1] == found[3] == found[4] == 2 + near and found[5] == 1


# Best positions

def plain_search(docs, items, count):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def split(text):
        return [t.translate(lower) for t in pattern.findall(text or "")]

    rows = [(k, Counter(split(t))) for k, t in docs]
    n_docs, n_terms = sum(1 for _, c in rows if c), sum(sum(c.values()) for _, c in rows)
    frequency = Counter(t for _, c in rows for t in c)
    asked = {}
    for k, text in items:
        asked.setdefault(k, set()).update(split(text))
    found = []
    for item, terms in asked.items():
        scores = []
        for k, c in rows:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // n_terms if n_terms else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * frequency[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
                        for t in terms if t in c)
            if score > 0:
                scores.append((-score, k is None, k))
        found += [(item, rank + 1, k, -s) for rank, (s, _, k) in enumerate(sorted(scores)[:count])]
    return sorted(found, key=str)


def searched(docs, items, count):
    return sorted((tuple(r) for r in bestpos.search(docs, items, count).select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("shard, pairs, count", [(16_384, 200_000, 50), (64, 30, 5), (7, 1, 3)])
def test_search_equals_plain_scores(spark, monkeypatch, shard, pairs, count):
    monkeypatch.setattr(bestpos, "SHARD", shard)
    monkeypatch.setattr(bestpos, "PAIRS", pairs)
    monkeypatch.setattr(bestpos, "FIRST", 2)
    random.seed(4)
    words = [f"w{i}" for i in range(60)] + ["Ünï", "É", "ÀB", "the"]
    docs = [(i if i % 11 else i // 2, " ".join(random.choices(words, weights=range(64, 0, -1), k=random.randint(0, 40)))) for i in range(300)]
    docs += [(900, "THE the tHe"), (901, None), (902, ""), (None, "w1 w2"), (903, "w1-w2.W3_w4"), (904, "w5 " * 3000)] + docs[:3]
    items = [(n, " ".join(random.choices(words, k=8))) for n in range(12)] + [
        (50, None), (51, ""), (52, "not there"), (53, "the the É"), (None, "w1 w9"), (1, "w63 ünï"), (54, "w1!w2")]
    docs_df = spark.createDataFrame([(k, t, 1, "x") for k, t in docs], "doc_id long, text string, `rank` int, item string").repartition(3)
    items_df = spark.createDataFrame([(k, t, 1) for k, t in items], "item_id long, text string, doc_id int")
    assert searched(docs_df, items_df, count) == plain_search(docs, items, count)


def test_search_odd_documents(spark):
    docs = odd_documents(spark)
    items = spark.createDataFrame([(1, "copy of a text"), (2, "word3 word990 the")], "item_id long, text string")
    plain = plain_search([(r["doc_id"], r["text"]) for r in docs.collect()], [(1, "copy of a text"), (2, "word3 word990 the")], 50)
    assert searched(docs, items, 50) == plain
    assert searched(no_documents(spark), items, 50) == [] and searched(docs, items.limit(0), 50) == []


def test_reading_stops_before_the_lists_end():
    random_ = np.random.default_rng(5)
    docs, lists = 5000, 4
    term, doc = np.repeat(np.arange(lists), docs), np.tile(np.arange(docs), lists)
    times = np.clip(random_.zipf(1.6, docs * lists), 1, 1000)
    row = {"term": term.astype("<i4").tobytes(), "doc": doc.astype("<i4").tobytes(), "times": times.astype("<i4").tobytes(),
           "ids": np.arange(docs).astype("<i8").tobytes(), "lengths": np.full(docs, 100).astype("<i8").tobytes()}
    shard = bestpos.Shard(row, np.array([900, 800, 700, 600]), docs, docs * 100)
    read = []
    direct = shard.scores
    shard.scores = lambda found: read.append(len(found)) or direct(found)
    found, scores = shard.best(np.arange(lists), 10, 0)
    shard.asked[:] = True
    everything = direct(np.arange(docs))
    tenth = np.sort(everything)[-10]
    assert sorted(found.tolist()) == np.flatnonzero(everything >= tenth).tolist() and (scores == everything[found]).all()
    assert sum(read) < 0.7 * docs


# Hard negatives

def plain_negatives(rows, every):
    taking = [(k, (label + 1) % 10 if k % 7 == 0 else label, np.floor(256 * v).astype(int), n) for n, k, v, label in usable(rows)]
    found = []
    for key, label, vector, n in taking:
        if key % every:
            continue
        others = sorted((-int(vector @ v), k, m, other) for k, other, v, m in taking if m != n)
        for p, k, _, _ in [o for o in others if o[3] == label][:5]:
            hard = [o for o in others if o[3] != label and 50 * -p <= 100 * -o[0] <= 95 * -p][:3]
            found += [(key, k, rank + 1, o[1], -p, -o[0]) for rank, o in enumerate(hard)]
    return sorted(found)


@pytest.mark.parametrize("block, centroids", [(4096, 32), (32, 6)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, block, centroids):
    monkeypatch.setattr(hardneg, "BLOCK", block)
    monkeypatch.setattr(hardneg, "CENTROIDS", centroids)
    rows, df = odd_vectors(spark, seed=3)
    wanted = plain_negatives(rows, 10)
    assert len(wanted) > 200
    assert sorted(map(tuple, hardneg.mined(df, anchors=10).collect())) == wanted


def test_hard_negatives_of_few_rows(spark):
    _, df = odd_vectors(spark)
    assert hardneg.mined(df.limit(0)).collect() == []
    assert hardneg.mined(df.filter("embedding is null")).collect() == []
    one = spark.createDataFrame([(0, [1.0, 0.0], 1)], "vec_id long, embedding array<double>, label int")
    assert hardneg.mined(one).collect() == []
    pair = spark.createDataFrame(
        [(50, [1.0, 0.0], 1), (51, [1.0, 0.0], 1), (52, [0.5, 0.0], 2), (53, [0.95, 0.0], 2), (54, [0.96, 0.0], 2), (55, [0.49, 0.0], 2)],
        "vec_id long, embedding array<double>, label int")
    assert sorted(map(tuple, hardneg.mined(pair).collect())) == [
        (50, 51, 1, 53, 65536, 243 * 256), (50, 51, 2, 52, 65536, 128 * 256)]


def test_visits_follow_the_bounds_and_never_repeat():
    random_ = np.random.default_rng(6)
    first, second = random_.integers(-50, 50, 7), random_.integers(-50, 50, 5)
    counts = random_.integers(0, 4, 35)
    sums = (first[:, None] + second[None, :]).ravel()
    after, visited = hardneg._MOST, []
    while True:
        met, last, following = hardneg.visit(first, second, counts, after, -60, 6)
        assert sorted(met) == [c for c in np.flatnonzero(counts) if last <= sums[c] < after and sums[c] >= -60]
        visited += met
        if following == hardneg._LEAST:
            break
        after = following + 1
    assert sorted(visited) == [c for c in np.flatnonzero(counts) if sums[c] >= -60]
