"""Set-similarity join against all pairs."""

import random
import re

import pytest
from pyspark.sql import functions as F

from hunian.operators import similar as SM
from tests.test_operators import conf, plan  # noqa: F401


def words(text):
    return frozenset(w for w in re.split(r"[^\w]+|_", text.lower()) if w)


def plain(left, right, like):
    found = set()
    for a in {t for t in left if t is not None}:
        for b in {t for t in right if t is not None}:
            x, y = words(a), words(b)
            similarity = len(x & y) / len(x | y) if x | y else 1.0
            if similarity >= like:
                found.add((a, b, round(similarity, 9)))
    return found


@pytest.mark.parametrize("like", [0.5, 0.8, 1.0])
def test_pairs_equal_all_pairs(spark, like):
    random.seed(int(like * 10))
    vocabulary = ["the"] * 6 + ["rumah", "dijual"] * 3 + [f"w{i}" for i in range(40)]
    left = [" ".join(random.choices(vocabulary, k=random.randint(1, 9))) for _ in range(150)]
    right = [" ".join(random.sample(t.upper().split(), max(1, len(t.split()) - random.randint(0, 2)))) + random.choice(["", "!", " w1"])
             for t in left[:100]] + left[100:]
    odd = [None, "", "  ", "?!", "É é", "a-b_c", "a b c", "same", "same"]
    a, b = left + odd, right + odd
    frames = [spark.createDataFrame([(t, 1) for t in side], "judul_iklan string, `set` int") for side in (a, b)]
    got = [tuple(r) for r in SM.alike(*frames, like=like).collect()]
    assert len(got) == len(set(got))
    assert {(x, y, round(s, 9)) for x, y, s in got} == plain(a, b, like)
    met = {x for x, _, _ in plain(a, b, like)}
    kept = SM.keep_unlike(frames[0], frames[1], like=like)
    assert kept.columns == frames[0].columns
    assert sorted(map(str, (r[0] for r in kept.collect()))) == sorted(str(t) for t in a if t not in met)
    assert SM.alike(frames[0].limit(0), frames[1]).count() == 0


def test_a_frequent_word_is_no_prefix(spark, conf):  # noqa: F811
    """Sets that share only words that all have do not meet."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    rows = spark.range(600).select(F.concat(F.lit("rumah dijual murah x"), "id", F.lit(" y"), "id").alias("judul_iklan"))
    a, b = SM._sets(rows, "judul_iklan"), SM._sets(rows, "judul_iklan")
    assert SM.alike(rows, rows).count() == 600
    ordered = SM._ordered(a.union(b))
    assert ordered.filter(F.array_contains(F.slice("ordered", 1, 2), "rumah")).count() == 0
    text = plan(SM.alike(rows, rows))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text and "Python" not in text
