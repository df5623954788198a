"""Titles that differ slightly: set-similarity join with prefix and length filters.

A text is the set of its words, without case and punctuation. Two sets are alike if their Jaccard similarity, common words over all
words, reaches ``like``. Words are put in one order, rare ones first; of a set of n words the first
``n - ceil(like * n) + 1`` are its prefix, and sets that are alike have a word of both prefixes in common. So only sets that share a
prefix word, and whose sizes allow the similarity, meet and are compared exactly; a frequent word is in few prefixes and no hot key.

Texts with one set are one in the join, whatever their number. Null texts are like none, and texts without words only like
texts without words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import keys

LIKE = 0.8


def words(text: Column) -> Column:
    """Distinct words in the order of the alphabet."""
    return F.array_sort(F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")))


def _sets(rows: DataFrame, key: str) -> DataFrame:
    """Each distinct text with its set."""
    return rows.select(F.col(key).alias("text")).filter("text is not null").distinct().withColumn("set", words(F.col("text")))


def _ordered(sets: DataFrame) -> DataFrame:
    """Each distinct set with its words ordered by how many sets hold them."""
    sets = sets.select("set").distinct()
    each = sets.select("set", F.explode("set").alias("word"))
    counts = each.groupBy("word").agg(F.count("*").alias("n")).select(
        F.col("word").alias("_word"), F.xxhash64("word").alias("_hash"), "n")
    # By the word and its hash, so that AQE can split a frequent word's rows; see ``keys``.
    counted = each.join(counts, (F.col("word") == F.col("_word")) & (F.xxhash64("word") == F.col("_hash")))
    return counted.groupBy("set").agg(F.array_sort(F.collect_list(F.struct("n", "word"))).alias("ordered")).select(
        "set", F.transform("ordered", lambda x: x["word"]).alias("ordered"))


def _similarity(a: Column, b: Column) -> Column:
    common = F.size(F.array_intersect(a, b))
    return common / (F.size(a) + F.size(b) - common)


def alike(left: DataFrame, right: DataFrame, key: str = "judul_iklan", like: float = LIKE) -> DataFrame:
    """``text``, ``other`` and ``similarity`` of all pairs of a text of ``left`` and one of ``right`` that are alike, each pair once."""
    a, b = _sets(left, key), _sets(right, key)
    order = _ordered(a.union(b))
    size = F.size("ordered")
    # A little below, as a product of the threshold may round up.
    prefix = F.slice("ordered", 1, (size - F.ceil(size * like - 1e-9) + 1).cast("int"))
    prefixes = order.withColumn("prefix", prefix)

    def side(texts: DataFrame, name: str) -> DataFrame:
        sets = prefixes.join(texts.select("set").distinct(), "set", "left_semi")
        return sets.select(F.col("set").alias(f"set_{name}"), F.col("prefix").alias(f"prefix_{name}"), F.explode("prefix").alias(f"word_{name}"))

    x, y = side(a, "a"), side(b, "b")
    small, large = F.least(F.size("set_a"), F.size("set_b")), F.greatest(F.size("set_a"), F.size("set_b"))
    # A pair with several common prefix words is met at the first of them only.
    first = F.get(F.array_intersect("prefix_a", "prefix_b"), F.lit(0)) == F.col("word_a")
    met = x.join(y, (F.col("word_a") == F.col("word_b")) & (small >= large * like - 1e-9) & first)
    pairs = met.withColumn("similarity", _similarity(F.col("set_a"), F.col("set_b"))).filter(F.col("similarity") >= like).select(
        "set_a", "set_b", "similarity")
    empty = a.select("set").union(b.select("set")).filter(F.size("set") == 0).distinct().select(
        F.col("set").alias("set_a"), F.col("set").alias("set_b"), F.lit(1.0).alias("similarity"))
    named = pairs.union(empty).join(a.withColumnRenamed("set", "set_a"), "set_a").join(
        b.select(F.col("set").alias("set_b"), F.col("text").alias("other")), "set_b")
    return named.select("text", "other", "similarity")


def keep_unlike(rows: DataFrame, known: DataFrame, key: str = "judul_iklan", like: float = LIKE) -> DataFrame:
    """Rows whose text is like none of ``known``; rows without a text stay, and so do copies within ``rows``."""
    met = alike(rows, known, key, like).select(F.col("text").alias(key))
    return keys.keep_new(rows, met, key)
