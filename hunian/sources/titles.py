"""Known titles in buckets by hash, each with a Bloom sketch, so that a batch does not read the history.

``add`` puts titles into folders by bucket and sets their bits in the buckets' sketches. ``known_among`` first asks the sketches, of
which it opens the buckets of the asked titles, then opens only the title buckets that may hold one, and confirms by an exact join. A
title that a sketch does not know is not stored; one that it seems to know is looked up, so the answer is exact.

A sketch has ``BITS`` bits, kept in rows of ``CHUNK`` bits where any is set; every ``add`` adds rows, and a title is found if its
bits are spread over several. Sketches are written before titles: a job that dies in between leaves bits that lead to a
look-up in vain, never a stored title that cannot be found. Null titles are not stored and never known.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import file_system, fresh, remove

#: Numbers that stay as they are once a store is written. ``CHUNK`` is the size of Spark's bitmaps.
BUCKETS, BITS, PROBES, CHUNK = 256, 1 << 23, 5, 32_768
BUCKET = "title_bucket"
#: Up to this many hashes of titles go to the scan as literals, by which Parquet skips row groups.
LITERALS = 200

_TITLES = f"judul_iklan string, hash long, {BUCKET} int"
_SKETCH = f"chunk int, bits binary, {BUCKET} int"


def _hash(title: Column) -> Column:
    return F.xxhash64(title)


def _hashed(titles: DataFrame, key: str) -> DataFrame:
    """Distinct titles with their hash and bucket."""
    rows = titles.select(F.col(key).alias("judul_iklan")).filter("judul_iklan is not null").distinct()
    return rows.withColumn("hash", _hash(F.col("judul_iklan"))).withColumn(
        BUCKET, F.pmod(F.shiftrightunsigned("hash", 40), F.lit(BUCKETS)).cast("int"))


def _probes(rows: DataFrame) -> DataFrame:
    """For each title the ``chunk`` and ``bit`` of its probes, numbered."""
    places = F.array(*[F.struct(F.lit(n).alias("probe"), F.pmod(F.xxhash64(F.lit(n), "judul_iklan"), F.lit(BITS)).alias("place"))
                       for n in range(PROBES)])
    return rows.select("judul_iklan", BUCKET, F.inline(places)).select(
        "judul_iklan", BUCKET, "probe", F.floor(F.col("place") / CHUNK).cast("int").alias("chunk"),
        (F.col("place") % CHUNK).cast("int").alias("bit"))


def _read(spark: SparkSession, root: str, part: str, schema: str) -> DataFrame:
    """One part of the store; empty when nothing is stored yet."""
    files, at = file_system(spark, f"{root}/{part}")
    return spark.read.schema(schema).parquet(f"{root}/{part}") if files.exists(at) else spark.createDataFrame([], schema)


def _buckets(rows: DataFrame) -> list[int]:
    """At most ``BUCKETS`` numbers."""
    return [r[0] for r in rows.select(BUCKET).distinct().collect()]


def may_hold(spark: SparkSession, root: str, titles: DataFrame, key: str = "judul_iklan") -> DataFrame:
    """Titles that the sketches do not rule out, with ``hash`` and bucket."""
    rows = _hashed(titles, key)
    sketch = _read(spark, root, "sketch", _SKETCH)
    sketch = sketch.filter(F.col(BUCKET).isin(_buckets(rows)))
    byte = "cast(conv(hex(substring(bits, cast(bit div 8 as int) + 1, 1)), 16, 10) as int)"
    set_ = _probes(rows).join(sketch, [BUCKET, "chunk"]).filter(F.expr(f"(shiftright({byte}, bit % 8) & 1) = 1"))
    met = set_.groupBy("judul_iklan").agg(F.count_distinct("probe").alias("n")).filter(F.col("n") == PROBES).select("judul_iklan")
    return rows.join(met, "judul_iklan", "left_semi")


def known_among(spark: SparkSession, root: str, titles: DataFrame, key: str = "judul_iklan") -> DataFrame:
    """Those of ``titles`` that are stored, each once, as ``judul_iklan``. Call it with a small written table: it is read several times."""
    maybe = may_hold(spark, root, titles, key)
    # At most ``BUCKETS`` rows.
    sizes = maybe.groupBy(BUCKET).agg(F.count("*").alias("n")).collect()
    stored = _read(spark, root, "titles", _TITLES)
    if sum(r["n"] for r in sizes) <= LITERALS:
        few = maybe.select("hash", BUCKET).collect() if sizes else []
        stored = stored.filter(F.col(BUCKET).isin(sorted({r[BUCKET] for r in few})) & F.col("hash").isin(sorted({r["hash"] for r in few})))
    else:
        stored = stored.filter(F.col(BUCKET).isin([r[BUCKET] for r in sizes]))
    met = maybe.select("judul_iklan", "hash")
    return stored.join(met, ["judul_iklan", "hash"], "left_semi").select("judul_iklan").distinct()


def add(spark: SparkSession, root: str, titles: DataFrame, key: str = "judul_iklan") -> None:
    """Store the titles that are not stored yet; a second call adds nothing.

    A file of a bucket is sorted by hash, so a look-up skips most of a large one. Buckets are even, as titles are distinct.
    """
    rows = _hashed(titles, key)
    files, at = file_system(spark, f"{root}/titles")
    if files.exists(at):
        rows = rows.join(known_among(spark, root, rows.select("judul_iklan")), "judul_iklan", "left_anti")
    # Written once, as two tables are made of them.
    path = fresh(root, "_new")
    rows.select("judul_iklan", "hash", BUCKET).write.parquet(path)
    new = spark.read.schema(_TITLES).parquet(path)
    sketch = _probes(new).groupBy(BUCKET, "chunk").agg(F.bitmap_construct_agg("bit").alias("bits"))
    _by_bucket(sketch.select("chunk", "bits", BUCKET), "chunk").write.mode("append").partitionBy(BUCKET).parquet(f"{root}/sketch")
    _by_bucket(new.select("judul_iklan", "hash", BUCKET), "hash").write.mode("append").partitionBy(BUCKET).parquet(f"{root}/titles")
    remove(spark, path)


def _by_bucket(rows: DataFrame, order: str) -> DataFrame:
    return rows.repartition(BUCKET).sortWithinPartitions(BUCKET, order)
