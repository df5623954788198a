"""Document fingerprints by winnowing.

Every run of ``GRAM`` code points is hashed by a rolling polynomial, and of every
``WINDOW`` hashes in a row the smallest is kept, the rightmost on ties, with its position. Two
texts that share ``GRAM + WINDOW - 1`` code points in a row therefore share a
fingerprint entry, and no run shorter than ``GRAM`` makes one. An edited copy that keeps the first half is
so found from ``2 * (GRAM + WINDOW - 1)`` code points on. A text with fewer hashes
than a window keeps its smallest one, a text shorter than ``GRAM`` one hash
of the whole, the empty text none. Null texts read as empty. Repeated rows have equal
fingerprints; extra columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .base import ending, map_batches, text_or_empty, texts_of

GRAM, WINDOW = 12, 12
#: A hash has so many bits, twelve hexadecimal digits.
BITS = 48
#: Code points worked on at a time, so that the arrays stay in the processor's caches.
AT_ONCE = 200_000

# Odd constants of the polynomial and of the final mixing; any odd 64-bit numbers would do.
_BASE, _MIX = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9
_ALL = (1 << 64) - 1


def gram_hashes(codes: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` codes from each position on, made of runs that double in length."""
    power, run = 1, codes.astype(np.uint64) + np.uint64(1)
    whole, length = None, 0
    while power <= gram:
        if gram & power:
            if whole is None:
                whole = run
            else:
                whole = whole[:len(run) - length] * np.uint64(pow(_BASE, power, 1 << 64)) + run[length:]
            length += power
        if power * 2 <= gram:
            run = run[:-power] * np.uint64(pow(_BASE, power, 1 << 64)) + run[power:]
        power *= 2
    mixed = whole ^ (whole >> np.uint64(31))
    mixed *= np.uint64(_MIX)
    return (mixed ^ (mixed >> np.uint64(29))) >> np.uint64(64 - BITS)


def window_minima(hashes: np.ndarray, window: int) -> np.ndarray:
    """Position of the smallest of each ``window`` hashes in a row, the rightmost on ties."""
    at = np.arange(len(hashes), dtype=np.int32)

    def join(left, right, gap):
        (small, place), (other, where) = left, right
        n = len(small) - gap if len(other) == len(small) else min(len(small), len(other) - gap)
        small, place, other, where = small[:n], place[:n], other[gap:gap + n], where[gap:gap + n]
        take = other <= small
        return np.where(take, other, small), np.where(take, where, place)

    power, run, whole, length = 1, (hashes, at), None, 0
    while power <= window:
        if window & power:
            whole = run if whole is None else join(whole, run, length)
            length += power
        if power * 2 <= window:
            run = join(run, run, power)
        power *= 2
    return whole[1]


def winnow(texts: list[str], gram: int = GRAM, window: int = WINDOW) -> list[tuple[np.ndarray, np.ndarray]]:
    """(hashes, positions) of each text; positions count code points from 0."""
    found, group, size = [], [], 0
    for text in texts:
        if group and size + len(text) > AT_ONCE:
            found += _winnow_group(group, gram, window)
            group, size = [], 0
        group.append(text)
        size += len(text)
    return found + (_winnow_group(group, gram, window) if group else [])


def _winnow_group(texts: list[str], gram: int, window: int) -> list[tuple[np.ndarray, np.ndarray]]:
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    lengths = np.array([len(t) for t in texts])
    ends = np.cumsum(lengths)
    starts = ends - lengths
    if len(codes) >= gram:
        hashes = gram_hashes(codes, gram)
    grams = lengths - gram + 1
    long = np.flatnonzero(grams >= window)
    result: list = [None] * len(texts)
    if len(long):
        minima = window_minima(hashes, window)
        windows = grams[long] - window + 1
        bounds = np.cumsum(windows)
        first = bounds - windows
        of = np.repeat(starts[long] - first, windows) + np.arange(bounds[-1])
        chosen = minima[of]
        keep = np.ones(len(chosen), bool)
        keep[1:] = chosen[1:] != chosen[:-1]
        counts = np.add.reduceat(keep, first)
        chosen = chosen[keep]
        for i, cut in zip(long, np.split(chosen, np.cumsum(counts)[:-1])):
            result[i] = hashes[cut], cut - starts[i]
    for i in np.flatnonzero(grams < window):
        if not lengths[i]:
            result[i] = np.empty(0, np.uint64), np.empty(0, np.int32)
        elif grams[i] > 0:
            own = hashes[starts[i]:starts[i] + grams[i]]
            at = grams[i] - 1 - int(np.argmin(own[::-1]))
            result[i] = own[at:at + 1], np.array([at], np.int32)
        else:
            digest = hashlib.blake2b(texts[i].encode(), digest_size=BITS // 8).digest()
            result[i] = np.array([int.from_bytes(digest, "big")], np.uint64), np.zeros(1, np.int32)
    return result


def as_text(hashes: np.ndarray) -> str:
    """Hashes in order of their positions, twelve hexadecimal digits each."""
    return hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - BITS // 8:].tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared share of two fingerprints' distinct hashes; 1 if both are empty."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def fingerprints(
    docs: DataFrame, key: str = "doc_id", text: str = "text", gram: int = GRAM, window: int = WINDOW,
) -> DataFrame:
    """``key``, ``hashes array<bigint>`` and ``positions array<int>`` of each row; nothing is shuffled."""

    def make(batch: pa.RecordBatch) -> dict:
        made = winnow(texts_of(batch), gram, window)
        return {
            key: batch.column("key"),
            "hashes": pa.array([h.astype(np.int64) for h, _ in made], pa.list_(pa.int64())),
            "positions": pa.array([p.astype(np.int32) for _, p in made], pa.list_(pa.int32())),
        }

    kind = docs.schema[key].dataType.simpleString()
    return map_batches(docs.select(docs[key].alias("key"), docs[text].alias("text")), make,
                       f"`{key}` {kind}, hashes array<bigint>, positions array<int>")


def _blocks(docs: DataFrame, blocks: int) -> tuple[Column, DataFrame, int]:
    """The block of a key, each block's first key with the block that ends before it, and the number of blocks.

    Blocks are key ranges of about equal row counts, the largest keys in block 0 and
    null keys in a block of their own. The driver holds one number per block.
    """
    shares = [i / blocks for i in range(1, blocks)]
    marks = docs.agg(F.percentile_approx("key", shares, 100 * blocks) if shares else F.lit(None)).first()[0]
    bounds = np.unique(np.array(marks or [], np.int64))

    @pandas_udf("int")
    def block_of(keys):
        found = len(bounds) - np.searchsorted(bounds, keys.fillna(0).to_numpy(np.int64), side="left")
        return keys.mask(keys.notna(), 0).fillna(len(bounds) + 1).astype("int32") + np.where(keys.isna(), 0, found)

    firsts = docs.select(block_of("key").alias("block"), "key").groupBy("block").agg(F.max("key").alias("key"))
    order = sorted(firsts.collect(), key=lambda row: row["block"])
    rows = [(row["key"], order[i - 1]["block"]) for i, row in enumerate(order)]
    return block_of("key"), docs.sparkSession.createDataFrame(rows, "guest_key long, guest_block int"), len(bounds) + 2


def edited_fingerprints(docs: DataFrame, blocks: int | None = None, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Each document against an edited copy of itself and against the next document.

    The next one has the next smaller ``doc_id``; after the last comes the first. Rows with one
    id follow each other by text, null ids come last. The edited copy ends in as many code points of
    the next text's beginning as half of its own length. Texts are
    moved once, by ranges of ids; the first row of each range goes to the range
    before it as well, so that every row meets its next one as the sorted rows pass by. The
    number of ranges (``blocks``, by default twice as many as the scan has tasks, or the session's shuffle partitions if
    those are more) is all that the driver's work depends on.
    """
    spark = docs.sparkSession
    if not blocks:
        scanned = docs.select("doc_id", "text").rdd.getNumPartitions()
        blocks = max(2 * scanned, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col("doc_id").cast("long").alias("key"), text_or_empty().alias("text"))
    block, firsts, ranges = _blocks(rows.select("key"), blocks)
    guests = F.when(F.col("guest_block").isNotNull(), F.array(
        F.struct(F.col("own").alias("block"), F.lit(False).alias("guest")),
        F.struct(F.col("guest_block").alias("block"), F.lit(True).alias("guest")))
    ).otherwise(F.array(F.struct(F.col("own").alias("block"), F.lit(False).alias("guest"))))
    placed = (
        rows.join(F.broadcast(firsts), F.col("key").eqNullSafe(F.col("guest_key")), "left")
        .withColumn("own", block)
        .select("key", "text", F.inline(guests))
        .repartitionById(ranges, F.col("block").cast("int"))
        .sortWithinPartitions("block", "guest", F.desc_nulls_last("key"), "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the row that waits for its next one: key, text, fingerprint
        for batch in batches:
            texts = batch.column("text").to_pylist()
            keys, guest = batch.column("key").to_pylist(), batch.column("guest").to_pylist()
            for start, end in _slices(texts):
                pairs = []
                for own in zip(keys[start:end], texts[start:end], winnow(texts[start:end], gram, window), guest[start:end]):
                    if held is not None:
                        pairs.append((held, own))
                    held = None if own[3] else own
                if pairs:
                    yield _compared(pairs, gram, window)

    return placed.mapInArrow(
        ending(run), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double, positions array<int>")


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size > 4 * AT_ONCE:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _compared(pairs: list, gram: int, window: int) -> pa.RecordBatch:
    half = [len(own[1]) // 2 for own, _ in pairs]
    edited = [own[1][:len(own[1]) - n] + after[1][:n] for (own, after), n in zip(pairs, half)]
    marks = winnow(edited, gram, window)
    return pa.RecordBatch.from_pydict({
        "doc_id": pa.array([own[0] for own, _ in pairs], pa.int64()),
        "n_chars": pa.array([len(own[1]) for own, _ in pairs], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
        "fingerprint": pa.array([as_text(own[2][0]) for own, _ in pairs], pa.string()),
        "edited_fingerprint": pa.array([as_text(m[0]) for m in marks], pa.string()),
        "near_edited": pa.array([likeness(own[2][0], m[0]) for (own, _), m in zip(pairs, marks)], pa.float64()),
        "near_next": pa.array([likeness(own[2][0], after[2][0]) for own, after in pairs], pa.float64()),
        "positions": pa.array([own[2][1].astype(np.int32) for own, _ in pairs], pa.list_(pa.int32())),
    })
