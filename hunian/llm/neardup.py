"""Near duplicates: consistent weighted sampling of TF-IDF shingles, bands, weighted Jaccard.

1. Words' document frequencies, in ``SLOTS`` hashed slots, are counted over all documents.
2. A text is its shingles of ``WORDS`` words. A shingle weighs how often it occurs times the mean
   inverse document frequency of its words. (Taken from the words, a group of copies hardly changes
   it; the frequency of the shingle itself would make a large group's common part nearly weightless.)
3. Improved consistent weighted sampling draws ``BANDS * ROWS`` samples from each text; two texts share a sample
   with the probability of their weighted Jaccard similarity. Texts that share all samples of a band
   are in one bucket. Texts of similarity 0.8 share a bucket with probability 0.9989.
4. Equal texts are one vertex from here on. In every bucket each vertex is paired with the bucket's central one, the one in
   the largest buckets. Pairs that could reach ``LIKE`` by their total weights and their samples are compared by the exact
   weighted similarity of the whole texts; those that reach it are linked. Links make classes.
5. A bucket that still holds several classes is cut into blocks, and every two blocks are compared in a task of their
   own, likewise but for pairs of one class. So every two texts of a bucket end up in one class or have been
   compared. Only links between classes leave a task, never the pairs.

Texts of fewer words than a shingle are one shingle of all their words. Texts without words (null and empty
ones included) are near only to equal texts, null counting as empty. Repeated rows are copies. An empty table gives no rows. Extra columns
of the input are not read. Every class is named by the smallest ``doc_id`` in it; null ids get a class like any other.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import cut, emptied_with_task, ending, give_back, map_batches, text_or_empty, texts_of

WORDS, LIKE = 5, 0.8
BANDS, ROWS = 13, 4
SLOTS, SEED = 1 << 18, 3
#: Shingles sampled at a time, so that the arrays stay in the processor's caches.
AT_ONCE = 30_000
#: Words whose hash one worker remembers before it starts anew.
REMEMBERED = 150_000
#: Samples that two texts must share to be compared; the number shared by texts of similarity ``LIKE`` is binomial.
SHARED = 26
#: Vertices of a bucket that are compared with as many others in one task.
BLOCK = 512

_WORD = re.compile(r"\w+").findall
_ONE, _TWO = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class _Hashes(dict):
    """Word to a 64-bit number whose low bits are its slot."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        digest = hashlib.blake2b(word.encode(), digest_size=8).digest()
        value = self[word] = int.from_bytes(digest, "little")
        return value


_HASHES = emptied_with_task(_Hashes())


def words_of(text: str) -> list[str]:
    return _WORD(text.lower())


def _hashed(words: list[str]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(SLOTS - 1)).astype(np.int64)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that hold a word of each slot, and the number of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS + 1, np.int64)
        for batch in batches:
            counts[SLOTS] += batch.num_rows
            texts = texts_of(batch)
            for at in range(0, len(texts), 500):
                sets = [set(words_of(t)) for t in texts[at:at + 500]]
                slots = _slots(_hashed([w for words in sets for w in words]))
                # A document counts once for a slot, however many of its words share it.
                held = np.repeat(np.arange(len(sets)), [len(words) for words in sets]) * SLOTS + slots
                held.sort()
                once = held[np.append(True, held[1:] != held[:-1])[:len(held)]]
                counts[:SLOTS] += np.bincount(once % SLOTS, minlength=SLOTS)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"slot": pa.array(seen, pa.int32()), "docs": pa.array(counts[seen])})

    total = docs.select("text").mapInArrow(ending(run), "slot int, docs long").groupBy("slot").agg(F.sum("docs").alias("docs")).toArrow()
    counts = np.zeros(SLOTS + 1, np.int64)
    counts[total["slot"].to_numpy()] = total["docs"].to_numpy()
    return counts[:SLOTS], int(counts[SLOTS])


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    counts, rows = document_frequencies(docs)
    return np.log((rows + 1) / (counts + 1)) + 1


def shingles(text: str, idf: np.ndarray, counts: bool = False) -> tuple[np.ndarray, ...]:
    """Distinct shingle hashes in order, their weights and with ``counts`` how often each occurs."""
    hashed = _hashed(words_of(text))
    if not len(hashed):
        return np.zeros(0, np.uint64), np.zeros(0), *([np.zeros(0, np.int64)] if counts else [])
    size = min(WORDS, len(hashed))
    weights = idf[_slots(hashed)]
    n = len(hashed) - size + 1
    joined, weight = np.zeros(n, np.uint64), np.zeros(n)
    for i in range(size):
        joined = (joined ^ (joined >> np.uint64(29))) * _ONE + hashed[i:i + n]
        weight += weights[i:i + n]
    found, first, times = np.unique(joined, return_index=True, return_counts=True)
    return found, weight[first] / size * times, *([times] if counts else [])


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two shingle sets: sum of the smaller over sum of the larger weights."""
    _, left, right = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = np.minimum(a[1][left], b[1][right]).sum()
    both = a[1].sum() + b[1].sum() - common
    return float(common / both) if both > 0 else 0.0


class Sampler:
    """Improved consistent weighted sampling with drawn values looked up by parts of a hash."""

    def __init__(self, samples: int = BANDS * ROWS):
        random = np.random.default_rng(SEED)
        self.rate = random.gamma(2, 1, 1 << 16).astype(np.float32)
        self.shift = random.random(1 << 16, np.float32)
        self.level = np.log(random.gamma(2, 1, 1 << 16)).astype(np.float32)
        self.seeds = random.integers(0, 1 << 63, samples, np.uint64)

    def samples(self, hashes: np.ndarray, weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """A 64-bit sample for each segment (row) and seed (column); segments are not empty."""
        log = np.log(weights).astype(np.float32)
        counts = np.diff(np.append(starts, len(hashes)))
        made = np.empty((len(starts), len(self.seeds)), np.uint64)
        for k, seed in enumerate(self.seeds):
            mixed = (hashes ^ seed) * _ONE
            mixed ^= mixed >> np.uint64(32)
            mixed *= _TWO
            parts = mixed.view(np.uint16).reshape(-1, 4)
            rate, shift = self.rate.take(parts[:, 1]), self.shift.take(parts[:, 2])
            step = np.floor(log / rate + shift)
            value = self.level.take(parts[:, 3]) - rate * (step - shift + 1)
            least = np.minimum.reduceat(value, starts)
            at = np.flatnonzero(value == np.repeat(least, counts))
            at = at[np.searchsorted(at, starts)]
            made[:, k] = (hashes[at] ^ (step[at].astype(np.int64).view(np.uint64) * _TWO)) * _ONE
        return made


def bands(texts: list[str], idf: np.ndarray, sampler: Sampler) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Band keys and 16 bits of each sample (a row per text; 0 where it has no words), and each text's total weight."""
    keys = np.zeros((len(texts), BANDS), np.uint64)
    marks = np.zeros((len(texts), BANDS * ROWS), np.uint16)
    totals = np.zeros(len(texts))
    group, places, size = [], [], 0

    def flush() -> None:
        nonlocal group, places, size
        if group:
            counts = np.array([len(h) for h, _ in group])
            drawn = sampler.samples(
                np.concatenate([h for h, _ in group]), np.concatenate([w for _, w in group]), np.cumsum(counts) - counts)
            joined = np.zeros((len(group), BANDS), np.uint64)
            for row in range(ROWS):
                joined = (joined ^ (joined >> np.uint64(31))) * _TWO + drawn[:, row::ROWS]
            marks[places] = drawn >> np.uint64(48)
            keys[places] = (joined + np.arange(1, BANDS + 1, dtype=np.uint64) * _ONE) | np.uint64(1)
        group, places, size = [], [], 0

    for place, text in enumerate(texts):
        made = shingles(text, idf)
        if len(made[0]):
            group.append(made)
            places.append(place)
            size += len(made[0])
            totals[place] = made[1].sum()
        if size >= AT_ONCE:
            flush()
    flush()
    return keys, marks, totals


def _identity(text: str) -> bytes:
    """Equal for texts with the same words in the same order; texts without words count as they are."""
    return hashlib.blake2b((" ".join(words_of(text)) or f"\0{text}").encode(), digest_size=16).digest()


def signatures(docs: DataFrame, idf: Broadcast) -> DataFrame:
    """``doc_id, place, ident, total, keys, marks`` of each row; ``place`` finds the row's text again."""
    sampler: list[Sampler] = []

    def make(batch: pa.RecordBatch) -> dict:
        if not sampler:
            sampler.append(Sampler())
        texts = texts_of(batch)
        keys, marks, totals = bands(texts, idf.value, sampler[0])
        return {
            "doc_id": batch.column("doc_id"), "place": batch.column("place"),
            "ident": pa.array([_identity(t) for t in texts], pa.binary()), "total": pa.array(totals),
            "keys": pa.ListArray.from_arrays(
                pa.array(np.arange(len(texts) + 1, dtype=np.int32) * BANDS), pa.array(keys.view(np.int64).ravel())),
            "marks": pa.ListArray.from_arrays(
                pa.array(np.arange(len(texts) + 1, dtype=np.int32) * BANDS * ROWS), pa.array(marks.view(np.int16).ravel())),
        }

    return map_batches(docs.select("doc_id", _place().alias("place"), "text"), make,
                       "doc_id long, place long, ident binary, total double, keys array<long>, marks array<smallint>")


def _place() -> Column:
    """Of a row's id and text; equal rows share it."""
    return F.xxhash64("doc_id", "text")


def verified(pairs: DataFrame, texts: DataFrame, idf: Broadcast) -> DataFrame:
    """The pairs (``a``, ``b``) whose texts reach ``LIKE``."""
    left = texts.select(F.col("ident").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("ident").alias("b"), F.col("text").alias("text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: tuple = (None, None)  # rows with one b come together
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            kept = []
            for i, (x, y) in enumerate(zip(batch.column("text_a"), batch.column("text_b"))):
                if known[0] != b[i]:
                    known = (b[i], shingles(y.as_py(), idf.value))
                if similarity(shingles(x.as_py(), idf.value), known[1]) >= LIKE:
                    kept.append(i)
            yield pa.RecordBatch.from_pydict({
                "a": pa.array([a[i] for i in kept], pa.binary()), "b": pa.array([b[i] for i in kept], pa.binary())})

    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(
        ending(run), "a binary, b binary").distinct()


def roots(links: DataFrame) -> DataFrame:
    """``ident, root`` for every vertex of ``links`` (``a``, ``b``): the smallest vertex of its component.

    Stars are drawn to the smallest neighbour, of all and then of the smaller ones, until
    the links repeat. Folds are map-side, so a vertex with very many links is no burden.
    """
    links = cut(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), small=True)
    state = None
    while not links.isEmpty():
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("x")).select(
            F.col("x.a").alias("a"), F.col("x.m").alias("b")).filter("a != b").distinct()
        links = cut(small, small=True)
        now = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1_000_003)).first()
        if now == state:
            break
        state = now
    return links.select(F.col("a").alias("ident"), F.col("b").alias("root"))


def _links_across(rows: pa.Table, idf: np.ndarray) -> pa.Table:
    """Links that join classes (by their roots ``a``, ``b``) between the two blocks of a group, or within its one block.

    Pairs that the totals and samples leave open are compared exactly: a shingle that occurs n times is
    n elements of equal weight, so the common weight of two texts is a sum over the elements both have.
    """
    second = rows["second"].to_numpy()
    one = bool(second.any() and not second.all())
    roots_, totals = rows["root"].to_pylist(), rows["total"].to_numpy()
    marks = rows["marks"].combine_chunks().flatten().to_numpy().reshape(len(totals), -1)
    number = {r: n for n, r in enumerate(dict.fromkeys(roots_))}
    of_root = np.array([number[r] for r in roots_])
    left = np.flatnonzero(~second) if one else np.arange(len(totals))
    right = np.flatnonzero(second) if one else left
    open_pairs = []
    for at in left:
        others = right if one else right[right > at]
        others = others[of_root[others] != of_root[at]]
        others = others[np.minimum(totals[others], totals[at]) >= np.maximum(totals[others], totals[at]) * (LIKE - 1e-9)]
        others = others[(marks[others] == marks[at]).sum(axis=1) >= SHARED]
        open_pairs.append(np.stack([np.full(len(others), at), others], axis=1))
    pairs = np.concatenate(open_pairs) if open_pairs else np.zeros((0, 2), np.int64)
    links: dict[tuple[bytes, bytes], None] = {}
    if len(pairs):
        used = np.unique(pairs)
        common = _common_weights([rows["text"][int(i)].as_py() for i in used], idf)
        a, b = np.searchsorted(used, pairs[:, 0]), np.searchsorted(used, pairs[:, 1])
        shared = common[a, b]
        whole = totals[pairs[:, 0]] + totals[pairs[:, 1]] - shared
        for x, y in pairs[shared >= LIKE * whole - 1e-9]:
            links[max(roots_[x], roots_[y]), min(roots_[x], roots_[y])] = None
    if len(totals) >= BLOCK // 4:
        give_back()
    return pa.table({
        "a": pa.array([a for a, _ in links], pa.binary()), "b": pa.array([b for _, b in links], pa.binary())})


def _common_weights(texts: list[str], idf: np.ndarray) -> np.ndarray:
    """For every two of the texts the sum of the smaller weights."""
    elements, weights, owners = [], [], []
    for n, text in enumerate(texts):
        hashes, weight, times = shingles(text, idf, counts=True)
        level = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        elements.append(np.repeat(hashes, times) + level.astype(np.uint64) * _TWO)
        weights.append(np.repeat(weight / times, times))
        owners.append(np.full(len(level), n))
    elements, weights, owners = map(np.concatenate, (elements, weights, owners))
    _, first, column, times = np.unique(elements, return_index=True, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(times > 1)
    place = np.full(len(times), -1)
    place[shared] = np.arange(len(shared))
    column, weight = place[column], np.sqrt(weights[first[shared]])
    made = np.zeros((len(texts), len(texts)))
    for start in range(0, len(shared), 4096):
        inside = (column >= start) & (column < start + 4096)
        part = np.zeros((len(texts), min(4096, len(shared) - start)))
        part[owners[inside], column[inside] - start] = weight[column[inside]]
        made += part @ part.T
    return made


def _alike(a: Column, b: Column) -> Column:
    """Whether two vertices' infos (``total``, ``marks``) leave room for a similarity of ``LIKE``.

    The similarity is at most the smaller total over the larger. Of two texts that reach ``LIKE``, fewer than
    ``SHARED`` samples agree with a probability below one in a million.
    """
    equal = F.aggregate(
        F.zip_with(a["marks"], b["marks"], lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    return (F.least(a["total"], b["total"]) >= F.greatest(a["total"], b["total"]) * (LIKE - 1e-9)) & (equal >= SHARED)


def classes(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``class_id`` and ``copies``, the number of rows with equal words, for each row of ``docs``."""
    rows, named = _classed(docs)
    return rows.select("doc_id", "ident").join(named, "ident").select("doc_id", "class_id", "copies")


def representatives(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each class, one with the smallest id, with all its columns."""
    rows, named = _classed(docs)
    # One place for each class: the vertices' first places are pre-aggregated, and texts are not moved for it.
    firsts = named.groupBy("root").agg(F.min("first").alias("first")).select(
        F.col("first.doc_id").alias("_doc_id"), F.col("first.place").alias("_place"))
    placed = docs.select(
        F.struct("*").alias("row"), F.xxhash64(F.col("doc_id").cast("long"), text_or_empty()).alias("_row_place"))
    kept = placed.join(firsts, placed["_row_place"] == firsts["_place"], "left_semi")
    # Rows that are equal in id and text are still several; any one of them stays.
    return kept.dropDuplicates(["_row_place"]).select("row.*")


def _classed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Signatures of all rows, and for each vertex its class, its copies and its first row."""
    context = docs.sparkSession.sparkContext
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    idf = context.broadcast(inverse_frequencies(docs))
    rows = cut(signatures(docs, idf))
    vertices = cut(rows.groupBy("ident").agg(
        F.min(F.struct("doc_id", "place")).alias("first"), F.first(F.struct("total", "marks")).alias("info"),
        F.first("keys").alias("keys"), F.count("*").alias("copies")))
    members = vertices.filter("info.total > 0").select("ident", F.explode("keys").alias("key"))
    sizes = members.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    buckets = _by_key(members, sizes)
    # The text others were made from shares more with each of them than they do with one another, so it is in large buckets.
    rank = buckets.groupBy("ident").agg(F.sum("size").alias("rank"))
    buckets = buckets.join(rank, "ident")
    centres = buckets.groupBy("key").agg(F.max(F.struct("rank", "ident")).alias("centre")).select("key", "centre.ident")
    # Buckets of several vertices: each vertex with the bucket's central one.
    buckets = cut(_by_key(buckets, centres.withColumnRenamed("ident", "centre")).select("key", "ident", "size", "centre"))
    info = vertices.select("ident", "info")

    def with_info(rows: DataFrame, vertex: str, name: str) -> DataFrame:
        return rows.join(info.select(F.col("ident").alias(vertex), F.col("info").alias(name)), vertex)

    pairs = buckets.filter("ident != centre").select(F.col("ident").alias("a"), F.col("centre").alias("b")).distinct()
    pairs = with_info(with_info(pairs, "a", "x"), "b", "y").filter(_alike(F.col("x"), F.col("y"))).select("a", "b")
    texts = cut(docs.withColumn("place", _place()).join(
        vertices.join(buckets.select("ident").distinct(), "ident", "left_semi").select("ident", "first.place"), "place",
    ).select("ident", "text").dropDuplicates(["ident"]))
    found = roots(verified(pairs, texts, idf))

    # Buckets that still hold several classes, cut into pairs of blocks.
    classed = cut(_with_root(buckets.select("key", "ident", "size"), found, "ident", "root"))
    several = classed.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most")).filter("least != most")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("ident"), F.col("blocks")).cast("int")
    placed = with_info(_by_key(classed, several.select("key")), "ident", "info").join(texts, "ident").withColumn(
        "blocks", blocks).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).alias("second"),
        "ident", "root", "info.total", "info.marks", "text")
    late = placed.groupBy("key", "i", "j").applyInArrow(
        lambda rows: _links_across(rows, idf.value), "a binary, b binary").distinct()
    joined = roots(late).select(F.col("ident").alias("root"), F.col("root").alias("last"))

    grouped = _with_root(vertices.select("ident", "first", "copies"), found, "ident", "root")
    grouped = cut(grouped.join(joined, "root", "left").select(
        "ident", "first", "copies", F.coalesce("last", "root").alias("root")))
    named = grouped.groupBy("root").agg(F.min("first.doc_id").alias("class_id"))
    return rows, grouped.join(named, "root").select("ident", "root", "first", "class_id", "copies")


def _by_key(rows: DataFrame, buckets: DataFrame) -> DataFrame:
    """``rows`` of buckets joined with one row for each of some buckets.

    Those come from an aggregate by key. Joined by the key and its hash, both sides come straight from a shuffle,
    so AQE can split the rows of a large bucket.
    """
    others = [c for c in buckets.columns if c != "key"]
    named = buckets.select(F.col("key").alias("_key"), F.xxhash64("key").alias("_hash"), *others)
    return rows.join(named, (F.col("key") == F.col("_key")) & (F.xxhash64("key") == F.col("_hash"))).select(*rows.columns, *others)


def _with_root(rows: DataFrame, found: DataFrame, vertex: str, name: str) -> DataFrame:
    named = found.select(F.col("ident").alias("_vertex"), F.col("root").alias("_root"))
    return rows.join(named, rows[vertex] == F.col("_vertex"), "left").withColumn(
        name, F.coalesce("_root", vertex)).drop("_vertex", "_root")

