"""Ranked lexical search by the Best Position Algorithm.

Documents are cut into shards of at most ``SHARD``, as they are read. A shard holds, for each term that some item asks for, an impact
list: its documents by falling share of the score, and beside it all such terms of each document for direct accesses. Term statistics are
those of all documents, so scores are the same as from one long list; nothing but statistics and answers leaves a shard.

An item reads its lists in step. A document met in any list gets its whole score by direct accesses, which also tell its positions in the
others, so in each list positions are seen out of turn. The best position of a list is the last one before which all are
seen. An unseen document can score no more than the sum of the impacts at the best positions (zero for a list that is
seen to its end); reading stops once that sum is strictly below the k-th best score, so equal scores are never cut.
The k-th best score starts from what all shards found in a first short reading of their lists.

Items are worked off in blocks of at most ``PAIRS`` terms (a longer item is a block of its own), so what the driver and the
broadcasts hold is bounded however many items there are.

Null and empty texts have no terms; an item without terms, or with an id but a null text, has no answers. Rows of items with the same
id and text are one item; other rows with that id are answered as one item with all their terms. Null ids of items count as an id. Repeated documents are
documents, listed each; a null doc_id comes last among equal scores. Empty tables give no rows. Extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import cut, ending

#: Documents in a shard, and tokens from which on one is closed earlier.
SHARD, SHARD_TOKENS = 16_384, 8_000_000
#: (item, term) pairs worked on at a time.
PAIRS = 200_000
#: Positions of each list read in the first short reading and at first in the second.
FIRST = 16
COUNT = 50

_NULL = np.iinfo(np.int64).max
#: Bytes from 0x80 on belong to letters beyond ASCII; A to Z are lower-cased, all other ASCII separates.
_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and everything beyond ASCII; only A to Z are lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_BYTES).split()


@dataclass
class Asked:
    """A block of items: their terms as numbers."""

    items: list[int | None]
    #: Numbers of each item's distinct terms.
    wanted: list[np.ndarray]
    numbers: dict[bytes, int]


def blocks(items: DataFrame, key: str, text: str) -> Iterator[Asked]:
    """Items in the order of their ids, as many at a time as have ``PAIRS`` terms; the driver reads them one by one."""
    rows = items.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).distinct().orderBy("key", "text")
    at: dict[int | None, dict[bytes, None]] = {}
    pairs = 0
    for row in rows.toLocalIterator():
        if row["key"] not in at and pairs >= PAIRS:
            yield _numbered(at)
            at, pairs = {}, 0
        own = at.setdefault(row["key"], {})
        before = len(own)
        own.update(dict.fromkeys(terms(row["text"])))
        pairs += len(own) - before
    if at:
        yield _numbered(at)


def _numbered(at: dict[int | None, dict[bytes, None]]) -> Asked:
    numbers: dict[bytes, int] = {}
    wanted = [np.array(sorted(numbers.setdefault(t, len(numbers)) for t in own), np.int32) for own in at.values()]
    return Asked(list(at), wanted, numbers)


def shards(docs: DataFrame, asked) -> DataFrame:
    """One row for each shard: its postings by (term, document), the documents' ids and numbers of terms, and its totals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = asked.value.numbers.get
        ids, lengths, term, owner, held = [], [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal ids, lengths, term, owner, held
            pair = np.concatenate([*term, np.zeros(0, np.int64)]) * SHARD + np.concatenate([*owner, np.zeros(0, np.int64)])
            pair, times = np.unique(pair, return_counts=True)
            packed = {"term": pair // SHARD, "doc": pair % SHARD, "times": times, "ids": np.array(ids, np.int64),
                      "lengths": np.array(lengths, np.int64)}
            row = {k: pa.array([v.astype("<i8" if k in ("ids", "lengths") else "<i4").tobytes()], pa.binary()) for k, v in packed.items()}
            row["docs"] = pa.array([int(np.count_nonzero(packed["lengths"]))], pa.int64())
            row["tokens"] = pa.array([int(packed["lengths"].sum())], pa.int64())
            ids, lengths, term, owner, held = [], [], [], [], 0
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                words = terms(text.as_py())
                found = np.array([n for n in map(number, words) if n is not None], np.int64)
                term.append(found)
                owner.append(np.full(len(found), len(ids), np.int64))
                ids.append(_NULL if doc_id is None else doc_id)
                lengths.append(len(words))
                held += len(words)
                if len(ids) == SHARD or held >= SHARD_TOKENS:
                    yield flush()
        if ids:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(
        ending(run), "term binary, doc binary, times binary, ids binary, lengths binary, docs long, tokens long")


def document_frequencies(made: DataFrame, terms_: int) -> np.ndarray:
    """Documents of all shards that hold each asked term; tasks return a sum each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(terms_, np.int64)
        for batch in batches:
            for packed in batch.column("term"):
                counts += np.bincount(np.frombuffer(packed.as_py(), "<i4"), minlength=terms_)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"term": pa.array(seen, pa.int32()), "df": pa.array(counts[seen])})

    total = made.select("term").mapInArrow(ending(run), "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    counts = np.zeros(terms_, np.int64)
    counts[total["term"].to_numpy()] = total["df"].to_numpy()
    return counts


def weights(frequencies: np.ndarray, docs: int) -> np.ndarray:
    return np.floor(1000 * np.log((2 * docs + 2) / (2 * frequencies + 1))).astype(np.int64)


class Shard:
    """Impact lists of a shard and the terms of each of its documents."""

    def __init__(self, row: dict, weight: np.ndarray, docs: int, tokens: int):
        term, doc, times = (np.frombuffer(row[n], "<i4").astype(np.int64) for n in ("term", "doc", "times"))
        self.ids, lengths = (np.frombuffer(row[n], "<i8") for n in ("ids", "lengths"))
        m = 50 + (50 * lengths * docs) // max(tokens, 1)
        impact = weight[term] * ((1_000_000_000 * times) // (1000 * times + 20 * m[doc]))
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact = doc[order], impact[order]
        self.start = np.searchsorted(term, np.arange(len(weight) + 1))  # postings come by term
        order = np.lexsort((term, doc))
        self.of_doc, self.of_doc_impact = term[order], impact[order]
        self.doc_start = np.searchsorted(doc[order], np.arange(len(self.ids) + 1))
        self.asked = np.zeros(len(weight), bool)

    def scores(self, docs: np.ndarray) -> np.ndarray:
        """Direct accesses: whole scores of documents for the item whose terms are in ``asked``."""
        start, count = self.doc_start[docs], self.doc_start[docs + 1] - self.doc_start[docs]
        ends = np.cumsum(count)
        at = np.repeat(start - ends + count, count) + np.arange(ends[-1] if len(ends) else 0)
        gained = np.where(self.asked[self.of_doc[at]], self.of_doc_impact[at], 0)
        return np.add.reduceat(gained, ends - count) if len(docs) else np.zeros(0, np.int64)

    def best(self, wanted: np.ndarray, count: int, floor: int, deepest: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of all that may be among the ``count`` best; ``floor`` is what the k-th has at least.

        With ``deepest`` reading ends at that position of each list.
        """
        begins, ends = self.start[wanted], self.start[wanted + 1]
        begins, ends = begins[ends > begins], ends[ends > begins]
        self.asked[wanted] = True
        seen = np.zeros(len(self.ids), bool)
        found, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        best = begins.copy()  # the first unseen position of each list
        top = np.zeros(0, np.int64)
        depth, step = 0, FIRST
        while True:
            upto = np.minimum(begins + depth + step, ends)
            part = [self.doc[b:e] for b, e in zip(np.minimum(begins + depth, ends).tolist(), upto.tolist()) if e > b]
            new = np.unique(np.concatenate(part)) if part else np.zeros(0, np.int64)
            new = new[~seen[new]]
            seen[new] = True
            got = self.scores(new)
            found.append(new)
            scores.append(got)
            top = np.sort(np.concatenate([top, got]))[-count:]
            depth, step = depth + step, depth + step
            least = max(floor, int(top[0]) if len(top) == count else 0)
            limit = 0
            for n, (at, end) in enumerate(zip(best.tolist(), ends.tolist())):
                ahead = FIRST
                while at < end:
                    run = seen[self.doc[at:min(at + ahead, end)]]
                    if not run.all():
                        at += int(np.argmin(run))
                        break
                    at, ahead = at + len(run), ahead * 4
                best[n] = at
                limit += 0 if at == end else int(self.impact[at - 1]) if at > begins[n] else int(self.impact[at])
            if limit < least or limit == 0 or (best == ends).all() or deepest is not None and depth >= deepest:
                break
        self.asked[wanted] = False
        found, scores = np.concatenate(found), np.concatenate(scores)
        keep = scores >= max(1, least)
        return found[keep], scores[keep]


def _answers(made: DataFrame, asked, statistics, count: int, floors=None) -> DataFrame:
    """``item``, ``doc_id`` and ``score`` of what each task's shards hold of the ``count`` best; without ``floors`` a short reading."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, docs, tokens = statistics.value
        items = asked.value
        kept = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(items.items)
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row, weight, docs, tokens)
                for n, wanted in enumerate(items.wanted):
                    floor = int(floors.value[n]) if floors is not None else 0
                    found, scores = shard.best(wanted, count, floor, None if floors is not None else FIRST)
                    ids, scores = np.concatenate([kept[n][0], shard.ids[found]]), np.concatenate([kept[n][1], scores])
                    order = np.lexsort((ids, -scores))[:count]
                    kept[n] = ids[order], scores[order]
        sizes = [len(k[0]) for k in kept]
        yield pa.RecordBatch.from_pydict({
            "item": pa.array(np.repeat(np.arange(len(kept)), sizes), pa.int32()),
            "doc_id": pa.array(np.concatenate([k[0] for k in kept]) if kept else [], pa.int64()),
            "score": pa.array(np.concatenate([k[1] for k in kept]) if kept else [], pa.int64())})

    rows = made.select("term", "doc", "times", "ids", "lengths").mapInArrow(ending(run), "item int, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)


def search(
    docs: DataFrame, items: DataFrame, count: int = COUNT, key: str = "item_id", text: str = "text",
) -> DataFrame:
    """``item_id``, ``rank`` from 1, ``doc_id`` and ``score`` of the ``count`` best documents of each item, all with a score above 0."""
    spark = docs.sparkSession
    context = spark.sparkContext
    answers = spark.createDataFrame([], f"`{key}` long, rank int, doc_id long, score long")
    for block in blocks(items, key, text):
        if not block.numbers:
            continue
        asked = context.broadcast(block)
        made = cut(shards(docs, asked))
        total = made.agg(F.sum("docs"), F.sum("tokens")).first()
        if not total[1]:
            continue
        weight = weights(document_frequencies(made, len(block.numbers)), total[0])
        statistics = context.broadcast((weight, total[0], total[1]))
        floors = np.zeros(len(block.items), np.int64)
        first = _answers(made, asked, statistics, count).filter(F.col("rank") == count).select("item", "score").toArrow()
        floors[first["item"].to_numpy()] = first["score"].to_numpy()
        found = _answers(made, asked, statistics, count, context.broadcast(floors))
        names = spark.createDataFrame(list(enumerate(block.items)), f"item int, `{key}` long")
        answers = answers.union(found.join(names, "item").select(
            key, "rank", F.when(F.col("doc_id") != F.lit(_NULL), F.col("doc_id")).alias("doc_id"), "score"))
    return answers
