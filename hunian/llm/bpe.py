"""Byte-level BPE by dynamic programming over byte prefixes.

For every prefix of a byte string exactly one token can be the last one of its BPE
encoding. So an encoding is an array with one token per prefix: appending bytes
only extends it, and after an edit in the middle only the entries near the edit
change. Two tokens may stand side by side exactly if merging their joined bytes
gives those two again; a sequence is the BPE encoding if that holds for all its
neighbours.

``encode_documents`` splits each text by the tokenizer's pattern, encodes each
distinct piece once per worker and decodes the ids again. Nothing is shuffled. Null and
empty texts have no tokens. Repeated rows give repeated results, extra columns of
the input are not read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .base import map_batches, texts_of

#: Pieces or token pairs in each of the two generations that a worker remembers.
REMEMBERED = 150_000
#: Code points whose pieces are worked on together.
AT_ONCE = 1_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a ``.tiktoken`` file: base64 bytes and a rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Recent(dict):
    """What was used of late: a full generation becomes the old one, and what is asked for there moves over.

    So frequent entries stay while rare ones go.
    """

    def __init__(self):
        super().__init__()
        self.old: dict = {}

    def put(self, key, value):
        if len(self) >= REMEMBERED:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value

    def find(self, key):
        """The value, or None."""
        value = self.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.put(key, value)
        return value


class Vocabulary:
    """Ranks with the test whether two tokens may be neighbours."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks), default=0)
        self.unranked = max(ranks.values(), default=0) + 1
        #: By ``(before + 1) * unranked + token``, where nothing before is -1: 1 if the token may follow, else 0.
        self.stable = Recent()
        self.bytes_of = np.empty(self.unranked, object)
        for rank, token in self.tokens.items():
            self.bytes_of[rank] = token

    def merged(self, data: bytes) -> list[int]:
        """Plain merging, lowest rank first and leftmost on ties; for short inputs."""
        parts = [data[i:i + 1] for i in range(len(data))]
        never = self.unranked
        rank = self.ranks.get
        joined = [rank(data[i:i + 2], never) for i in range(len(data) - 1)]
        while joined and (best := min(joined)) < never:
            at = joined.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del joined[at]
            if at:
                joined[at - 1] = rank(parts[at - 1] + parts[at], never)
            if at < len(joined):
                joined[at] = rank(parts[at] + parts[at + 1], never)
        return [self.ranks[p] for p in parts]

    def follows(self, before: int, token: int) -> int:
        """1 if ``token`` may follow ``before`` (-1: stand first), else 0; remembered in ``stable``."""
        key = (before + 1) * self.unranked + token
        known = self.stable.find(key)
        if known is None:
            joined = [token] if before < 0 else [before, token]
            known = self.stable.put(key, int(self.merged(b"".join(map(self.tokens.__getitem__, joined))) == joined))
        return known


class Prefixes:
    """A byte string with the last token of each of its prefixes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary = vocabulary
        self.data = data
        self.last: list[int] = []
        self._extend(len(data))

    def append(self, data: bytes) -> None:
        """Add bytes at the end; no entry that is there changes."""
        self.data += data
        self._extend(len(self.data))

    def replace(self, start: int, end: int, data: bytes) -> None:
        """Put ``data`` in place of the bytes from ``start`` to ``end``.

        Entries before ``start`` stay. Behind the edit they are worked out until as
        many as the longest token has bytes repeat the old ones; from there on each
        depends on repeated entries only, so the rest is taken over.
        """
        tail, shift = self.last[end:], start + len(data)
        self.data = self.data[:start] + data + self.data[end:]
        del self.last[start:]
        self._extend(shift)
        same = 0
        for at, old in enumerate(tail):
            self._extend(shift + at + 1)
            same = same + 1 if self.last[-1] == old else 0
            if same >= self.vocabulary.longest:
                self.last += tail[at + 1:]
                break

    def ids(self) -> list[int]:
        found, at = [], len(self.data)
        while at:
            token = self.last[at - 1]
            found.append(token)
            at -= len(self.vocabulary.tokens[token])
        return found[::-1]

    def _extend(self, to: int) -> None:
        data, last, vocabulary = self.data, self.last, self.vocabulary
        rank, known, longest, unranked = vocabulary.ranks.get, vocabulary.stable.get, vocabulary.longest, vocabulary.unranked
        for end in range(len(last) + 1, to + 1):
            # Short tokens first: the one that fits is mostly a few bytes long.
            for start in range(end - 1, max(0, end - longest) - 1, -1):
                token = rank(data[start:end])
                if token is None:
                    continue
                before = last[start - 1] if start else -1
                stable = known((before + 1) * unranked + token)
                if stable or stable is None and vocabulary.follows(before, token):
                    last.append(token)
                    break
            else:
                raise ValueError("The vocabulary lacks a single byte")


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common beginning."""
    end = min(len(a), len(b))
    if a[:end] == b[:end]:
        return end
    for at in range(end):
        if a[at] != b[at]:
            return at
    return end


class Tokenizer:
    """Encoding of whole texts; remembers pieces it has seen of late."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.vocabulary = Vocabulary(ranks)
        self.split = regex.compile(pattern).findall
        self._packed = Recent()

    def packed(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        made, at = [], 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= AT_ONCE):
                size += len(texts[end])
                end += 1
            pieces = [self.split(t) for t in texts[at:end]]
            packed = self._learn(set().union(*pieces))
            made += [b"".join(map(packed.__getitem__, p)) for p in pieces]
            at = end
        return made

    def _learn(self, pieces: set[str]) -> dict[str, bytes]:
        """The packed ids of the pieces.

        New pieces are taken in the order of their bytes, so each keeps the entries of the beginning that it shares with
        the one before and only appends the rest.
        """
        found, ranks = {}, self.vocabulary.ranks.get
        new = []
        for piece in pieces:
            packed = self._packed.find(piece)
            if packed is None:
                new.append((piece.encode(), piece))
            else:
                found[piece] = packed
        new.sort()
        prefixes = Prefixes(self.vocabulary)
        for data, piece in new:
            whole = ranks(data)
            if whole is None:
                same = _shared(prefixes.data, data)
                del prefixes.last[same:]
                prefixes.data = data
                prefixes._extend(len(data))
                ids = prefixes.ids()
            else:
                ids = [whole]
            found[piece] = self._packed.put(piece, struct.pack(f"<{len(ids)}I", *ids))
        return found

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed([text])[0], "<u4").tolist()

    def decode(self, ids: Iterable[int] | np.ndarray) -> bytes:
        return b"".join(self.vocabulary.bytes_of[np.asarray(ids, np.int64)])


_WORKER: dict[str, Tokenizer] = {}


def _tokenizer(key: str, ranks: dict[bytes, int], pattern: str) -> Tokenizer:
    """One tokenizer per worker process, kept from task to task."""
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = Tokenizer(ranks, pattern)
    return _WORKER[key]


def encode_documents(
    docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text", keep_ids: bool = False,
) -> DataFrame:
    """Ids of each text and what they decode to.

    Returns ``key``, ``n_tokens``, ``ids_sha256`` (over little-endian 32-bit ids),
    ``decoded_sha256`` and with ``keep_ids`` also ``ids array<int>`` and ``decoded``. The ranks have a fixed
    size and go to the executors by broadcast, so ``path`` is needed on the driver only.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    def make(batch: pa.RecordBatch) -> dict:
        tokenizer = _tokenizer(f"{path}\0{pattern}", ranks.value, pattern)
        packed = tokenizer.packed(texts_of(batch))
        decoded = [tokenizer.decode(np.frombuffer(p, "<u4")) for p in packed]
        made = {
            key: batch.column("key"),
            "n_tokens": pa.array([len(p) // 4 for p in packed], pa.int64()),
            "ids_sha256": pa.array([hashlib.sha256(p).hexdigest() for p in packed], pa.string()),
            "decoded_sha256": pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string()),
        }
        if keep_ids:
            made["ids"] = pa.array([np.frombuffer(p, "<i4") for p in packed], pa.list_(pa.int32()))
            made["decoded"] = pa.array([d.decode() for d in decoded], pa.string())
        return made

    kind = docs.schema[key].dataType.simpleString()
    extra = ", ids array<int>, decoded string" if keep_ids else ""
    return map_batches(
        docs.select(docs[key].alias("key"), docs[text].alias("text")), make,
        f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{extra}")
