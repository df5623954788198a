"""The whole pipeline against plain versions of its stages, one after the other."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from hunian.llm import bpe, mixing, neardup, quality
from hunian.llm.base import table
from tests.llm.tables import components
from tests.llm.test_models import plain_quality
from tests.llm.test_tables import plain_rake
from tests.llm.test_texts import plain_personal

FOLDER = "/root/testdata/sf0.001"


def plain_classes(texts):
    """Class of each text: links of weighted Jaccard similarity over all pairs, equal texts without words."""
    words = [re.findall(r"\w+", t.lower()) for t in texts]
    slot = {w: neardup._HASHES[w] % neardup.SLOTS for ws in words for w in ws}
    counts = Counter(s for ws in words for s in {slot[w] for w in ws})
    idf = {w: math.log((len(texts) + 1) / (counts[s] + 1)) + 1 for w, s in slot.items()}
    bags = []
    for ws in words:
        size = min(neardup.WORDS, len(ws))
        times = Counter(tuple(ws[i:i + size]) for i in range(len(ws) - size + 1)) if ws else {}
        bags.append({g: n * sum(idf[w] for w in g) / size for g, n in times.items()})
    links = []
    for i, a in enumerate(bags):
        for j in range(i):
            b = bags[j]
            if not a and not b and texts[i] == texts[j]:
                links.append((i, j))
            elif a and b:
                common = sum(min(w, b[g]) for g, w in a.items() if g in b)
                if common >= neardup.LIKE * (sum(a.values()) + sum(b.values()) - common):
                    links.append((i, j))
    return components(range(len(texts)), links)


def plain_mask(text):
    """Base spans, merged where they overlap, replaced by their first kind."""
    kinds = list(plain_personal(""))
    spans = sorted((start, kinds.index(kind), end) for kind, found in plain_personal(text).items() for start, end in found)
    merged = []
    for start, kind, end in spans:
        if merged and merged[-1][2] > start:
            merged[-1][2] = max(merged[-1][2], end)
        else:
            merged.append([start, kind, end])
    for start, kind, end in reversed(merged):
        text = f"{text[:start]}[{kinds[kind].upper()}]{text[end:]}"
    return text


def plain_mix(rows):
    """Ids that the sample keeps."""
    def topic(text):
        counts = [len(re.findall(pattern, text)) for _, pattern in mixing.TOPICS]
        return mixing.TOPICS[counts.index(max(counts))][0] if max(counts) else mixing.OTHER

    cell = [(r["source"] or "(none)", r["lang"] or "(none)", topic(r["text"])) for r in rows]
    tokens = [len(re.findall(mixing.TOKEN, r["text"])) for r in rows]
    cells = Counter()
    for c, n in zip(cell, tokens):
        cells[c] += n
    cells = {c: n for c, n in cells.items() if n}
    powers = (0.5, 0.7, 0.7)
    _, fitted = plain_rake(cells, [lambda _, w, p=p: w ** p for p in powers], mixing.SHARE, mixing.ROUNDS)
    kept = []
    for r, c in zip(rows, cell):
        draw = int(hashlib.md5(f"{mixing.SEED}:{r['doc_id']}".encode()).hexdigest()[:13], 16) / (1 << 52)
        if draw < (fitted[c] / cells[c] if c in cells else mixing.SHARE):
            kept.append(r)
    return kept


def test_pipeline_equals_plain_stages(spark):
    docs, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    rows = [r.asDict() | {"text": r["text"] or ""} for r in docs.orderBy("doc_id").collect()]
    vectors, network = quality.fit(docs, labels).parts.value
    good = [r for r in rows if plain_quality(r["text"], vectors, network) >= quality.THRESHOLD]
    part = plain_classes([r["text"] for r in good])
    first = [r for n, r in enumerate(good) if part[n] == n]
    iban = re.compile(r"[A-Z]{2}[0-9]{2}")
    masked = [r | {"text": plain_mask(r["text"])} for r in first]
    assert sum(bool(iban.search(r["text"])) for r in first) < len(first) / 10
    mixed = plain_mix(masked)
    peer = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, special_tokens={},
                             mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    wanted = {r["doc_id"]: peer.encode_ordinary(r["text"]) for r in mixed}
    found = {r["doc_id"]: r for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert len(good) < len(rows) and len(first) < len(good) and len(mixed) < len(first)
    assert sorted(found) == sorted(wanted)
    other = {r["doc_id"] for r in first if iban.search(r["text"])}
    for doc_id, ids in wanted.items():
        assert doc_id in other or list(found[doc_id]["ids"]) == ids
        assert found[doc_id]["ids_sha256"] == hashlib.sha256(np.array(found[doc_id]["ids"], "<u4").tobytes()).hexdigest()
