"""Operators that work within a document: encoding, fingerprints, secrets, personal data."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from hunian.llm import bpe, catalog, pii, secrets, spans, winnow
from tests.llm.tables import no_documents, odd_documents

FOLDER = "/root/testdata/sf0.001"
RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
TOKENIZER = bpe.Tokenizer(RANKS, public_tokenizers.PATTERN)
PEER = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def sha(data):
    return hashlib.sha256(data).hexdigest()


# Byte-level BPE

@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_ids_are_those_of_plain_merging_and_decode_to_the_text(text):
    ids = TOKENIZER.encode(text)
    assert ids == PEER.encode_ordinary(text)
    assert TOKENIZER.decode(ids) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=40), st.binary(max_size=12), st.integers(0, 40), st.integers(0, 40))
def test_prefixes_after_appends_and_edits_equal_those_worked_out_anew(data, new, a, b):
    a, b = sorted((min(a, len(data)), min(b, len(data))))
    vocabulary = TOKENIZER.vocabulary
    table = bpe.Prefixes(vocabulary, data)
    table.append(new)
    assert table.last == bpe.Prefixes(vocabulary, data + new).last
    table.replace(a, b, new)
    edited = data[:a] + new + data[b:] + new
    assert (table.data, table.last) == (edited, bpe.Prefixes(vocabulary, edited).last)
    assert table.ids() == vocabulary.merged(edited)


def test_an_edit_in_a_long_text_takes_over_what_follows():
    table = bpe.Prefixes(TOKENIZER.vocabulary, b"abc def " * 400)
    table.replace(8, 11, b"xyz1")
    assert table.last == bpe.Prefixes(TOKENIZER.vocabulary, table.data).last


def test_long_piece():
    assert TOKENIZER.encode("a" * 3001 + "bc" * 3000) == PEER.encode_ordinary("a" * 3001 + "bc" * 3000)


def test_encoding_query(spark):
    found = {r["doc_id"]: r for r in catalog.QUERIES["op9_byte_bpe"](spark, FOLDER).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in documents(spark).collect()}
    assert found.keys() == texts.keys()
    for key, text in texts.items():
        ids = PEER.encode_ordinary(text)
        row = found[key]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == sha(np.array(ids, "<u4").tobytes())
        assert row["decoded_sha256"] == sha(text.encode())


def test_encoding_odd_rows(spark):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = bpe.encode_documents(odd_documents(spark), path, public_tokenizers.PATTERN, keep_ids=True).collect()
    assert len(rows) == 16
    assert all(r["ids"] == PEER.encode_ordinary(r["decoded"]) for r in rows)
    assert {r["doc_id"]: r["n_tokens"] for r in rows}[3] == 0
    assert bpe.encode_documents(no_documents(spark), path, public_tokenizers.PATTERN).count() == 0


# Winnowing

def plain_winnow(text, gram, window):
    n = len(text) - gram + 1
    if n <= 0:
        return [0] if text else []
    hashes = [
        int(winnow.gram_hashes(np.frombuffer(text[i:i + gram].encode("utf-32-le"), np.uint32), gram)[0]) for i in range(n)]
    found = []
    for i in range(max(1, n - window + 1)):
        part = hashes[i:i + window]
        at = i + max(j for j, v in enumerate(part) if v == min(part))
        found += [] if found and found[-1] == at else [at]
    return found


@pytest.mark.parametrize("gram, window", [(5, 7), (4, 8), (6, 1), (1, 3), (3, 5)])
def test_positions_are_the_rightmost_minima(gram, window):
    random.seed(gram)
    texts = ["".join(random.choice("abé😀 ") for _ in range(random.choice([0, 1, 5, 9, 12, 40, 90]))) for _ in range(150)]
    for text, (hashes, positions) in zip(texts, winnow.winnow(texts, gram, window)):
        assert list(positions) == plain_winnow(text, gram, window)
        assert len(hashes) == len(positions)


@settings(max_examples=100, deadline=None)
@given(st.text("abcdef ", min_size=15, max_size=15), st.text("xyz", max_size=30), st.text("uvw", max_size=30))
def test_a_shared_run_of_the_guaranteed_length_is_matched(run, before, after):
    one, other = winnow.winnow([before + run + after, after + run + before], 6, 10)
    assert np.intersect1d(one[0], other[0]).size


def plain_edits(docs):
    """Next texts by descending id, after the last the first."""
    texts = [t for _, t in docs]
    result = {}
    for i, (key, text) in enumerate(docs):
        half = len(text) // 2
        result[key] = text[:len(text) - half] + texts[(i + 1) % len(texts)][:half]
    return result


@pytest.mark.parametrize("blocks", [1, 7])
def test_edited_fingerprints(spark, blocks):
    docs = sorted(((r["doc_id"], r["text"] or "") for r in documents(spark).collect()), reverse=True)
    edits, texts = plain_edits(docs), dict(docs)
    rows = winnow.edited_fingerprints(documents(spark), blocks).collect()
    assert len(rows) == len(docs)
    for row in rows:
        key = row["doc_id"]
        own, edited = winnow.winnow([texts[key], edits[key]])
        assert row["n_chars"] == len(texts[key]) and row["edited_sha256"] == sha(edits[key].encode())
        assert (row["fingerprint"], row["edited_fingerprint"]) == (winnow.as_text(own[0]), winnow.as_text(edited[0]))
        assert row["near_edited"] == winnow.likeness(own[0], edited[0])


def test_edited_copies_of_short_texts_are_found():
    random.seed(3)
    for size in range(46, 200):
        text, after = ("".join(random.choice("abcdefghij ") for _ in range(size)) for _ in range(2))
        own, edited = winnow.winnow([text, text[:size - size // 2] + after[:size // 2]])
        assert winnow.likeness(own[0], edited[0]) > 0, size


def test_fingerprints_of_odd_rows(spark):
    rows = winnow.edited_fingerprints(odd_documents(spark), 3).collect()
    assert len(rows) == 16 and all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    by_text = {}
    for r in winnow.fingerprints(odd_documents(spark)).collect():
        by_text.setdefault(r["doc_id"], []).append(r["hashes"])
    assert by_text[2] == by_text[3] == [[]]
    assert winnow.edited_fingerprints(no_documents(spark)).count() == 0
    one = winnow.edited_fingerprints(odd_documents(spark).limit(1)).first()
    assert one["near_next"] == 1.0


def plain_marks(text):
    """Hashes of the grams at the plain positions, each hashed as a text of its own."""
    size = min(winnow.GRAM, len(text))
    return {int(winnow.winnow([text[p:p + size]], winnow.GRAM, winnow.WINDOW)[0][0][0]) for p in plain_winnow(text, winnow.GRAM, winnow.WINDOW)}


def test_likeness_to_the_next_and_the_edited_text_equals_the_plain_version(spark):
    random.seed(6)
    texts = ["".join(random.choice("abc de") for _ in range(random.randint(0, 90))) for _ in range(25)]
    texts += [texts[3] + " and more", texts[3], ""]
    rows = {r["doc_id"]: r for r in winnow.edited_fingerprints(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 4).collect()}
    for i, text in enumerate(texts):
        after = texts[i - 1] if i else texts[-1]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        own, next_, other = map(plain_marks, (text, after, edited))
        for name, b in (("near_next", next_), ("near_edited", other)):
            wanted = len(own & b) / len(own | b) if own | b else 1.0
            assert rows[i][name] == pytest.approx(wanted), (i, name)


# Secrets and personal data

def matched(pattern, text, keep=lambda m: True, flags=0):
    return [m.span() for m in re.finditer(pattern, text, flags) if keep(m)]


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 * (v > 9) for v in doubled) % 10 == 0


def digits(m):
    return re.sub("[^0-9]", "", m.group())


def plain_personal(text):
    return {
        "email": matched(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text),
        "ip": matched(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text, lambda m: all(int(p) <= 255 for p in m.group().split("."))),
        "card": matched(r"[0-9]([\x20-]?[0-9])+", text, lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
        "phone": matched(r"\+[0-9][\x20().0-9-]+[0-9]", text, lambda m: 9 <= len(digits(m)) <= 15),
    }


def plain_secrets(text):
    assign = r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    return {
        "assign": matched(assign, text, lambda m: len(m.group(2)) >= 12, re.I | re.A),
        "access": matched("AKIA[A-Z0-9]+", text, lambda m: len(m.group()) >= 18),
        "hex": matched("[0-9a-f]+", text, lambda m: len(m.group()) >= 16),
    }


def in_text(found):
    kinds = list(found)
    ordered = sorted((s, kinds.index(k), e) for k, all_spans in found.items() for s, e in all_spans)
    return ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in ordered)


PARTS = [
    "a", "b.c", "@", "d@e.f", "_", "1", "2", "255", ".", "-", " ", "+", "(", ")", "4111 1111 1111 1111", "4111111111111111",
    "+1 (555) 123-4567", "é", "😀", "token", "secret=", "API_KEY: ", "apikey='", "abcdefabcdef0123", "AKIA", "ABCDEFGHIJKLMN",
    "password", "=", "\"", "x" * 13, "0000", "GB82 WEST 1234 5698 7654 32", "\n", "passwd"]
LONG = ["9" * 30_000, "a" * 30_000, "1-" * 15_000 + "1", "1.1." * 8_000, "4111111111111111 x " * 1_500, "token=abcdefabcdefabcd " * 1_200]


def odd_texts(spark):
    random.seed(3)
    texts = ["".join(random.choice(PARTS) for _ in range(random.randint(0, 14))) for _ in range(1_200)] + LONG
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4).union(
        documents(spark).select(F.col("doc_id") + 10_000, "text"))


@pytest.mark.parametrize("report, plain", [(pii.report, plain_personal), (secrets.report, plain_secrets)])
def test_base_spans_equal_plain_search(spark, report, plain):
    docs = odd_texts(spark)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = report(docs).collect()
    assert len(rows) == len(texts)
    for row in rows:
        found = plain(texts[row["doc_id"]])
        assert row["base_sha256"] == sha(in_text(found).encode()), texts[row["doc_id"]][:200]
        assert {f"n_{k}": len(v) for k, v in found.items()} == {k: row[k] for k in row.asDict() if k.startswith("n_")}
        assert set(filter(None, in_text(found).split(","))) <= set(row["spans"].split(","))


def test_spans_of_odd_rows(spark):
    for report in (pii.report, secrets.report):
        assert report(odd_documents(spark)).count() == 16
        assert report(no_documents(spark)).count() == 0
    row = pii.report(odd_documents(spark)).filter("doc_id = 7").first()
    assert (row["n_email"], row["n_ip"], row["n_card"], row["n_phone"]) == (1, 1, 1, 1)
    row = secrets.report(odd_documents(spark)).filter("doc_id = 10").first()
    assert (row["n_assign"], row["n_access"], row["n_hex"]) == (1, 1, 1)


def test_account_numbers_context_and_masking(spark):
    text = "Pay to IBAN GB82 WEST 1234 5698 7654 32, not GB83 WEST 1234 5698 7654 32. Call +1 (555) 123-4567"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = {s["kind"]: s for s in docs.select(pii.find(F.col("text")).alias("f")).first()["f"]}
    assert text[found["iban"]["start"]:found["iban"]["end"]] == "GB82 WEST 1234 5698 7654 32"
    assert found["iban"]["score"] == 1.0 and found["phone"]["score"] == 0.8
    masked = docs.select(pii.masked(F.col("text"))).first()[0]
    assert masked == "Pay to IBAN [IBAN], not GB83 WEST 1234 5698 7654 32. Call [PHONE]"


def test_overlapping_spans_are_masked_as_one(spark):
    docs = spark.createDataFrame([("x +4111 1111 1111 1111 y a@b.c",), ("",)], "text string")
    masked, empty = [r[0] for r in docs.select(pii.masked(F.col("text"))).collect()]
    assert (masked, empty) == ("x +[CARD] y [EMAIL]", "")
    assert not re.search("[0-9]{4}", masked) and masked.endswith("y [EMAIL]")


def test_trigram_queries():
    assert secrets.trigrams("[0-9a-f]{16,}+") == secrets.ANYTHING
    assert secrets.trigrams("abcd[xy]") == ("any", (("all", ("abc", "bcd", "cdx")), ("all", ("abc", "bcd", "cdy"))))
    assert secrets.trigrams("(?:abc|abcd)x*") == "abc"
    assert secrets.trigrams("AKIA[A-Z0-9]{14,}+") == ("all", ("aki", "kia"))
    assert secrets.trigrams("(?:abc|.)") == secrets.ANYTHING


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["abc", "ab", "[xy]", "(?:foo|bar)", "(?:q?)", "z+", "[a-z]{2}", "(?:de){2}", "."]), max_size=5))
def test_every_match_meets_its_query(parts):
    pattern = "".join(parts)
    query = secrets.trigrams(pattern)
    random.seed(1)
    for _ in range(40):
        text = "".join(random.choice(["abc", "ab", "x", "y", "foo", "bar", "q", "z", "de", "k"]) for _ in range(9))
        if re.search(pattern, text):
            assert meets(query, text)


def meets(query, text):
    if isinstance(query, str):
        return query in text.lower()
    return (all if query[0] == "all" else any)(meets(q, text) for q in query[1])


def test_running_sums_in_blocks(spark):
    row = spark.range(1).select(spans.running_sums(F.transform(F.sequence(F.lit(1), F.lit(1500)), lambda x: x.cast("int"))))
    assert row.first()[0] == [i * (i + 1) // 2 for i in range(1500)]
