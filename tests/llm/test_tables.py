"""Operators over whole tables: mixing, conversations, near duplicates, nearest vectors, the pipeline."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from hunian.llm import catalog, chat, mixing, nearest, neardup, pii
from hunian.llm.base import table
from tests.compare import connect, spark_rows, sql_rows
from tests.llm.tables import components, made_texts, no_documents, odd_documents

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(catalog.SQL))
def test_query_equals_sql(spark, name):
    assert spark_rows(catalog.QUERIES[name](spark, FOLDER)) == sql_rows(connect(FOLDER), catalog.SQL[name])


def test_every_operator_is_registered():
    names = {n.split("_")[0] for n in entry.queries() if n.startswith("op")}
    assert names == {f"op{i}" for i in range(1, 14)} and "pipeline" in entry.queries()


# Mixing

def plain_factor(tokens, fitted, kept):
    """Bisection for the factor at which values of at most ``tokens`` give ``kept``."""
    low, high = 0.0, 1e12
    for _ in range(200):
        half = (low + high) / 2
        low, high = (half, high) if sum(min(w, half * f) for w, f in zip(tokens, fitted)) < kept else (low, half)
    return high


def plain_rake(cells, weights, share, rounds):
    """Targets by water filling and the cells' fitted tokens."""
    kept, targets = share * sum(cells.values()), []
    for d, rule in enumerate(weights):
        sums = Counter()
        for cell, w in cells.items():
            sums[cell[d]] += w
        wanted = {v: rule(v, w) for v, w in sums.items()}
        factor = plain_factor(sums.values(), [wanted[v] for v in sums], kept)
        targets.append({v: min(w, factor * wanted[v]) for v, w in sums.items()})
    raw = dict(cells)
    for _ in range(rounds):
        for d, target in enumerate(targets):
            for value, t in target.items():
                own = [c for c in cells if c[d] == value]
                full = t >= sum(cells[c] for c in own) * (1 - 1e-12)
                factor = max(cells[c] / raw[c] for c in own) if full else plain_factor([cells[c] for c in own], [raw[c] for c in own], t)
                for c in own:
                    raw[c] *= factor
    return targets, {c: min(w, raw[c]) for c, w in cells.items()}


def made_cells(seed):
    """A hot value, rare ones, and one of a single token."""
    random.seed(seed)
    cells = {(a, b): random.randint(1, 900) for a in "xyz" for b in "pqrs"}
    cells["hot", "p"], cells["hot", "q"], cells["rare", "p"], cells["x", "odd"] = 6000, 5000, 7, 1
    return cells


def test_raking_under_bounds_equals_the_plain_loop_and_meets_the_targets(spark):
    cells = made_cells(2)
    rows = spark.createDataFrame([(*k, v) for k, v in cells.items()] + [("x", "empty", 0)], "one string, two string, _tokens long")
    rules = {"one": mixing.tempered(0.5), "two": mixing.tempered(0.7)}
    found = {(r["one"], r["two"]): r["_fitted"] for r in mixing.rake(rows, rules, 0.5).collect()}
    targets, plain = plain_rake(cells, [lambda _, w: w ** 0.5, lambda _, w: w ** 0.7], 0.5, mixing.ROUNDS)
    assert found == pytest.approx(plain, rel=1e-6)
    assert targets[0]["rare"] == 7 and targets[1]["odd"] == 1 and found["rare", "p"] == pytest.approx(7)
    assert sum(found.values()) == pytest.approx(0.5 * sum(cells.values()))
    for d in range(2):
        for value, target in targets[d].items():
            assert sum(w for c, w in found.items() if c[d] == value) == pytest.approx(target, rel=2e-3)


def test_targets_by_value(spark):
    cells = made_cells(3)
    rows = spark.createDataFrame([(*k, v) for k, v in cells.items()], "one string, two string, _tokens long")
    shares = {"one": {"x": 0.5, "y": 0.3, "z": 0.2}, "two": mixing.tempered(0)}
    found = mixing.rake(rows, shares, 0.1).groupBy("one").agg(F.sum("_fitted").alias("n")).collect()
    sums = {r["one"]: r["n"] for r in found}
    assert sums["hot"] == sums["rare"] == 0
    kept = sum(sums.values())
    assert [sums[v] / kept for v in "xyz"] == pytest.approx([0.5, 0.3, 0.2], rel=0.05)


def test_mixing_odd_rows(spark):
    docs = odd_documents(spark)
    rows = mixing.report(docs).collect()
    assert len(rows) == 16 and all(0 <= r["probability"] <= 1 for r in rows)
    kept = mixing.sample(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r["kept"] for r in rows)
    assert mixing.report(no_documents(spark)).count() == 0 and mixing.sample(no_documents(spark)).count() == 0


def test_sampled_tokens_follow_the_probabilities(spark):
    rows = mixing.report(table(spark, "/root/testdata/sf0.01", "documents")).toPandas()
    expected, kept = (rows["tokens"] * rows["probability"]).sum(), rows["tokens"][rows["kept"]].sum()
    assert expected == pytest.approx(mixing.SHARE * rows["tokens"].sum(), rel=1e-4)
    assert kept == pytest.approx(expected, rel=0.15)


def expectations(docs):
    rows = mixing.calibrated(docs, **mixing.production()).select(
        "row.doc_id", "_source", "_lang", "_topic", "tokens", "probability", "kept").toPandas()
    rows["expected"] = rows["tokens"] * rows["probability"]
    return rows


def test_expected_sample_meets_the_targets_with_a_hot_source(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").withColumn(
        "source", F.when(F.col("doc_id") % 3 == 0, "hot").otherwise(F.col("source")))
    rows = expectations(docs)
    assert rows["probability"].between(0, 1).all()
    assert rows["expected"].sum() / rows["tokens"].sum() == pytest.approx(mixing.SHARE, rel=1e-6)
    reported = {(r["dimension"], r["value"]): r for r in mixing.margins(docs, **mixing.production()).collect()}
    for name, power in (("source", 0.5), ("lang", 0.7), ("topic", 0.7)):
        sums = rows.groupby(f"_{name}")[["tokens", "expected"]].sum()
        kept = mixing.SHARE * sums["tokens"].sum()
        factor = plain_factor(sums["tokens"], sums["tokens"] ** power, kept)
        target = (factor * sums["tokens"] ** power).clip(upper=sums["tokens"])
        assert sums["expected"].to_dict() == pytest.approx(target.to_dict(), rel=5e-3)
        for value in sums.index:
            row = reported[name, value]
            assert (row["tokens"], row["target"], row["expected"]) == pytest.approx(
                (sums["tokens"][value], target[value], sums["expected"][value]), rel=1e-6)
            assert row["wanted"] >= row["target"] * (1 - 1e-9) or row["target"] < row["tokens"]
    kept = [r["doc_id"] for r in corpus_pipeline.mix(spark, docs, FOLDER).select("doc_id").collect()]
    assert sorted(kept) == sorted(rows["doc_id"][rows["kept"]])


@pytest.mark.parametrize("source, lang", [("new", "en"), ("src1", "new"), ("new", "new")])
def test_one_stray_document_changes_next_to_nothing(spark, source, lang):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    stray = spark.createDataFrame([(-1, "one " * 10, lang, source, 40)], docs.schema)
    before, after = expectations(docs).set_index("doc_id"), expectations(docs.union(stray)).set_index("doc_id")
    assert after["probability"][-1] == pytest.approx(1, rel=1e-3)
    assert (after["probability"].drop(-1) - before["probability"]).abs().max() < 0.01
    assert after["kept"].sum() == pytest.approx(before["kept"].sum(), rel=0.01)


def test_the_kept_share_is_the_same_at_two_sizes(spark):
    shares = [rows["expected"].sum() / rows["tokens"].sum() for rows in (
        expectations(table(spark, folder, "documents")) for folder in (FOLDER, "/root/testdata/sf0.01"))]
    assert shares == pytest.approx([mixing.SHARE] * 2, rel=1e-6)


# Conversations

def test_turns_and_loss_read_back(spark):
    random.seed(1)
    parts = ["<", "[", "\\", "s>", "/s>", "part>", "INST]", "/INST]", "</s>", "[INST]", "<part>", "ok", "\n", "é", "$1"]
    rows = [
        (c, t, random.choice(["user", "assistant", "sys<s>[INST]", "\\"]), "".join(random.choice(parts) for _ in range(random.randint(0, 10))))
        for c in range(150) for t in range(random.randint(1, 6))]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r["conv_id"]: r for r in chat.digest(turns).collect()}
    formatted = {r["conv_id"]: r for r in chat.format_chats(turns).collect()}
    for c in range(150):
        own = [r for r in rows if r[0] == c]
        loss = "".join(r[3] for r in own if r[2] == "assistant")
        assert found[c]["turns_sha256"] == hashlib.sha256("".join(f"{r[2]}\n{r[3]}\n" for r in own).encode()).hexdigest()
        assert found[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert (found[c]["n_turns"], found[c]["loss_chars"]) == (len(own), len(loss))
        runs = 1 + sum(a[2] != b[2] for a, b in zip(own, own[1:]))
        text = formatted[c]["formatted"]
        assert text.count("</s>") == text.count("<s>") == runs and text.count("<part>") == len(own) - runs
        assert "".join(s["text"] for s in formatted[c]["segments"]) == text


def test_odd_conversations(spark):
    schema = "conv_id long, turn long, role string, text string, turns string"
    rows = [(1, 1, None, None, "x"), (1, 1, None, None, "x"), (1, None, "user", "first", "x"), (None, 2, "assistant", "a", "x"),
            (2, 5, "assistant", "", "x"), (2, 1, "user", "u" * 100_000, "x")]
    found = {r["conv_id"]: r for r in chat.digest(spark.createDataFrame(rows, schema)).collect()}
    assert found.keys() == {1, 2, None}
    assert found[1]["n_turns"] == 3 and found[1]["turns_sha256"] == hashlib.sha256(b"user\nfirst\n\n\n\n\n").hexdigest()
    assert found[2]["formatted_chars"] == 100_000 + len("<s>user[INST][/INST]</s><s>assistant[INST][/INST]</s>")
    assert chat.digest(spark.createDataFrame([], schema)).count() == 0


# Near duplicates

def plain_classes(rows, weights):
    """Class of each row by comparing all pairs exactly."""
    made = [neardup.shingles(t, weights) for _, t in rows]
    links = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if rows[i][1] == rows[j][1] or neardup.similarity(made[i], made[j]) >= neardup.LIKE]
    root = components(range(len(rows)), links)
    return [min(rows[j][0] for j in range(len(rows)) if root[j] == root[i]) for i in range(len(rows))]


def test_similarity_is_weighted_jaccard():
    idf = np.ones(neardup.SLOTS)
    one, two = (neardup.shingles(t, idf) for t in ("a b c d e f g", "a b c d e f h"))
    assert neardup.similarity(one, two) == pytest.approx(2 / 4)
    repeated = neardup.shingles("a b c d e a b c d e", idf)
    assert sorted(repeated[1]) == [1, 1, 1, 1, 2]


def test_samples_agree_as_often_as_the_similarity():
    random.seed(5)
    words = [f"w{i}" for i in range(400)]
    idf = 1 + np.random.default_rng(1).random(neardup.SLOTS)
    sampler = neardup.Sampler(2_000)
    for change in (3, 20, 60):
        a = [random.choice(words) for _ in range(300)]
        b = list(a)
        for _ in range(change):
            b[random.randrange(300)] = random.choice(words)
        sets = [neardup.shingles(" ".join(t), idf) for t in (a, b)]
        drawn = [sampler.samples(h, w, np.array([0])) for h, w in sets]
        assert (drawn[0] == drawn[1]).mean() == pytest.approx(neardup.similarity(*sets), abs=0.05)


def test_classes_equal_all_pairs(spark):
    texts = made_texts(4, 150)
    rows = list(enumerate(texts)) + [(1_000 + i, t) for i, t in enumerate(texts[:40])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    weights = neardup.inverse_frequencies(docs)
    found = {r["doc_id"]: r["class_id"] for r in neardup.classes(docs).collect()}
    plain = dict(zip([i for i, _ in rows], plain_classes(rows, weights)))
    assert found == plain
    kept = neardup.representatives(docs).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(plain.values()))


def test_chain_of_copies_and_a_shared_passage(spark):
    """A long chain whose ends differ is one class; texts that share a passage only stay apart."""
    random.seed(6)
    passage = [f"p{i}" for i in range(60)]
    at = [f"c{i}" for i in range(200)]
    rows = []
    for step in range(30):
        at = list(at)
        at[step * 6] = f"new{step}"
        rows.append((step, " ".join(at)))
    rows += [(100 + i, " ".join(passage + [f"own{i}_{j}" for j in range(40)])) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["class_id"] for r in neardup.classes(docs).collect()}
    assert {found[i] for i in range(30)} == {0}
    assert all(found[i] == i for i in range(100, 140))


def test_odd_documents_and_near_copies(spark):
    rows = neardup.classes(odd_documents(spark)).collect()
    assert len(rows) == 16
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], set()).add(r["class_id"])
    assert by_id[2] == by_id[3] and by_id[8] == {8} and by_id[9] == {9} and by_id[12] == {12}
    assert by_id[6] == {5} and by_id[11] == by_id[4] == {4}
    kept = neardup.representatives(odd_documents(spark))
    assert kept.columns == odd_documents(spark).columns
    assert kept.filter("text = 'copy of a text'").count() == 1
    assert neardup.classes(no_documents(spark)).count() == 0 and neardup.representatives(no_documents(spark)).count() == 0


# Nearest vectors

def plain_nearest(rows, count):
    found = {}
    for q, vector in rows:
        if q % 20 == 0:
            scored = sorted((-float(np.sum(np.array(v) * np.array(vector))), i) for i, v in rows if i != q)
            found[q] = [i for _, i in scored[:count]]
    return found


def test_recall_order_and_scores(spark):
    vectors = table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    plain, found = plain_nearest(rows, 20), {}
    for r in catalog.QUERIES["op8_multi_index"](spark, "/root/testdata/sf0.1").orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append(r)
    assert found.keys() == plain.keys()
    hits = sum(len({r["vec_id"] for r in found[q]} & set(plain[q])) for q in plain)
    assert hits >= 0.9 * 20 * len(plain)
    by_id = dict(rows)
    for q, ranked in found.items():
        assert [r["rank"] for r in ranked] == list(range(1, 21))
        assert [(-r["score"], r["vec_id"]) for r in ranked] == sorted((-r["score"], r["vec_id"]) for r in ranked)
        for r in ranked:
            assert r["score"] == pytest.approx(float(np.dot(np.array(by_id[q], float), np.array(by_id[r["vec_id"]], float))), abs=1e-12)


def test_whole_index_is_exact_with_ties(spark):
    random.seed(8)
    rows = [(i, [float(random.randint(-2, 2)) for _ in range(6)]) for i in range(300)]
    rows = [(i, v if any(v) else [1.0] * 6) for i, v in rows] + [(i, [1.0] * 6) for i in range(300, 700)]
    found = {}
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for r in nearest.search(vectors, F.col("vec_id") % 20 == 0, share=1.0).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    assert found == plain_nearest(rows, 20)


def test_traversal_follows_summed_distance():
    random = np.random.default_rng(3)
    first, second, counts = random.random(9), random.random(7), random.integers(0, 4, 63)
    met, last = nearest.traverse(first, second, counts, int(counts.sum()))
    sums = (first[:, None] + second[None, :]).ravel()
    assert met == [c for c in np.argsort(sums, kind="stable") if counts[c]]
    met, last = nearest.traverse(first, second, counts, 10)
    assert counts[met].sum() >= 10 and last == sums[met[-1]]


def test_odd_vectors(spark):
    schema = "vec_id long, embedding array<double>, key string, cell int"
    rows = [(0, [1.0, 2.0]), (20, None), (40, [0.0, 0.0]), (60, [float("nan"), 1.0]), (80, []), (100, [1.0, 2.0, 3.0]), (3, [1.0, 2.0]),
            (2, [1.0, 2.0]), (5, [None, 1.0]), (7, [3.0, 1.0]), (9, [float("inf"), 1.0]), (None, [1.0, 1.0]), (7, [3.0, 1.0])]
    vectors = spark.createDataFrame([(*r, "k", 1) for r in rows], schema)
    found = nearest.search(vectors, F.col("vec_id") % 20 == 0).orderBy("rank").collect()
    assert [(r["query_id"], r["vec_id"], r["score"]) for r in found] == [(0, 2, 5.0), (0, 3, 5.0), (0, 7, 5.0), (0, 7, 5.0)]
    assert nearest.search(spark.createDataFrame([], schema), F.col("vec_id") % 20 == 0).count() == 0


def test_rows_of_one_id_are_queries_and_candidates_of_their_own(spark, monkeypatch):
    """Repeated ids with other vectors, repeated rows, and queries mostly of another length than all rows."""
    monkeypatch.setattr(nearest, "BLOCK", 16)
    random.seed(9)
    rows = [(random.choice([0, 20, 40, i, i]), [float(random.randint(-3, 3)) for _ in range(4)] + [0.5]) for i in range(200)]
    rows += rows[:20] + [(60, [1.0, 2.0]), (80, [2.0, 1.0]), (100, [2.0, 1.0])] * 10
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = [(n, i, v) for n, (i, v) in enumerate(rows) if len(v) == 5]
    wanted = []
    for n, i, v in whole:
        if i % 20 == 0:
            others = sorted((-sum(a * b for a, b in zip(v, w)), k) for m, k, w in whole if m != n)[:7]
            wanted += [(i, rank + 1, k, -score) for rank, (score, k) in enumerate(others)]
    found = [tuple(r) for r in nearest.search(vectors, F.col("vec_id") % 20 == 0, 7, share=1.0).collect()]
    assert sorted(found) == sorted(wanted)


# Pipeline

def test_stages_keep_columns_and_rows_follow(spark, tmp_path):
    docs = table(spark, FOLDER, "documents").withColumn("extra", F.lit("kept")).withColumn("row", F.lit(1))
    before = docs.count()
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, FOLDER)
        if name != "encoding":
            assert made.columns == docs.columns, name
        made.write.parquet(f"{tmp_path}/{n}")
        docs = spark.read.parquet(f"{tmp_path}/{n}")
        assert 0 < docs.count() <= before
        if name == "personal_data":
            assert docs.count() == before
            assert docs.filter(F.size(pii.find(F.col("text"))) > 0).count() == 0
            assert docs.filter("n_chars <> length(text)").count() == 0
        before = docs.count()


def test_pipeline_of_odd_and_empty_tables(spark):
    for docs in (odd_documents(spark), no_documents(spark)):
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, FOLDER)
            docs.count()


def test_pipeline_query(spark):
    rows = entry.queries()["pipeline"](spark, FOLDER).collect()
    docs = {r["doc_id"] for r in table(spark, FOLDER, "documents").collect()}
    ids = [r["doc_id"] for r in rows]
    assert ids and set(ids) <= docs and len(set(ids)) == len(ids)
    assert all(r["n_tokens"] == len(r["ids"]) for r in rows)
