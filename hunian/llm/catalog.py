"""Registered queries of the numbered operators, with equal SQL where SQL can say it.

Each applies its operator with production parameters to the whole of its tables.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bestpos, bpe, chat, gridjoin, hardneg, mixing, nearest, neardup, pii, quality, secrets, toxicity, winnow,
)
from .base import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(build):
        QUERIES[build.__name__] = build
        if sql is not None:
            SQL[build.__name__] = sql
        return build
    return register


def _mixing_sql() -> str:
    """Raking unrolled step by step; windows over the cells in place of joins with their sums."""
    counts = ", ".join(f"len(regexp_extract_all(text, '{pattern}'))" for _, pattern in mixing.TOPICS)
    most = f"greatest({counts})"
    topic = " ".join(
        f"WHEN len(regexp_extract_all(text, '{pattern}')) = {most} THEN '{name}'" for name, pattern in mixing.TOPICS)
    powers = {"source": 0.5, "lang": 0.7, "topic": 0.7}
    margins = ", ".join(f"""
    v_{d} AS (SELECT c_{d}, sum(w) AS v, pow(sum(w), {p}) AS g FROM cells GROUP BY c_{d}),
    u_{d} AS (SELECT *, coalesce(sum(v) OVER (ORDER BY g / v DESC, c_{d} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
                     sum(g) OVER (ORDER BY g / v DESC, c_{d} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free, sum(v) OVER () AS total
              FROM v_{d}),
    m_{d} AS MATERIALIZED (SELECT c_{d}, least(v, g * max(({mixing.SHARE} * total - held) / free) OVER ()) AS t_{d} FROM u_{d})"""
        for d, p in powers.items())
    steps, last = [], "targets"
    for n in range(mixing.ROUNDS):
        for d in powers:
            order = f"PARTITION BY c_{d} ORDER BY f / w DESC, c_source, c_lang, c_topic ROWS BETWEEN"
            steps.append(f"""
    h{n}_{d} AS (SELECT *, coalesce(sum(w) OVER ({order} UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
                        sum(f) OVER ({order} CURRENT ROW AND UNBOUNDED FOLLOWING) AS free FROM {last}),
    s{n}_{d} AS MATERIALIZED (SELECT * EXCLUDE (held, free) REPLACE (
        f * greatest(max((t_{d} - held) / free) OVER (PARTITION BY c_{d}), 0) AS f) FROM h{n}_{d})""")
            last = f"s{n}_{d}"
    return f"""
    WITH base AS (SELECT doc_id, source, lang, coalesce(text, '') AS text FROM documents),
    docs AS MATERIALIZED (
        SELECT doc_id, source, lang, CASE WHEN {most} = 0 THEN '{mixing.OTHER}' {topic} END AS topic,
               CAST(len(regexp_extract_all(text, '[^ \t\r\n]+')) AS BIGINT) AS tokens FROM base),
    keyed AS MATERIALIZED (SELECT *, coalesce(source, '(none)') AS c_source, coalesce(lang, '(none)') AS c_lang, topic AS c_topic FROM docs),
    cells AS MATERIALIZED (SELECT c_source, c_lang, c_topic, CAST(sum(tokens) AS DOUBLE) AS w FROM keyed GROUP BY ALL HAVING sum(tokens) > 0),
    {margins},
    targets AS MATERIALIZED (SELECT *, w AS f FROM cells JOIN m_source USING (c_source) JOIN m_lang USING (c_lang) JOIN m_topic USING (c_topic)),
    {", ".join(steps)},
    done AS (SELECT k.*, coalesce(least(w, f) / w, {mixing.SHARE}) AS p FROM keyed k LEFT JOIN {last} USING (c_source, c_lang, c_topic))
    SELECT doc_id, source, lang, topic, tokens, round(p / {mixing.SHARE}, 6) AS weight, round(p, 6) AS probability,
           CAST('0x' || substr(md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) / 4503599627370496.0 < p AS kept
    FROM done"""


@_query(_mixing_sql())
def op1_raked_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.report(table(spark, folder, "documents"))


@_query()
def op2_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    return winnow.edited_fingerprints(table(spark, folder, "documents"))


# What the template adds to a conversation: each message's marks and role, and a mark between the turns of a message.
@_query(r"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
    escaped AS (
        SELECT *, length(regexp_replace(regexp_replace(text, '<(\\*)(/?s>|part>)', '<\\\1\2', 'g'),
                   '\[(\\*)(/?INST\])', '[\\\1\2', 'g')) AS text_chars,
               length(regexp_replace(regexp_replace(role, '<(\\*)(/?s>|part>)', '<\\\1\2', 'g'),
                   '\[(\\*)(/?INST\])', '[\\\1\2', 'g')) AS role_chars,
               lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before
        FROM turns)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
           sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
           CAST(sum(text_chars + CASE WHEN before IS DISTINCT FROM role THEN role_chars + length('<s>[INST][/INST]</s>')
                                      ELSE length('<part>') END) AS BIGINT) AS formatted_chars
    FROM escaped GROUP BY conv_id""")
def op3_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat.digest(table(spark, folder, "conversations").select(*added.columns).union(added))


@_query()
def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.scored(table(spark, folder, "documents"), table(spark, folder, "labels"))


@_query()
def op7_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.classes(table(spark, folder, "documents"))


@_query()
def op8_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    return nearest.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@_query()
def op9_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_documents(
        table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@_query()
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scored(table(spark, folder, "documents"), table(spark, folder, "labels"))


@_query()
def op5_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.report(table(spark, folder, "documents"))


@_query()
def op6_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.report(table(spark, folder, "documents"))


@_query(f"""
    WITH RECURSIVE vectors AS MATERIALIZED (
        SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    taking AS MATERIALIZED (
        SELECT * FROM vectors WHERE label IS NOT NULL AND v IS NOT NULL
           AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
    links AS MATERIALIZED (
        SELECT a.vec_id AS a, b.vec_id AS b FROM taking a JOIN taking b ON a.label = b.label AND a.vec_id <> b.vec_id
        WHERE list_cosine_similarity(a.v, b.v) >= {gridjoin.LIKE}),
    reach AS (SELECT vec_id AS a, vec_id AS b FROM vectors UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
    named AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
    SELECT vec_id, (SELECT count(*) FROM links l WHERE l.a = n.vec_id) AS n_links, component_id, vec_id = component_id AS kept
    FROM named n""")
def op11_grid_join(spark: SparkSession, folder: str) -> DataFrame:
    return gridjoin.components(table(spark, folder, "embeddings"))


def _terms_sql(text: str) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (f"regexp_extract_all(translate(coalesce({text}, ''), '{upper}', '{upper.lower()}'), "
            r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")


@_query(f"""
    WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_terms_sql('text')} AS t FROM documents),
    totals AS (SELECT count(*) FILTER (len(t) > 0) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM docs),
    asked AS MATERIALIZED (SELECT DISTINCT item_id, unnest({_terms_sql('text')}) AS term FROM benchmark),
    postings AS MATERIALIZED (
        SELECT r, doc_id, term, any_value(n) AS n, count(*) AS tf FROM (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM docs)
        WHERE term IN (SELECT term FROM asked) GROUP BY r, doc_id, term),
    weights AS (
        SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w
        FROM postings, totals GROUP BY term, n_docs),
    impacts AS (
        SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))) AS impact
        FROM postings JOIN weights USING (term), totals),
    scores AS (
        SELECT item_id, r, doc_id, CAST(sum(impact) AS BIGINT) AS score FROM asked JOIN impacts USING (term) GROUP BY ALL)
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
    FROM scores WHERE score > 0 QUALIFY rank <= {bestpos.COUNT}""")
def op12_best_position(spark: SparkSession, folder: str) -> DataFrame:
    return bestpos.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@_query(f"""
    WITH typed AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    vectors AS MATERIALIZED (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(v, lambda x: floor({hardneg.SCALE} * x)) AS q
        FROM typed WHERE label IS NOT NULL AND v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS MATERIALIZED (
        SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
        FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
    positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {hardneg.POSITIVES})
    SELECT p.anchor_id, p.positive_id,
           CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INT) AS rank,
           s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
    FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
    WHERE 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
    QUALIFY rank <= {hardneg.NEGATIVES}""")
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hardneg.mined(table(spark, folder, "embeddings"))
