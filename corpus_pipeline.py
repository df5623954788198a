"""A corpus pipeline: five stages, each a Parquet table that the next one reads.

Quality, near duplicates and the mix decide which documents stay, personal data is masked in
their texts, and the last stage encodes what is left. Each stage works on all that its predecessor
kept and, but for the last, returns the columns of ``documents``.

Rows with equal ids are judged each by its own text; null texts count as empty.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hunian.llm import bpe, mixing, neardup, pii, quality
from hunian.llm.base import shared_path, table, text_or_empty
from hunian.sources.files import remove


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return docs.filter(model.score(F.col("text")) >= quality.THRESHOLD)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every class of near duplicates."""
    return neardup.representatives(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind and ``n_chars`` of the new text."""
    docs = docs.withColumn("text", F.when(F.col("text").isNotNull(), pii.masked(text_or_empty())))
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens follow the target shares of sources, languages and topics."""
    return mixing.sample(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return bpe.encode_documents(
        docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep_ids=True).drop("decoded")


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_each),
    ("personal_data", mask_personal_data),
    ("mixing", mix),
    ("encoding", encode),
]

#: A trained network decides what stays, so SQL cannot give the rows; ``tests/llm/test_pipeline.py`` compares them with plain versions
#: of all stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; a stage's table goes as soon as the next one's is written."""
    docs = table(spark, sf_dir, "documents")
    root = shared_path(spark, f"pipeline-{uuid.uuid4().hex}")
    before = None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
        if before:
            remove(spark, f"{root}/{before}")
        before = name
    return docs
