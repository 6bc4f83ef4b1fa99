"""A corpus pipeline: quality rules, near-duplicates, repeated passages, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's documents. All but the last return the columns of ``documents``.

1. ``quality``: documents that the rules or their host's verdict reject go.
2. ``near_duplicates``: of each group of documents linked by a five-word Jaccard similarity of 0.8 or more, the one
   of the smallest doc_id stays; SimHash within 8 bits over the distinct words gives the first candidates, a prefix-filter
   join the rest.
3. ``repeats``: strings of 200 bytes that occur twice or more are cut out of the texts.
4. ``secrets``: secrets in the texts are replaced by a mark.
5. ``packing``: the tokenised texts, packed into sequences of 4096 tokens.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidora.llm import bpe, packing, quality, secret_scan, simhash, suffix_dedup
from evidora.llm.queries import vocabulary
from evidora.shared import folder

SHINGLE, SIMILARITY, DISTANCE = 5, 0.8, 8
#: Parts in a worker's cache when packing: fewer than alone, since executors are full of what earlier stages have touched.
PARTS = 100_000


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` brought in line with a changed text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep(docs, simhash.verified(docs, SHINGLE, SIMILARITY, DISTANCE))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(suffix_dedup.remove(docs))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(secret_scan.redact(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, bpe.read_file(vocabulary("word_bpe_49k.json")).decode(), parts=PARTS)


STAGES = [("quality", quality_rules), ("near_duplicates", near_duplicates), ("repeats", repeats), ("secrets", secrets), ("packing", packed)]

#: SQL can't express these stages; tests/llm/test_pipeline.py holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what is between them is written to the shared folder."""
    base = folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = f"{base}/pipeline-{uuid.uuid4().hex}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
