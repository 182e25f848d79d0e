"""Corpus pipeline over ``documents``: each stage gets the documents that its predecessor kept.

1. quality: documents that fail the base rules, or lie far outside their language and source, go;
2. near-duplicates: one document of each group of near copies stays;
3. decontamination: documents that hold benchmark passages go;
4. mixing: documents are sampled to the target weights of sources, languages and topics;
5. sharding: every document that is left gets a shard and a slot in it.

All stages but the last return the columns of ``documents``. Every stage is judged on its own
input: quality estimates, duplicate groups, token weights and row numbers are of the documents
that reach it. Null and repeated rows are treated as the operators say.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.common import table
from tessera.llm.feistel import shuffle_shards
from tessera.llm.mcd import keep_quality
from tessera.llm.oddsketch import keep_one
from tessera.llm.raking import mix
from tessera.llm.wumanber import decontaminate
from tessera.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Base rules and robust outliers per language and source."""
    return keep_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose expected tokens meet the marginals of sources, languages and topics."""
    return mix(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining document with its shard and its slot in the shard."""
    return shuffle_shards(docs, ["doc_id"])


STAGES = [
    ("quality", quality),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: None: minimum covariance determinants are iterative estimates that the SQL check can't express;
#: tests/llm checks planted documents through the stages, and each stage's operator on its own.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    base = scratch_path(spark, "llm", f"pipeline-{uuid.uuid4().hex}")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{base}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
