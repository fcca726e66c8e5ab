"""A training corpus from the documents table, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept; ``run`` writes every stage's rows as Parquet under the shared folder and
rereads them for the next one.  All but the last return the columns of
documents; the last writes token shards and returns, per document read back
from them, doc_id, start, n_tokens and ids_crc32.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marquee.llm.common import read_table, stored
from marquee.llm.decontam import decontaminate
from marquee.llm.minhash import drop_near_duplicates
from marquee.llm.mixing import apply_mix
from marquee.llm.quality import quality_filter
from marquee.llm.tokens import token_digest, write_tokens


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that the quality rules reject go."""
    return quality_filter(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: one document of each group of near-duplicates stays."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents that hold a benchmark item go."""
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: each document as many times as the mix takes it."""
    return apply_mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: token shards, read back."""
    return token_digest(write_tokens(docs))


STAGES = [
    ("quality", quality),
    ("dedup", dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("tokens", tokens),
]

#: Pivotal rounding and byte-pair encoding cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after another, from the documents table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
