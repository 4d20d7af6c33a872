"""A training-text pipeline of five stages over ``documents``: quality rules,
near-duplicates, personal data, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept; all but the last return the columns of ``documents``.  Its decisions are
the operators' own: documents that the quality rules reject go, one document of
each near-duplicate group stays (five-word shingles, similarity 0.8 or more),
personal data are replaced by placeholders, sources are mixed to their targets
(documents repeated whole, one per source in part), and the mix is packed into
windows of 1024 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from graphloom.llm import mixing, near_dup, packing, pii, quality
from graphloom.session import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.one_of_each(docs, 5)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact_documents(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), "spaced")


STAGES = [("quality", quality_rules), ("near_duplicates", near_duplicates), ("pii", personal_data),
          ("mixing", mixing_sources), ("packing", packed)]

#: MinHash bands, boosted trees and a tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
