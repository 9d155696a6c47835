"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a
DataFrame, which is written as Parquet and read again as the next one's input.

1. quality: documents the classifier rejects go.
2. near_duplicates: of each group of texts linked at 0.8 on five-word shingles one stays.
3. decontamination: documents with a copy of a benchmark item, edited or not, go.
4. secrets: credentials are replaced by a mark; no document goes.
5. mixing: sources are brought to their target weights; ``mix_times`` says how often the mix
   holds a document.

Defined results: rows with null or empty texts have no perplexity and go in the first stage, so an empty result is
possible and every stage takes it; null ids, languages and sources are values like any other; of repeated rows one stays; columns
whose names a stage uses itself are kept as they are.

SQL cannot express the perplexities and alignments, so ORACLE_SQL is None and the stages are
tested against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfprice.llm import decontaminate, jaccard_join, mixing, quality, secrets
from shelfprice.llm.common import stored, table

ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_accepted(spark, docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(spark, docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(spark, docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(spark, docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(spark, docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("mixing", mixing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(spark, stage(spark, docs, sf_dir), "stage-" + name)
    return docs
