"""A corpus pipeline over documents: language, near duplicates, benchmark leaks, mixing, shards.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reelmart.llm import decontaminate_tiling, language_svm, mixing, sharding_bfd, simhash_vptree
from reelmart.llm.scratch import written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; those without letters or with an uncertain language go."""
    return language_svm.accepted(docs, language_svm.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the least doc_id."""
    return simhash_vptree.deduplicated(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of the benchmark."""
    return decontaminate_tiling.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by weights 3, 1, 2 to 150 % of all words: a row for each document and pass that takes words of it."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard of every row, 16 of near equal bytes, equal texts together."""
    return sharding_bfd.sharded(docs)


STAGES = [
    ("language", language),
    ("near duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]

#: Support vector machines and links by similarity aren't expressed in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = docs if at == len(STAGES) - 1 else written(docs, "stage")
    return docs
