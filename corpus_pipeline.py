"""A corpus from raw documents to shards: quality, near-duplicates, benchmark passages, mixture, shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lectern.llm import compression, decontaminate, mixing, nearcopies, sharding
from lectern.llm._common import kept


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier accepts; it learns from those of them that have labels."""
    model = compression.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return compression.accepted(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 or more of five-word shingles."""
    return nearcopies.deduplicated(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at the weights of the tree, four fifths of the tokens there are, each twice at most."""
    return mixing.resampled(docs, share=(4, 5))


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of each row."""
    return sharding.shard_documents(docs)


STAGES = [
    ("quality classifier", quality),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_passages),
    ("mixing", mixture),
    ("sharding", shards),
]
#: Compression and fingerprints have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
