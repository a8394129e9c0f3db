"""The corpus pipeline: toxicity, near-duplicates, benchmark decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontam, mixing, nearcopies, sharding, toxicity
from tidemark.llm.scale import materialize

N_SHARDS = 24


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return toxicity.remove(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near copies (five words, similarity 0.8 or more) of a document with a smaller id go: SimHash search, verified."""
    return nearcopies.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source is drawn to its target; whole documents, a row for each time one is drawn, laid out and shuffled by shard of the mixture."""
    return mixing.mix(docs, whole=True).select(*docs.columns)


def cut_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and slot; shards are near equal in bytes."""
    return sharding.shard(docs, N_SHARDS)


STAGES = [("toxicity", drop_toxic), ("simhash_dedup", drop_near_duplicates), ("decontaminate", drop_contaminated), ("mix_sources", mix_sources), ("shard", cut_shards)]

#: Near copies and the toxicity model can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, f"pipeline-{name}")
    return docs
