"""From raw documents to shards: toxicity, near duplicates, benchmark passages, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's documents. All stages but the last return the columns of documents. Null and
empty texts pass the filters; empty tables give empty results; repeated rows are near duplicates of
each other, of which one stays unless they have no words. Of equal rows the mix may cut any one. Very long
texts are read whole by every stage. Further columns are kept, whatever their names; the last stage replaces those
named size, text_crc32, law, shard, slot or grown_shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quoteloom.llm import decontaminate, minhash, mixing, sharding, toxicity
from quoteloom.workspace import materialize, remove_path, scratch_path

SHARDS = [1.0] * 8


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return minhash.one_per_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target proportions; documents stand as often as the mix takes them."""
    return mixing.mix(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and their place in it."""
    return sharding.shard(docs, SHARDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

#: The toxicity model and the hashes have no SQL counterpart; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents of ``sf_dir``; a stage's rows go once the next one's are written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        docs = materialize(stage(spark, docs, sf_dir), name, path)
        if before:
            remove_path(spark, before)
        before = path
    return docs
