"""From raw documents to training shards: quality rules, near-dedup, decontamination, mixing, sharding.

Every stage works on all that its predecessor kept. All but the last return the columns of `documents`; the last
adds `shard` and `slot`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tollway.llm import decontaminate, mixing, quality, sharding, simhash
from tollway.llm.common import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: copies, and texts that share 0.8 of their five-word shingles."""
    return simhash.keep_one(docs, **simhash.NEAR)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated with benchmark items go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled to the target weights."""
    return mixing.sample(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents get a shard and a slot."""
    return sharding.shard(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("source mixing", source_mixing),
    ("sharding", shards),
]

#: Histogram splitters, components and raking are iterative; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
