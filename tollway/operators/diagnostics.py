"""Audit of the cleaning, the mapping and the imputation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollway.config import Rules
from tollway.functions import exprs as E
from tollway.operators.clean import keep_first


def conflict_top(groups: DataFrame, k: int) -> DataFrame:
    return groups.where("has_conflict").orderBy(F.desc("group_size"), "GCRQ", "GCSJ", "CLTMBH").limit(max(1, k))


def final_records(included_mapped: DataFrame, supplement: DataFrame) -> DataFrame:
    """Included and imputed records as one: CLTMBH, FZJG, source (0, 1) and seq."""
    part = lambda df, i: df.select(E.strip(E.as_text(F.col("CLTMBH"))).alias("CLTMBH"), E.strip(E.as_text(F.col("FZJG"))).alias("FZJG"), F.lit(i).alias("source"), "seq")
    return part(included_mapped, 0).unionByName(part(supplement, 1))


def local_share(final: DataFrame, r: Rules) -> DataFrame:
    """Records and devices with a local plate; a device's first record, included ones first, speaks for it."""
    local = F.col("FZJG").isin(list(r.local_plate_prefixes))
    count = lambda df, level: df.agg(F.count_if(local).alias("local_count"), F.count("*").alias("total_count")).select(F.lit(level).alias("level"), "local_count", "total_count", E.ratio(F.col("local_count"), F.col("total_count")).alias("ratio"))
    return count(final, "record").unionByName(count(keep_first(final, ["CLTMBH"], ["source", "seq"]), "device"))


def sampled_share(attributes: DataFrame) -> DataFrame:
    n = F.count_if(E.truth(F.col("assigned_by_sampling")))
    return attributes.agg(n.alias("sampled_devices"), F.count("*").alias("devices")).withColumn("ratio", E.ratio(F.col("sampled_devices"), F.col("devices")))


def unpivot(one_row: DataFrame) -> DataFrame:
    """(metric, value) of each column of a single row."""
    x = one_row.select(*[F.col(c).cast("double").alias(c) for c in one_row.columns])
    return x.unpivot([], x.columns, "metric", "value")
