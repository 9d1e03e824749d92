"""Hourly volumes, gaps between passes, distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tollway.config import CLASS_LABELS, FUEL_LABELS, Rules
from tollway.functions import exprs as E
from tollway.operators.clean import keep_first, require


def _share(n: str) -> Column:
    """Of a count in all rows; the rows are as few as hours, bins or code pairs."""
    total = F.sum(n).over(W.partitionBy())
    return F.when(total > 0, F.col(n) / total).otherwise(F.lit(0.0))


def hourly_volume(df: DataFrame, r: Rules) -> DataFrame:
    """hour 0 to 23 with counts and shares of cars and trucks; hours without records read 0. One pass over the records."""
    kinds = {"car": r.car_vehicle_types, "truck": r.truck_vehicle_types}
    counts = df.groupBy(F.hour("GCSJ").alias("hour")).agg(*[F.count_if(F.col("CLLX").isin(list(v))).alias(f"{k}_count") for k, v in kinds.items()])
    hours = df.sparkSession.range(24).select(F.col("id").cast("int").alias("hour"))
    full = hours.join(counts, "hour", "left").fillna(0)
    return full.select("hour", *[c for k in kinds for c in (F.col(f"{k}_count"), _share(f"{k}_count").alias(f"{k}_perc"))])


def gaps(df: DataFrame, by_class: bool = False) -> DataFrame:
    """Seconds to the same vehicle's next pass on the same date: KKOD (pair of checkpoints), time, hour (of the first pass).

    by_class: cars and trucks are followed apart, and `kind` says which."""
    kind = ["kind"] if by_class else []
    by = W.partitionBy(*kind, "CLTMBH").orderBy("GCRQ", "GCSJ", "seq")
    x = df.select(*kind, "CLTMBH", "GCRQ", "GCSJ", "KKBH", *[F.lead(c).over(by).alias(f"next_{c}") for c in ("GCRQ", "GCSJ", "KKBH")])
    x = x.where("GCRQ = next_GCRQ")
    out = x.select(
        *kind, "CLTMBH", F.col("KKBH").alias("from_KKBH"), F.col("next_KKBH").alias("to_KKBH"), E.pair_key(F.col("KKBH"), F.col("next_KKBH")).alias("KKOD"),
        E.seconds_between(F.col("GCSJ"), F.col("next_GCSJ")).alias("time"), F.hour("GCSJ").alias("hour"),
    )
    return out.where("time >= 0")


def with_kind(df: DataFrame, r: Rules) -> DataFrame:
    kind = F.when(F.col("CLLX").isin(list(r.car_vehicle_types)), "car").when(F.col("CLLX").isin(list(r.truck_vehicle_types)), "truck")
    return df.withColumn("kind", kind).where("kind is not null")


def label_table(spark: SparkSession, r: Rules) -> DataFrame:
    return spark.createDataFrame(list(enumerate(r.travel_time_labels)), "ordinal int, travel_time_label string")


def gap_histogram(df: DataFrame, r: Rules) -> DataFrame:
    """Counts and shares of gaps by bin, for cars and trucks; all bins appear, gaps outside all bins count nowhere."""
    g = gaps(with_kind(df, r), by_class=True).withColumn("travel_time_label", E.bins(F.col("time"), r.travel_time_bins, r.travel_time_labels))
    counts = g.where("travel_time_label is not null").groupBy("travel_time_label").agg(*[F.count_if(F.col("kind") == k).alias(f"{k}_count") for k in ("car", "truck")])
    full = label_table(df.sparkSession, r).join(counts, "travel_time_label", "left").fillna(0)
    return full.select("ordinal", "travel_time_label", *[c for k in ("car", "truck") for c in (F.col(f"{k}_count"), _share(f"{k}_count").alias(f"{k}_perc"))])


def gap_summary(df: DataFrame, r: Rules) -> DataFrame:
    g = gaps(with_kind(df, r), by_class=True)
    return g.groupBy("kind").agg(F.count("*").alias("n"), F.min("time").alias("min_time"), F.max("time").alias("max_time"), F.avg("time").alias("mean_time"), F.median("time").alias("median_time"))


def vehicle_info(df: DataFrame) -> DataFrame:
    """First record of each vehicle by time: its codes, labels, and what optional attributes there are."""
    require(df, ("CLTMBH", "GCSJ", "GCRQ"))
    keep = [c for c in ("CLTMBH", "HPZL", "CLLX", "RLLX", "PFBZ", "SYXZ") if c in df.columns]
    first = keep_first(df, ["CLTMBH"], ["GCSJ", "GCRQ", "seq"]).select(*keep)
    for code, label, table in (("CLLX", "veh_type", CLASS_LABELS), ("RLLX", "fuel_type", FUEL_LABELS)):
        if code in keep:
            first = first.withColumn(label, E.mapped(F.col(code), table))
    return first


def pair_distribution(df: DataFrame, cllx: str = "CLLX", rllx: str = "RLLX") -> DataFrame:
    """CLLX, RLLX, count, ratio of all records that have both codes."""
    x = df.select(E.prefix2(E.strip(E.as_text(F.col(cllx)))).alias("CLLX"), E.strip(E.as_text(F.col(rllx))).alias("RLLX"))
    for c in ("CLLX", "RLLX"):
        x = x.where((F.col(c) != "") & (F.lower(c) != "nan"))
    return x.groupBy("CLLX", "RLLX").agg(F.count("*").alias("count")).withColumn("ratio", _share("count"))


def compare_distributions(left: DataFrame, right: DataFrame, left_name: str, right_name: str) -> DataFrame:
    """Both distributions side by side, and the difference of shares in percentage points."""
    side = lambda df, n: df.select("CLLX", "RLLX", F.col("count").alias(f"{n}_count"), F.col("ratio").alias(f"{n}_ratio"))
    both = side(left, left_name).join(side(right, right_name), ["CLLX", "RLLX"], "full_outer").fillna(0)
    delta = (F.col(f"{left_name}_ratio") - F.col(f"{right_name}_ratio")) * 100
    return both.withColumn("delta_pp", delta).withColumn("abs_delta_pp", F.abs("delta_pp"))
