"""Adaptive travel-time thresholds of checkpoint pairs, and the bounds drawn from them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tollway.config import Segmentation
from tollway.functions import exprs as E
from tollway.functions.forest import inlier_mask, weighted_median

PAIR = ("from_KKBH", "to_KKBH")
ROWS = "from_KKBH string, to_KKBH string, kkod string, period string, min double, median double, max double"


def fixed_threshold(gaps: DataFrame, s: Segmentation) -> DataFrame:
    """One row: B, the exact quantile of all gaps, linearly interpolated; null if there are none.

    Distinct values are ranked minute by minute, after the minutes' own counts, so that no task holds all of them."""
    each = gaps.where("time is not null").groupBy("time").agg(F.count("*").alias("n")).withColumn("minute", F.floor(F.col("time") / 60))
    minutes = each.groupBy("minute").agg(F.sum("n").alias("m"))
    below = F.coalesce(F.sum("m").over(W.orderBy("minute").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    minutes = minutes.select("minute", below.alias("below"), (F.lit(s.fixed_quantile) * (F.sum("m").over(W.partitionBy()) - 1)).alias("rank"))
    inside = F.coalesce(F.sum("n").over(W.partitionBy("minute").orderBy("time").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    x = each.join(minutes, "minute").withColumn("from", F.col("below") + inside)
    here = lambda r: (F.col("from") <= r) & (r < F.col("from") + F.col("n"))
    low, high, rank = F.floor("rank"), F.ceil("rank"), F.col("rank")
    x = x.where(here(low) | here(high)).agg(F.max(F.when(here(low), F.col("time"))).alias("a"), F.max(F.when(here(high), F.col("time"))).alias("b"), F.max("rank").alias("rank"))
    between = (high - rank) * F.col("a") + (rank - low) * F.col("b")
    return x.select(F.when(low == high, F.col("a").cast("double")).otherwise(between).alias("B"))


def classify(gaps: DataFrame, s: Segmentation) -> DataFrame:
    """Each pair's count, spread and per-period counts, and whether one row (`all`) is to speak for it."""
    p = E.period(F.col("hour"), s.high_hours, s.flat_hours)
    x = gaps.groupBy(*PAIR).agg(
        F.count("*").alias("n"), F.stddev_samp("time").alias("std"), *[F.count_if(p == k).alias(f"n_{k}") for k in ("high", "flat", "low")],
        F.min("time").alias("min"), F.median("time").alias("median"), F.max("time").alias("max"),
    )
    # the count comes first: the spread of a single gap is NULL
    few = (F.col("n") < s.sample_threshold) | (F.col("std") < s.std_threshold)
    return x.withColumn("one_row", few | (F.least("n_high", "n_flat", "n_low") == 0))


def thresholds(gaps: DataFrame, s: Segmentation) -> DataFrame:
    """(pair, kkod, period, min, median, max): one row `all`, or three of the inliers of each period.

    A group holds the gaps of one pair and period as distinct values with counts, of which a day has 86,401 at most
    in whole seconds, so that a busy pair does not gather its records in one task."""
    kinds = classify(gaps, s)
    kkod = E.pair_key(F.col(PAIR[0]), F.col(PAIR[1])).alias("kkod")
    whole = kinds.where("one_row").select(*PAIR, kkod, F.lit("all").alias("period"), "min", "median", "max")
    split = kinds.where("not one_row").select(*PAIR)
    x = gaps.withColumn("period", E.period(F.col("hour"), s.high_hours, s.flat_hours)).join(split, list(PAIR), "left_semi")
    counted = x.groupBy(*PAIR, "period", "time").agg(F.count("*").alias("n"))
    trees, seed = s.n_estimators, s.random_state

    def filtered(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("time")
        time, n = pdf["time"].to_numpy(float), pdf["n"].to_numpy(np.int64)
        kept = inlier_mask(time, n, trees, seed, "-".join(map(str, key)))
        time, n = time[kept], n[kept]
        return pd.DataFrame({"from_KKBH": [key[0]], "to_KKBH": [key[1]], "kkod": [f"{key[0]}-{key[1]}"], "period": [key[2]], "min": [time[0]], "median": [weighted_median(time, n)], "max": [time[-1]]})

    return whole.unionByName(counted.groupBy(*PAIR, "period").applyInPandas(filtered, ROWS))


def threshold_map(rows: DataFrame) -> DataFrame:
    """One row per pair: a map from period to (min, max)."""
    entry = F.struct("period", F.struct("min", "max"))
    return rows.groupBy(*PAIR).agg(F.map_from_entries(F.collect_list(entry)).alias("periods"))


def bounds(periods: Column, hour: Column, b: Column, s: Segmentation) -> tuple[Column, Column]:
    """(least, most) seconds that a move may take: a pair's only row whatever its label, else that of the hour's period;
    the default where there is none, where it is no number, or where it is narrow and beyond B; capped by B times the scale."""
    top = F.bround(b * s.cap_scale).cast("double")
    entry = F.when(F.size(periods) == 1, F.element_at(F.map_values(periods), 1)).otherwise(periods[E.period(hour, s.high_hours, s.flat_hours)])
    low, high = entry["min"], entry["max"]
    default = periods.isNull() | entry.isNull() | E.nan_like(low) | E.nan_like(high) | ((low >= b) & (high - low < 60))
    least = F.when(default, F.lit(1.0)).otherwise(F.when(low < 0, F.ceil(low)).otherwise(F.floor(low)).cast("double"))
    return least, F.least(F.when(default, top).otherwise(F.bround(high).cast("double")), top)
