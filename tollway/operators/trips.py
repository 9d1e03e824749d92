"""Trips from each vehicle's passes."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tollway.config import Segmentation
from tollway.functions import exprs as E
from tollway.operators import thresholds as T

CLOSED = pa.schema([("CLTMBH", pa.string()), ("trip", pa.int64()), ("pos", pa.list_(pa.string())), ("checkpoint", pa.list_(pa.string())), ("micros", pa.list_(pa.int64()))])
CLOSED_DDL = "CLTMBH string, trip long, pos array<string>, checkpoint array<string>, micros array<long>"


def points(passes: DataFrame, nodes: DataFrame) -> DataFrame:
    """Passes at mapped checkpoints, numbered by vehicle and time (z from 0), of vehicles with two passes at least before mapping."""
    by = W.partitionBy("CLTMBH")
    x = passes.select("CLTMBH", "KKBH", "GCSJ", "seq", F.count("*").over(by).alias("all"))
    x = x.where("all > 1").join(nodes.select("KKBH", F.col("node").alias("pos")), "KKBH")
    order = by.orderBy("GCSJ", "seq")
    return x.select("CLTMBH", "KKBH", "pos", "GCSJ", (F.row_number().over(order) - 1).alias("z"), F.count("*").over(by).alias("n"), F.lag("KKBH").over(order).alias("prev"), F.lag("GCSJ").over(order).alias("prev_time"))


def with_bounds(pts: DataFrame, rows: DataFrame, b: DataFrame, s: Segmentation) -> DataFrame:
    """Points with B and the bounds of the move from the point before, by the hour of arrival."""
    maps = T.threshold_map(rows).withColumnsRenamed({"from_KKBH": "prev", "to_KKBH": "KKBH"})
    fixed = b.first()["B"]  # one number
    x = pts.join(maps, ["prev", "KKBH"], "left").withColumn("B", F.lit(fixed).cast("double"))
    least, most = T.bounds(F.col("periods"), F.hour("GCSJ"), F.col("B"), s)
    return x.withColumns({"least": least, "most": most}).drop("periods")


def _follow(least_micros: float):
    """The sequential part. State is the open trip and how many came before it; both run on from batch to batch, as input is
    sorted by vehicle and time within a partition. A trip leaves when it is closed, so it needs no second exchange."""

    def follow(batches):
        vehicle, trip, open_, before = None, 0, [], None
        names = ("CLTMBH", "z", "n", "KKBH", "pos", "micros", "prev", "least", "most", "B")
        for batch in batches:
            out = []
            for v, z, n, kkbh, pos, at, prev, least, most, b in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                point = (pos, kkbh, at)
                if z == 0:
                    vehicle, trip, open_, before = v, 0, [], point
                    continue
                ti = (at - (open_[-1] if open_ else before)[2]) / 1e6
                accepted = kkbh != prev and ti != 0 and least <= ti <= most
                ends = not accepted and ti > (most if kkbh != prev else b)
                if accepted:
                    # the very first point joins its successor
                    open_ = [before] if z == 1 else open_
                    open_.append(point)
                if ends or (accepted and z == n - 1 and z != 1):
                    if len(open_) > 1 and open_[-1][2] - open_[0][2] > least_micros:
                        out.append((vehicle, trip, *map(list, zip(*open_, strict=True))))
                if ends:
                    trip, open_ = trip + 1, [point]
                before = point
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), CLOSED, strict=True)], schema=CLOSED)

    return follow


def _collected(kept: DataFrame, s: Segmentation) -> DataFrame:
    steps = F.array_sort(F.collect_list(F.struct("z", "pos", "KKBH", "GCSJ")))
    x = kept.groupBy("CLTMBH", "trip").agg(steps.alias("x"), F.max("closed").alias("closed"))
    x = x.select(
        "CLTMBH", "trip", "closed", F.col("x.pos").alias("pos"), F.col("x.KKBH").alias("checkpoint"), F.col("x.GCSJ").alias("time"), F.col("x")[0]["GCSJ"].alias("start"), F.element_at("x", -1)["GCSJ"].alias("stop"),
    ).withColumns({"travel": E.seconds_between(F.col("start"), F.col("stop")), "n_points": F.size("pos")})
    return x.where((F.col("n_points") > 1) & (F.col("travel") > s.min_trip_seconds))


def trips(pts: DataFrame, s: Segmentation) -> DataFrame:
    """Trips by the sequential rule: CLTMBH, trip, pos, checkpoint, time, start, stop, travel, n_points. The points need bounds.

    A trip that is open when a vehicle's passes end is lost, unless the last pass was accepted into it."""
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("GCSJ"))
    x = pts.select("CLTMBH", F.col("z").cast("long"), F.col("n").cast("long"), "KKBH", "pos", micros.alias("micros"), "prev", "least", "most", "B")
    x = x.repartition("CLTMBH").sortWithinPartitions("CLTMBH", "z").mapInArrow(_follow(s.min_trip_seconds * 1e6), CLOSED_DDL)
    stamp = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    return x.select(
        "CLTMBH", "trip", "pos", "checkpoint", F.transform("micros", stamp).alias("time"), stamp(F.col("micros")[0]).alias("start"), stamp(F.element_at("micros", -1)).alias("stop"),
        ((F.element_at("micros", -1) - F.col("micros")[0]) / F.lit(1e6)).alias("travel"), F.size("pos").alias("n_points"),
    )


def trips_islands(pts: DataFrame, s: Segmentation, rows: DataFrame, b: DataFrame) -> DataFrame:
    """The other variant, on windows only: a gap counts from the raw point before, every point that is not accepted ends
    the trip, bounds are taken as they are, and the last trip of each vehicle is lost."""
    maps = T.threshold_map(rows).withColumnsRenamed({"from_KKBH": "prev", "to_KKBH": "KKBH"})
    top = F.lit(round(s.cap_scale * b.first()["B"])).cast("double")
    x = pts.where("z > 0").join(maps, ["prev", "KKBH"], "left")
    own = F.coalesce(F.col("periods")["all"], F.when(F.map_contains_key("periods", "all"), None).otherwise(F.col("periods")[E.period(F.hour("GCSJ"), s.high_hours, s.flat_hours)]))
    least, most = F.coalesce(own["min"], F.lit(1.0)), F.least(F.coalesce(own["max"], top), top)
    ti = E.seconds_between(F.col("prev_time"), F.col("GCSJ"))
    ok = F.coalesce((F.col("z") >= 2) & (F.col("KKBH") != F.col("prev")) & ti.between(least, most), F.lit(False))
    by = W.partitionBy("CLTMBH")
    x = x.withColumn("trip", F.sum(F.when(ok, 0).otherwise(1)).over(by.orderBy("z")).cast("long"))
    x = x.withColumn("closed", F.col("trip") < F.max("trip").over(by))
    return _collected(x.select("CLTMBH", "z", "trip", "pos", "KKBH", "GCSJ", "closed"), s).where("closed").drop("closed")


def length_stats(found: DataFrame) -> DataFrame:
    n = F.size("pos")
    return found.agg(F.count("*").alias("trips"), F.avg(n).alias("mean_points"), F.median(n).alias("median_points"), F.min(n).alias("min_points"), F.max(n).alias("max_points"))
