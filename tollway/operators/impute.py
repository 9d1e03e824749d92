"""Imputation of vehicle attributes: lookup in a vehicle table, else weighted sampling by device."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tollway.config import CLASS_CODES, CLASS_LABELS, FUEL_CODES, FUEL_LABELS, Rules
from tollway.functions import exprs as E
from tollway.operators.clean import KEY, keep_first, require, with_sequence

#: Cells of [0, 1) in which draws meet ranges.
CELLS = 1024


def vehicle_pool(df: DataFrame, r: Rules) -> DataFrame:
    """(CLTMBH, CLLX, RLLX, veh_type, fuel_type): first valid record of each vehicle; codes from labels where a code column is missing."""
    x = with_sequence(require(df, ["CLTMBH"], "vehicle table")).withColumn("CLTMBH", E.strip(E.as_text(F.col("CLTMBH"))))
    for code, label, table in (("CLLX", "veh_type", CLASS_CODES), ("RLLX", "fuel_type", FUEL_CODES)):
        if code not in x.columns and label in x.columns:
            x = x.withColumn(code, E.mapped(E.strip(F.col(label)), table))
    require(x, ["CLLX", "RLLX"], "vehicle table")
    x = x.select("CLTMBH", E.prefix2(E.strip(E.as_text(F.col("CLLX")))).alias("CLLX"), E.strip(E.as_text(F.col("RLLX"))).alias("RLLX"), "seq")
    x = x.where(F.col("CLLX").isin(list(r.valid_vehicle_types)) & F.col("RLLX").isin(list(r.valid_fuel_types)) & (F.col("CLTMBH") != ""))
    first = keep_first(x, ["CLTMBH"]).drop("seq")
    return first.withColumns({"veh_type": E.mapped(F.col("CLLX"), CLASS_LABELS), "fuel_type": E.mapped(F.col("RLLX"), FUEL_LABELS)})


def sampling_distribution(raw: DataFrame, formats: Sequence[str] = ()) -> DataFrame:
    """(CLLX, RLLX, count, p) of raw records with all columns, deduplicated by key; classes and fuels are not restricted."""
    need = (*KEY, "CLLX", "RLLX")
    x = with_sequence(require(raw, need)).dropna(subset=list(need))
    x = x.select(
        E.date_part(F.col("GCRQ").cast("string")).alias("GCRQ"), E.parse_time(F.col("GCSJ"), formats).alias("GCSJ"), E.strip(F.col("CLTMBH").cast("string")).alias("CLTMBH"),
        E.prefix2(E.strip(F.col("CLLX").cast("string"))).alias("CLLX"), E.strip(F.col("RLLX").cast("string")).alias("RLLX"), "seq",
    ).where(F.col("GCSJ").isNotNull())
    for c in ("CLTMBH", "CLLX", "RLLX", "GCRQ"):
        x = x.where((F.col(c) != "") & (F.lower(c) != "nan"))
    counts = keep_first(x, KEY).groupBy("CLLX", "RLLX").agg(F.count("*").alias("count"))
    return counts.withColumn("p", F.col("count") / F.sum("count").over(W.partitionBy()))


def _ranges(counts: DataFrame, values: list[str]) -> DataFrame:
    """Cumulative share [lo, hi) of each value: larger counts first, then by value; the last ends above 1."""
    order = [F.desc("count"), *values]
    upto = F.sum("count").over(W.partitionBy().orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    total = F.sum("count").over(W.partitionBy())
    last = F.row_number().over(W.partitionBy().orderBy(F.asc("count"), *[F.desc(v) for v in values])) == 1
    return counts.select(*values, ((upto - F.col("count")) / total).alias("lo"), F.when(last, F.lit(2.0)).otherwise(upto / total).alias("hi"))


def _draw(devices: DataFrame, ranges: DataFrame, u: Column, values: list[str]) -> DataFrame:
    """Each device's range. Both sides meet in cells of [0, 1), so that it is an equi-join, however many ranges there are."""
    cell = lambda c: F.least(F.floor(c * CELLS), F.lit(CELLS - 1).cast("long"))
    own = ranges.withColumn("cell", F.explode(F.sequence(cell(F.col("lo")), cell(F.col("hi")))))
    x = devices.withColumn("u", u).withColumn("cell", cell(F.col("u")))
    return x.join(own, "cell").where((F.col("u") >= F.col("lo")) & (F.col("u") < F.col("hi"))).select(*devices.columns, *values)


def sample_devices(devices: DataFrame, dist: DataFrame, r: Rules) -> DataFrame:
    """(CLTMBH, CLLX, RLLX): one draw for each device, by a hash of seed and id, whatever the partitioning."""
    mode = r.sampling_mode.strip().lower()
    ids = devices.select("CLTMBH").distinct()
    if mode == "joint":
        return _draw(ids, _ranges(dist, ["CLLX", "RLLX"]), E.uniform(r.random_seed, F.col("CLTMBH")), ["CLLX", "RLLX"])
    if mode != "independent":
        raise ValueError(f"sampling_mode is joint or independent, not {r.sampling_mode}")
    out = ids
    for i, c in enumerate(("CLLX", "RLLX")):
        margin = dist.groupBy(c).agg(F.sum("count").alias("count"))
        out = _draw(out, _ranges(margin, [c]), E.uniform(r.random_seed + i, F.col("CLTMBH")), [c])
    return out


def device_attributes(excluded: DataFrame, pool: DataFrame, dist: DataFrame, r: Rules) -> DataFrame:
    """One row per device of the excluded records: codes from the pool, else sampled, and where they are from."""
    devices = excluded.select(F.col("CLTMBH").cast("string").alias("CLTMBH")).distinct()
    known = devices.join(pool.select("CLTMBH", F.col("CLLX").alias("pool_CLLX"), F.col("RLLX").alias("pool_RLLX")), "CLTMBH", "left")
    known = known.withColumn("is_in_vehicle_table", F.col("pool_CLLX").isNotNull() & F.col("pool_RLLX").isNotNull())
    drawn = sample_devices(known.where("not is_in_vehicle_table"), dist, r)
    both = known.join(drawn, "CLTMBH", "left")
    out = both.select("CLTMBH", F.coalesce("pool_CLLX", "CLLX").alias("CLLX"), F.coalesce("pool_RLLX", "RLLX").alias("RLLX"), "is_in_vehicle_table", (~F.col("is_in_vehicle_table")).alias("assigned_by_sampling"))
    labels = {"veh_type": E.mapped(F.col("CLLX"), CLASS_LABELS), "fuel_type": E.mapped(F.col("RLLX"), FUEL_LABELS), "device_id": F.col("CLTMBH")}
    return out.withColumns(labels)


def rebuild(excluded: DataFrame, attributes: DataFrame) -> DataFrame:
    """Excluded records with rebuilt codes; the original ones are kept as CLLX_raw and RLLX_raw."""
    x = excluded.withColumn("CLTMBH", E.strip(F.col("CLTMBH"))).withColumnsRenamed({"CLLX": "CLLX_raw", "RLLX": "RLLX_raw"}).withColumn("device_id", F.col("CLTMBH"))
    return x.join(attributes.drop("device_id"), "CLTMBH", "left")
