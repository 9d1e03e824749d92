"""The pipelines as a whole: each is a lazy plan from sources to sinks. Paths are those of any file system that Spark reads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollway.config import Rules, Segmentation, Topology
from tollway.operators import clean, diagnostics, impute, mapping, match, rules, stats, thresholds, topology, trips
from tollway.sources import arrays, shapefile, sinks, tables


@dataclass(frozen=True)
class Sources:
    """Inputs of the pass pipelines."""

    raw: DataFrame
    checkpoints: DataFrame
    route: DataFrame
    vehicles: DataFrame | None = None


def preprocess(s: Sources, r: Rules) -> tuple[DataFrame, DataFrame]:
    """(passes, vehicle table) of included records at mapped checkpoints."""
    center = clean.center_filter(clean.with_sequence(s.raw), s.checkpoints)
    passes = mapping.match_topology(rules.valid_records(center, r), s.route, mapping.with_coordinates(s.checkpoints))
    return passes, stats.vehicle_info(passes)


def statistics(passes: DataFrame, r: Rules) -> tuple[DataFrame, DataFrame]:
    """(hourly volumes, gap histogram) of passes, with types repaired if they come from text."""
    typed = clean.with_sequence(passes).withColumns({"GCSJ": F.col("GCSJ").cast("timestamp_ntz"), "KKBH": F.col("KKBH").cast("string")})
    return stats.hourly_volume(typed, r), stats.gap_histogram(typed, r).drop("ordinal")


def supplement(s: Sources, r: Rules, distribution: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(excluded records with rebuilt attributes, device attributes)."""
    if s.vehicles is None:
        raise ValueError("the supplement needs a vehicle table")
    raw = clean.with_sequence(s.raw)
    normal = clean.normalize_for_split(clean.center_filter(raw, s.checkpoints), r.timestamp_formats)
    mapped = mapping.match_topology(rules.excluded(normal, r), s.route, mapping.with_coordinates(s.checkpoints))
    dist = impute.sampling_distribution(raw, r.timestamp_formats) if distribution is None else distribution
    pool = impute.vehicle_pool(s.vehicles, r)
    if pool.isEmpty():
        raise ValueError("the vehicle table has no vehicle of a valid class and fuel")
    # both sinks read the device table
    attributes = sinks.checkpointed(impute.device_attributes(mapped, pool, dist, r))
    return impute.rebuild(mapped, attributes), attributes


def partition(records: DataFrame, route: DataFrame, g: Segmentation) -> tuple[DataFrame, DataFrame, DataFrame, dict]:
    """(trips, thresholds, gaps, metadata) of excluded records. Thresholds are learnt before records off the route go."""
    x = clean.normalize_for_partition(records)
    gaps = sinks.checkpointed(stats.gaps(x).drop("CLTMBH"))  # read by four plans
    b = sinks.checkpointed(thresholds.fixed_threshold(gaps, g))
    fixed = b.first()["B"]
    if fixed is None:
        raise ValueError("no two passes of a vehicle on one date: there is nothing to learn thresholds from")
    rows = sinks.checkpointed(thresholds.thresholds(gaps, g))
    pts = trips.points(mapping.on_route(x, route), mapping.node_map(route))
    found = trips.trips(trips.with_bounds(pts, rows, b, g), g)
    about = {"fixed_b": fixed, "cap": round(g.cap_scale * fixed), "gaps": gaps.count(), "threshold_rows": rows.count()}
    return found, rows.drop("from_KKBH", "to_KKBH"), gaps.select("KKOD", "time", "hour"), about


def road_graph(roads: DataFrame, t: Topology) -> tuple[DataFrame, DataFrame]:
    """(nodes, edge table)."""
    pts = topology.points(roads)
    nodes = topology.nodes(pts)
    return nodes.select("name", "lon", "lat"), topology.edge_table(topology.edges(pts, t), nodes)


def match_checkpoints(points: DataFrame, nodes: DataFrame, t: Topology) -> DataFrame:
    """node, KKBH, dist_m."""
    return match.one_to_one(match.candidates(points, nodes, t)).select("node", "KKBH", "dist_m", "seq")


def diagnose(s: Sources, rebuilt: DataFrame, attributes: DataFrame, r: Rules, k: int = 20, with_raw: bool = True) -> dict[str, DataFrame]:
    """The diagnostic reports by name."""
    raw = clean.with_sequence(s.raw)
    center = clean.center_filter(raw, s.checkpoints)
    normal = sinks.checkpointed(clean.normalize_for_split(center, r.timestamp_formats))  # read by nearly every report
    inside, outside = rules.included(normal, r), rules.excluded(normal, r)
    dist = {
        "included": stats.pair_distribution(inside),
        "vehicle": stats.pair_distribution(impute.vehicle_pool(s.vehicles, r)),
        "sampled": stats.pair_distribution(attributes.where("assigned_by_sampling")),
    }
    if with_raw:
        dist["raw"] = impute.sampling_distribution(raw, r.timestamp_formats).withColumnRenamed("p", "ratio")
    own = stats.pair_distribution(rebuilt)
    one = F.lit(1).alias("one")
    share = diagnostics.local_share(diagnostics.final_records(mapping.on_route(inside, s.route), rebuilt), r)
    level = lambda n: F.max(F.when(F.col("level") == n, F.col("ratio"))).alias(f"final_local_{n}_ratio")
    counts = [
        clean.profile(center, r.timestamp_formats).select(F.col("after_dedup").alias("center_records_before_split"), F.col("total_removed").alias("clean_removed_total"), F.col("dropna_removed").alias("clean_removed_dropna"), F.col("dedup_removed").alias("clean_removed_dedup"), one),
        inside.agg(F.count("*").alias("included_records"), one),
        outside.agg(F.count("*").alias("excluded_records"), one),
        mapping.on_route(outside, s.route).agg(F.count("*").alias("excluded_mapped_records"), one),
        mapping.off_route(outside, s.route).agg(F.count("*").alias("excluded_unmapped_records"), one),
        share.agg(level("record"), level("device"), one),
    ]
    summary = counts[0]
    for x in counts[1:]:
        summary = summary.join(x, "one")
    reports = {
        "dedup_key_conflict_groups_top": diagnostics.conflict_top(clean.conflict_groups(clean.typed(center, r.timestamp_formats)), k),
        "excluded_unmapped_top": mapping.unmapped_top(outside, s.route, k),
        "leading_zero_probe": mapping.leading_zero_hits(outside, s.route),
        "local_plate_share": share,
        "sampled_devices": diagnostics.sampled_share(attributes),
        "sampled_device_distribution": dist["sampled"],
        "diagnostics_summary": diagnostics.unpivot(summary.drop("one")),
    }
    for name in ("included", "vehicle", "raw"):
        if name in dist:
            reports[f"dist_compare_supplement_vs_{name}"] = stats.compare_distributions(own, dist[name], "supplement", name)
    return reports


def read_source(spark: SparkSession, name: str, path: str, encoding: str | None = None, id_field: str = "KKBH") -> DataFrame:
    """The table at a path by its kind: shapefiles of checkpoints and roads, match arrays of the route, else Parquet or CSV."""
    if path.endswith(".shp") and name in ("checkpoints", "roads"):
        charset = encoding or "utf-8"
        return shapefile.checkpoints(spark, path, id_field, charset) if name == "checkpoints" else shapefile.roads(spark, path, charset)
    if path.endswith(".npy") and name == "route":
        return arrays.read_match_npy(spark, path)
    return tables.read_table(spark, path, encoding)


def read_sources(spark: SparkSession, paths: dict[str, str], encoding: str | None = None, id_field: str = "KKBH") -> Sources:
    read = lambda name: read_source(spark, name, paths[name], encoding, id_field) if name in paths else None
    return Sources(read("raw"), read("checkpoints"), read("route"), read("vehicles"))
