"""Road polylines to a directed graph: nodes(lon, lat, name) and edges(start, end, kind, duration, length).

A node is a coordinate; its name is an attribute made from all roads that visit it. ``name_collisions`` lists names
that several coordinates share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollway.config import Topology
from tollway.functions import exprs as E
from tollway.functions.geodesic import geodesic_m, haversine_m
from tollway.operators.clean import require, with_sequence
from tollway.sources import sinks


def line_of(parts):
    """Points of a geometry: a single line, or the second part of a line of several parts; fewer than two parts of several are an error."""
    return F.when(F.size(parts) >= 2, F.element_at(parts, 2)).otherwise(F.raise_error(F.lit("a line of several parts needs two parts at least")))


def points(roads: DataFrame) -> DataFrame:
    """One row per point of each road: seq, road_id, oneway, fclass, maxspeed, pt, n_pts, lon, lat, and the next point's to_lon, to_lat. A coordinate counts once per road, where it comes first.

    roads: osm_id, oneway, fclass, maxspeed, and `line` (array of lon, lat) or `parts` (array of such arrays)."""
    x = with_sequence(require(roads, ["oneway", "fclass", "maxspeed"]))
    line = F.col("line") if "line" in x.columns else line_of(F.col("parts"))
    road_id = F.coalesce(F.col("osm_id").cast("string"), F.col("seq").cast("string")) if "osm_id" in x.columns else F.col("seq").cast("string")
    x = x.select(
        "seq", road_id.alias("road_id"), E.oneway(F.col("oneway")).alias("oneway"), F.coalesce(F.col("fclass").cast("string"), F.lit("")).alias("fclass"),
        E.maxspeed(F.col("maxspeed")).alias("maxspeed"), F.array_distinct(line).alias("line"),
    ).withColumn("n_pts", F.size("line")).where("n_pts >= 2").withColumn("next", F.slice("line", 2, F.col("n_pts")))
    x = x.select("seq", "road_id", "oneway", "fclass", "maxspeed", "n_pts", F.posexplode(F.arrays_zip("line", "next")).alias("pt", "p"))
    return x.select("*", *[F.col(f"p.{p}.{c}").alias(to + c) for p, to in (("line", ""), ("next", "to_")) for c in ("lon", "lat")]).drop("p")


def segments(pts: DataFrame) -> DataFrame:
    """One row per pair of neighbouring points of a road."""
    return pts.where("to_lon is not null")


def nodes(pts: DataFrame) -> DataFrame:
    """(lon, lat, name, visits). One visit: `O-`, `D-` or the point's index, and the road; several: `LINK-` and the roads in order."""
    # place: order along the road, and whether the road ends there
    visit = F.struct("seq", (F.col("pt") * 2 + (F.col("pt") == F.col("n_pts") - 1).cast("int")).alias("place"), "road_id")
    x = pts.groupBy("lon", "lat").agg(F.sort_array(F.collect_list(visit)).alias("v"))
    first, place = F.col("v")[0], F.col("v")[0]["place"]
    single = F.when(place < 2, "O").when(place % 2 == 1, "D").otherwise(F.shiftright(place, 1).cast("string"))
    name = F.when(F.size("v") == 1, F.concat_ws("-", single, first["road_id"])).otherwise(F.concat(F.lit("LINK-"), F.array_join(F.col("v.road_id"), "-")))
    return x.select("lon", "lat", name.alias("name"), F.size("v").alias("visits"))


def name_collisions(nodes_: DataFrame) -> DataFrame:
    return nodes_.groupBy("name").agg(F.count("*").alias("coordinates")).where("coordinates > 1")


def edges(pts: DataFrame, t: Topology, exact: bool = True) -> DataFrame:
    """(start_lon, start_lat, end_lon, end_lat, length, kind, duration): both ways unless oneway; the last road that gives an edge wins.

    exact: geodesic lengths on the ellipsoid; else on a sphere, without Python. Only edges that won are measured, along the road's own direction."""
    there = F.struct(F.lit(0).alias("way"), F.col("lon").alias("start_lon"), F.col("lat").alias("start_lat"), F.col("to_lon").alias("end_lon"), F.col("to_lat").alias("end_lat"))
    back = F.struct(F.lit(1).alias("way"), F.col("to_lon").alias("start_lon"), F.col("to_lat").alias("start_lat"), F.col("lon").alias("end_lon"), F.col("lat").alias("end_lat"))
    ways = F.when(F.col("oneway") == "F", F.array(there)).when(F.col("oneway") == "T", F.array(back)).otherwise(F.array(there, back))
    x = segments(pts).select("seq", "pt", E.road_kind(F.col("fclass")).alias("kind"), E.speed(F.col("fclass"), F.col("maxspeed"), t).alias("speed"), F.explode(ways).alias("w"))
    x = x.select("w.*", "seq", "pt", "kind", "speed")
    x = x.groupBy("start_lon", "start_lat", "end_lon", "end_lat").agg(F.max(F.struct("seq", "pt", "way", "kind", "speed")).alias("last"))
    run = [F.when(F.col("last.way") == 0, F.col(a)).otherwise(F.col(b)) for a, b in (("start_lon", "end_lon"), ("start_lat", "end_lat"), ("end_lon", "start_lon"), ("end_lat", "start_lat"))]
    x = x.withColumn("length", (geodesic_m if exact else haversine_m)(*run))
    return x.select("start_lon", "start_lat", "end_lon", "end_lat", "length", "last.kind", (F.col("length") / (F.col("last.speed") / 3.6)).alias("duration"))


# Parts of the stored tables, bytes of names that a task holds for one side, and parts to one side of a cell at most.
PARTS, BLOCK, CELLS = 16, 80 << 20, 16
SINGLE = "spark.sql.maxSinglePartitionBytes"
#: Settings that cells need, and their values by default. Spark estimates a join by the product of its sides, and would exchange a
#: cell that it takes for larger than the first. Under the others a Parquet file of a cell has each name once, as an entry of its
#: dictionary: pages of 1 MB are too short to show that names come again, and two open ones must fit a row group.
RAISED = {SINGLE: (1 << 62, 128 << 20), "parquet.dictionary.page.size": (BLOCK + (BLOCK >> 1), 1 << 20), "parquet.page.size": (16 << 20, 1 << 20)}


def edge_table(edges_: DataFrame, nodes_: DataFrame, long: int = 256) -> DataFrame:
    """start_node, end_node, kind, duration, road_length, road_type.

    A name lists all roads of its node, so where nodes have many, edges with names are far larger than both tables. Names of
    over ``long`` bytes, as edges meet them, are not exchanged: both tables are stored once, and each cell of start and end
    nodes is joined in a task of its own; written as Parquet in this session, its names take the room of its nodes, not of its
    edges (RAISED). Names of more than BLOCK * CELLS bytes in all are joined like short ones."""
    spark = edges_.sparkSession
    part = lambda lon, lat: F.pmod(F.hash(lon, lat), F.lit(PARTS))
    names = sinks.stored(nodes_.select("lon", "lat", "name", F.octet_length("name").cast("long").alias("bytes"), part("lon", "lat").alias("part")), by="part")
    found = edges_.withColumns({"start_part": part("start_lon", "start_lat"), "end_part": part("end_lon", "end_lat")})
    found = sinks.stored(found.sortWithinPartitions("start_part", "end_part"))
    # a node's edges are as many as its visits, about, and so is its name's length
    total, mean = names.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.sum(F.col("bytes").cast("double") * F.col("bytes")) / F.sum("bytes"), F.lit(0.0))).first()
    at = lambda side, x=names: x.select(F.col("lon").alias(f"{side}_lon"), F.col("lat").alias(f"{side}_lat"), F.col("name").alias(f"{side}_node"))
    if mean <= long or total > BLOCK * CELLS:
        x = found.join(at("start"), ["start_lon", "start_lat"]).join(at("end"), ["end_lon", "end_lat"])
    else:
        blocks = next(n for n in (4, 8, CELLS) if n == CELLS or total <= BLOCK * n)
        bounds = [(k * PARTS // blocks, (k + 1) * PARTS // blocks - 1) for k in range(blocks)]
        block = lambda side, b: at(side, names.where(F.col("part").between(*b)).coalesce(1)).hint("shuffle_hash")
        cell = lambda a, b: found.where(F.col("start_part").between(*a) & F.col("end_part").between(*b)).coalesce(1)
        for setting, (value, default) in RAISED.items():
            if spark.conf.get(setting, str(default)).lower() in (f"{default >> 20}m", f"{default >> 20}mb", str(default), f"{default}b"):
                spark.conf.set(setting, str(value))
        # that a join's output is a single partition Spark only sees when that is said once more
        cells = [cell(a, b).join(block("start", a), ["start_lon", "start_lat"]).coalesce(1).join(block("end", b), ["end_lon", "end_lat"]) for a in bounds for b in bounds]
        x = reduce(DataFrame.unionAll, cells)
    return x.select("start_node", "end_node", "kind", "duration", F.col("length").alias("road_length"), E.mapped(F.col("kind"), E.KIND_NAMES).alias("road_type"))


def totals(edges_: DataFrame, nodes_: DataFrame) -> DataFrame:
    """One row: nodes, edges, kilometres."""
    e = edges_.agg(F.count("*").alias("edges"), (F.sum("length") / 1000).alias("total_km"), F.lit(1).alias("one"))
    return nodes_.agg(F.count("*").alias("nodes"), F.lit(1).alias("one")).join(e, "one").drop("one")
