"""Joins with checkpoints and the road network."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollway.functions import exprs as E
from tollway.operators.clean import keep_first, require, with_sequence

NODE_COLUMNS = ("node", "pos_name", "NODE", "realpos")


def match_topology(df: DataFrame, route: DataFrame, points: DataFrame) -> DataFrame:
    """Records at checkpoints of the route table (a checkpoint listed twice doubles its records), with coordinates where known."""
    keys = require(route, ["KKBH"], "route table").select(E.strip(F.col("KKBH").cast("string")).alias("KKBH"))
    where = points.select(E.strip(F.col("KKBH").cast("string")).alias("KKBH"), "Longitude", "Latitude")
    return df.join(keys, "KKBH", "inner").join(where, "KKBH", "left")


def with_coordinates(points: DataFrame) -> DataFrame:
    """Longitude and Latitude from the geometry, if the table lacks them."""
    if {"Longitude", "Latitude"} <= set(points.columns):
        return points
    require(points, ["geometry"], "checkpoints")
    return points.withColumns({"Longitude": F.col("geometry.lon"), "Latitude": F.col("geometry.lat")})


def _route_keys(route: DataFrame) -> DataFrame:
    return route.select(E.strip(F.col("KKBH").cast("string")).alias("KKBH")).distinct()


def on_route(df: DataFrame, route: DataFrame) -> DataFrame:
    return df.join(_route_keys(route), "KKBH", "left_semi")


def off_route(df: DataFrame, route: DataFrame) -> DataFrame:
    return df.join(_route_keys(route), "KKBH", "left_anti")


def unmapped_top(df: DataFrame, route: DataFrame, k: int) -> DataFrame:
    """The k checkpoints off the route with most records; ties by id."""
    return off_route(df, route).groupBy("KKBH").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "KKBH").limit(k)


def leading_zero_hits(df: DataFrame, route: DataFrame) -> DataFrame:
    """One row: records off the route, and those of them that only leading zeros keep off."""
    bare = _route_keys(route).select(E.no_leading_zeros(F.col("KKBH")).alias("bare"), F.lit(1).alias("hit")).distinct()
    off = off_route(df, route).withColumn("bare", E.no_leading_zeros(F.col("KKBH")))
    return off.join(bare, "bare", "left").agg(F.count("*").alias("unmapped"), F.count("hit").alias("hits"))


def node_map(match: DataFrame) -> DataFrame:
    """(KKBH, node): the last row of each checkpoint, from the first node column there is; blanks do not count."""
    require(match, ["KKBH"], "match table")
    column = next((c for c in NODE_COLUMNS if c in match.columns), None)
    if column is None:
        raise ValueError(f"match table has none of the columns {', '.join(NODE_COLUMNS)}")
    x = with_sequence(match).select(E.strip(E.as_text(F.col("KKBH"))).alias("KKBH"), E.strip(E.as_text(F.col(column))).alias("node"), "seq")
    return keep_first(x.where("KKBH <> '' and node <> ''"), ["KKBH"], [-F.col("seq")]).select("KKBH", "node")
