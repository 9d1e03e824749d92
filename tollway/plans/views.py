"""Domain tables derived from the general test tables, in SQL that both engines read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Raw pass records: every kind of dirt that cleaning meets (blanks around ids, missing codes, times that do not parse).
RAW = """
select event_id as seq,
  substring(cast(ts as string), 1, 10) || ' 00:00:00' as GCRQ,
  case when event_id % 97 = 0 then 'unknown' else substring(cast(ts as string), 1, {cut}) || '{rest}' end as GCSJ,
  case when event_id % 101 = 0 then cast(null as string) when event_id % 13 = 0 then ' ' || event_type || ' ' else event_type end as KKBH,
  case user_id % 5 when 0 then '粤E' when 1 then '粤X' when 2 then '粤Y' when 3 then ' 粤E' else '京A' end as FZJG,
  case when event_id % 11 = 0 then ' V' || cast(user_id as string) else 'V' || cast(user_id as string) end as CLTMBH,
  case when event_id % 53 = 0 then cast(null as string) when user_id % 7 = 6 then 'M1X' else substring('K1K2K3K4H1H2H3H4', cast(user_id % 8 as int) * 2 + 1, 2) || '1' end as CLLX,
  case when event_id % 59 = 0 then cast(null as string) when user_id % 6 = 5 then 'C' when user_id % 2 = 0 then 'A' else ' B' end as RLLX
from events
"""

#: Clean passes, as the pipelines hand them on.
PASSES = """
select event_id as seq, substring(cast(ts as string), 1, 10) as GCRQ, cast(substring(cast(ts as string), 1, 19) as {timestamp}) as GCSJ,
  event_type as KKBH, case user_id % 5 when 0 then '粤E' when 1 then '粤X' when 2 then '粤Y' when 3 then '粤E' else '京A' end as FZJG,
  'V' || cast(user_id as string) as CLTMBH, substring('K1K2K3K4H1H2H3H4', cast(user_id % 8 as int) * 2 + 1, 2) as CLLX,
  case when user_id % 2 = 0 then 'A' else 'B' end as RLLX
from events
"""

#: Vehicle table: two of three vehicles, labels instead of fuel codes.
VEHICLES = """
select c_custkey as seq, 'V' || cast(c_custkey as string) as CLTMBH,
  case when c_custkey % 17 = 0 then 'Z9' else substring('K1K2K3K4H1H2H3H4', cast(c_nationkey % 8 as int) * 2 + 1, 2) end as CLLX,
  case when c_nationkey % 2 = 0 then '汽油' else '柴油' end as fuel_type
from customer where c_custkey % 3 <> 0
"""

#: Checkpoints on the route: two of five kinds are missing, one has a leading zero too many.
ROUTE = """
select distinct case when event_type = (select min(event_type) from events) then '0' || event_type else event_type end as KKBH,
  'N-' || event_type as node
from events where event_type <> (select max(event_type) from events)
"""

#: Road points: one road per order, on a grid of 200 by 100 coordinates, so that roads meet.
ROADS = """
select l_orderkey as seq, cast(l_orderkey as string) as osm_id,
  case l_orderkey % 5 when 0 then 'F' when 1 then ' t ' when 2 then 'x' when 3 then cast(null as string) else 'B' end as oneway,
  case l_orderkey % 6 when 0 then 'motorway' when 1 then 'trunk_link' when 2 then 'primary' when 3 then 'residential' when 4 then 'living_street' else 'track' end as fclass,
  case l_orderkey % 7 when 0 then '60 km/h' when 1 then '80;60' when 2 then 'none' when 3 then cast(null as string) when 4 then '-5' when 5 then ' 100.5 ' else '' end as maxspeed,
  row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey) as pt,
  113.0 + cast(l_partkey % 200 as double) / 2000.0 as lon, 23.0 + cast(l_suppkey % 100 as double) / 2000.0 as lat
from lineitem
"""

#: Checkpoint positions, some 20 to 80 metres beside nodes of the grid, many of them near the same node.
POSITIONS = """
select s_suppkey as seq, 'P' || cast(s_suppkey as string) as KKBH,
  113.0 + cast(s_suppkey * 7 % 200 as double) / 2000.0 + cast(s_suppkey % 5 - 2 as double) / 10000.0 as Longitude,
  23.0 + cast(s_suppkey * 3 % 100 as double) / 2000.0 + cast(s_suppkey % 4 as double) / 12000.0 as Latitude
from supplier
"""

TABLES = "region nation customer supplier part orders lineitem events".split()


def view(spark: SparkSession, sf_dir: str, sql: str, by: str | None = None) -> DataFrame:
    """The view's rows. Tables are named in braces for Spark, so that nothing is registered in the session.

    by: rows of a key are brought together as they are read, before the view adds columns."""
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    used = [t for t in TABLES if f"from {t}" in sql]
    for t in used:
        sql = sql.replace(f"from {t}", f"from {{{t}}}")
    return spark.sql(sql, **{t: read(t).repartition(by) if by else read(t) for t in used})


def raw_sql(hourly: bool = False) -> str:
    return RAW.replace("{cut}", "13" if hourly else "19").replace("{rest}", ":00:00" if hourly else "")


def passes_sql(engine: str) -> str:
    return PASSES.replace("{timestamp}", "timestamp_ntz" if engine == "spark" else "timestamp")


def raw(spark, sf_dir, hourly=False) -> DataFrame:
    return view(spark, sf_dir, raw_sql(hourly))


def passes(spark, sf_dir) -> DataFrame:
    return view(spark, sf_dir, passes_sql("spark"))


def vehicles(spark, sf_dir) -> DataFrame:
    return view(spark, sf_dir, VEHICLES)


def route(spark, sf_dir) -> DataFrame:
    return view(spark, sf_dir, ROUTE)


def positions(spark, sf_dir) -> DataFrame:
    return view(spark, sf_dir, POSITIONS)


def roads(spark, sf_dir) -> DataFrame:
    from pyspark.sql import functions as F

    x = view(spark, sf_dir, ROADS, by="l_orderkey")
    line = F.transform(F.array_sort(F.collect_list(F.struct("pt", "lon", "lat"))), lambda p: F.struct(p["lon"].alias("lon"), p["lat"].alias("lat")))
    return x.groupBy("seq").agg(*[F.first(c).alias(c) for c in ("osm_id", "oneway", "fclass", "maxspeed")], line.alias("line"))
