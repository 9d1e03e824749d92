"""All queries of the traffic operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollway.config import Rules, Segmentation, Topology
from tollway.functions import exprs as E
from tollway.functions.geodesic import haversine_m
from tollway.operators import clean, diagnostics, impute, mapping, match, rules, stats, thresholds, topology, trips
from tollway.plans import oracle, views
from tollway.sources import sinks, tables

R, S, T = Rules(), Segmentation(), Topology()
#: Every pair in one row, so that SQL can follow.
PLAIN = replace(S, sample_threshold=10**9)

Query = Callable[[SparkSession, str], DataFrame]
_found: dict[str, tuple[Query, str | None]] = {}


def query(sql: str | None = None, hourly: bool = False, recursive: bool = False):
    def add(f: Query) -> Query:
        _found[f.__name__] = f, None if sql is None else oracle.query(sql, hourly, recursive)
        return f

    return add


def queries() -> dict[str, Query]:
    return {name: f for name, (f, _) in _found.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _found.items() if sql is not None}


def _normal(spark, sf_dir, hourly=False):
    return clean.normalize_for_split(views.raw(spark, sf_dir, hourly))


def _center(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_type").alias("KKBH"))
    top = e.agg(F.max("KKBH")).first()[0]
    return e.where(F.col("KKBH") != top).distinct()


NORMAL = "seq, GCRQ, GCSJ, KKBH, FZJG, CLTMBH, CLLX, RLLX"


# cleaning


@query(f"select {NORMAL} from normal", hourly=True)
def dedup_keep_first(spark, sf_dir):
    return _normal(spark, sf_dir, hourly=True).select(*NORMAL.split(", "))


@query("select seq, GCRQ, GCSJ, KKBH, CLTMBH from (select seq, split_part(coalesce(GCRQ, 'nan'), ' ', 1) as GCRQ, try_cast(GCSJ as timestamp) as GCSJ, trim(coalesce(KKBH, 'nan')) as KKBH, trim(CLTMBH) as CLTMBH from raw) where GCSJ is not null qualify row_number() over (partition by GCRQ, GCSJ, CLTMBH order by seq) = 1", hourly=True)
def normalize_partition(spark, sf_dir):
    return clean.normalize_for_partition(views.raw(spark, sf_dir, hourly=True)).select("seq", "GCRQ", "GCSJ", "KKBH", "CLTMBH")


@query("select seq, GCRQ, GCSJ, trim(KKBH) as KKBH, FZJG, CLTMBH, substring(coalesce(CLLX, 'nan'), 1, 2) as CLLX, RLLX from raw where KKBH is not null and trim(KKBH) in (select KKBH from center_ids)")
def center_semi_filter(spark, sf_dir):
    return clean.center_filter(views.raw(spark, sf_dir), _center(spark, sf_dir)).select(*NORMAL.split(", "))


@query("select count(*) as total_rows, count(*) filter (trim(KKBH) in (select KKBH from center_ids)) as matched_rows from raw where KKBH is not null")
def center_counts(spark, sf_dir):
    return clean.center_counts(views.raw(spark, sf_dir), _center(spark, sf_dir))


PROFILE = """select (select count(*) from raw) as before_dropna, (select count(*) from typed) as after_dropna, (select count(*) from raw) - (select count(*) from typed) as dropna_removed, (select count(*) from normal) as after_dedup,
(select count(*) from typed) - (select count(*) from normal) as dedup_removed, (select count(*) from raw) - (select count(*) from normal) as total_removed, count(*) as duplicate_group_count,
count(*) filter (has_conflict) as conflict_group_count, coalesce(sum(group_size) filter (has_conflict), 0)::bigint as conflict_row_count from groups"""
GROUPS = """groups as (select *, KKBH_nunique > 1 or FZJG_nunique > 1 or CLLX_nunique > 1 or RLLX_nunique > 1 as has_conflict from (select GCRQ, GCSJ, CLTMBH, count(*) as group_size, count(distinct KKBH) as KKBH_nunique,
count(distinct FZJG) as FZJG_nunique, count(distinct CLLX) as CLLX_nunique, count(distinct RLLX) as RLLX_nunique from typed group by 1, 2, 3) where group_size > 1)"""


@query(f", {GROUPS} {PROFILE}", hourly=True)
def clean_profile(spark, sf_dir):
    return clean.profile(views.raw(spark, sf_dir, hourly=True))


@query(f", {GROUPS} select * from groups", hourly=True)
def conflict_groups(spark, sf_dir):
    return clean.conflict_groups(clean.typed(views.raw(spark, sf_dir, hourly=True)))


@query(f", {GROUPS} select * from groups where has_conflict order by group_size desc, GCRQ, GCSJ, CLTMBH limit 20", hourly=True)
def conflict_groups_top(spark, sf_dir):
    return diagnostics.conflict_top(clean.conflict_groups(clean.typed(views.raw(spark, sf_dir, hourly=True))), 20)


@query("select seq, GCRQ, GCSJ, KKBH, CLTMBH from typed qualify count(*) over (partition by GCRQ, GCSJ, CLTMBH) > 1", hourly=True)
def duplicated_rows(spark, sf_dir):
    return clean.duplicated(clean.typed(views.raw(spark, sf_dir, hourly=True)), clean.KEY).select("seq", "GCRQ", "GCSJ", "KKBH", "CLTMBH")


@query("select event_id as seq, ts as GCSJ from events where microsecond(ts) % 1000000 <> 0 order by event_id limit 10")
def time_precision_samples(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("seq"), F.col("ts").alias("GCSJ"))
    return clean.fraction_samples(e)


# rules


@query(f"select {NORMAL}, excluded_by_cllx, excluded_by_rllx, excluded_by_fzjg, concat_ws('|', case when excluded_by_cllx then 'CLLX' end, case when excluded_by_rllx then 'RLLX' end, case when excluded_by_fzjg then 'FZJG' end) as excluded_reason from excluded")
def rule_split_flags(spark, sf_dir):
    return rules.excluded(_normal(spark, sf_dir), R).select(*NORMAL.split(", "), "excluded_by_cllx", "excluded_by_rllx", "excluded_by_fzjg", "excluded_reason")


@query(f"select {NORMAL} from included")
def rule_included(spark, sf_dir):
    return rules.included(_normal(spark, sf_dir), R).select(*NORMAL.split(", "))


@query("select concat_ws('|', case when excluded_by_cllx then 'CLLX' end, case when excluded_by_rllx then 'RLLX' end, case when excluded_by_fzjg then 'FZJG' end) as excluded_reason, count(*) as n from excluded group by 1")
def rule_reason_counts(spark, sf_dir):
    return rules.excluded(_normal(spark, sf_dir), R).groupBy("excluded_reason").agg(F.count("*").alias("n"))


@query("""select seq, split_part(GCRQ, ' ', 1) as GCRQ, cast(GCSJ as timestamp) as GCSJ, KKBH, CLTMBH, CLLX from (select seq, GCRQ, GCSJ, trim(KKBH) as KKBH, FZJG, CLTMBH, substring(coalesce(CLLX, 'nan'), 1, 2) as CLLX, RLLX from raw
where KKBH is not null and GCSJ <> 'unknown') where CLLX in ('K1','K2','K3','K4','H1','H2','H3','H4') and RLLX in ('A','B') and FZJG in ('粤E','粤X','粤Y') qualify row_number() over (partition by GCRQ, GCSJ, CLTMBH order by seq) = 1""", hourly=True)
def rules_before_dedup(spark, sf_dir):
    raw = views.raw(spark, sf_dir, hourly=True).where("GCSJ <> 'unknown' and KKBH is not null")
    raw = raw.withColumns({"KKBH": E.strip(F.col("KKBH")), "CLLX": E.prefix2(E.as_text(F.col("CLLX")))})
    return rules.valid_records(raw, R).select("seq", "GCRQ", "GCSJ", "KKBH", "CLTMBH", "CLLX")


# mapping


@query("select p.seq, p.KKBH, Longitude, Latitude from passes p join (select distinct KKBH from route) r using (KKBH) left join (select distinct event_type as KKBH, 113.0 + length(event_type) / 100.0 as Longitude, 23.0 as Latitude from events where length(event_type) % 2 = 0) c using (KKBH)")
def route_inner_left_map(spark, sf_dir):
    points = views.view(spark, sf_dir, "select distinct event_type as KKBH, 113.0 + cast(length(event_type) as double) / 100.0 as Longitude, cast(23.0 as double) as Latitude from events where length(event_type) % 2 = 0")
    out = mapping.match_topology(views.passes(spark, sf_dir), views.route(spark, sf_dir), points)
    return out.select("seq", "KKBH", F.col("Longitude").cast("double").alias("Longitude"), "Latitude")


@query("select KKBH, count(*) as count from excluded where KKBH not in (select KKBH from route) group by 1 order by 2 desc, 1 limit 20")
def unmapped_topk(spark, sf_dir):
    return mapping.unmapped_top(rules.excluded(_normal(spark, sf_dir), R), views.route(spark, sf_dir), 20)


@query("select count(*) as unmapped, count(*) filter (ltrim(KKBH, '0') in (select ltrim(KKBH, '0') from route)) as hits from excluded where KKBH not in (select KKBH from route)")
def leading_zero_probe(spark, sf_dir):
    return mapping.leading_zero_hits(rules.excluded(_normal(spark, sf_dir), R), views.route(spark, sf_dir))


@query("select KKBH, node from route where KKBH <> '' and node <> ''")
def node_lookup_map(spark, sf_dir):
    r = views.route(spark, sf_dir)
    old = r.select("KKBH", F.lit("old").alias("node"), F.lit(0).alias("seq"))
    return mapping.node_map(old.unionByName(r.withColumn("seq", F.lit(1))))


# statistics


@query("select h.hour::int as hour, coalesce(car_count, 0) as car_count, coalesce(car_count, 0) / sum(coalesce(car_count, 0)) over () as car_perc, coalesce(truck_count, 0) as truck_count, coalesce(truck_count, 0) / sum(coalesce(truck_count, 0)) over () as truck_perc from generate_series(0, 23) h(hour) left join (select hour(GCSJ) as hour, count(*) filter (kind = 'car') as car_count, count(*) filter (kind = 'truck') as truck_count from kinds group by 1) using (hour)")
def hourly_volume(spark, sf_dir):
    return stats.hourly_volume(views.passes(spark, sf_dir), R)


@query("select CLTMBH, from_KKBH, to_KKBH, KKOD, time, hour from gaps")
def gap_table(spark, sf_dir):
    return stats.gaps(views.passes(spark, sf_dir))


@query(f"""select ordinal::int as ordinal, travel_time_label, coalesce(car_count, 0) as car_count, coalesce(car_count, 0) / sum(coalesce(car_count, 0)) over () as car_perc, coalesce(truck_count, 0) as truck_count, coalesce(truck_count, 0) / sum(coalesce(truck_count, 0)) over () as truck_perc
from (select unnest(generate_series(0, 7)) as ordinal, unnest(['1m','5m','15m','30m','1h','8h','12h','24h']) as travel_time_label) l left join (select {oracle.BINS} as travel_time_label, count(*) filter (kind = 'car') as car_count, count(*) filter (kind = 'truck') as truck_count from class_gaps group by 1) using (travel_time_label)""")
def gap_histogram(spark, sf_dir):
    return stats.gap_histogram(views.passes(spark, sf_dir), R)


@query("select kind, count(*) as n, min(time) as min_time, max(time) as max_time, round(avg(time), 6) as mean_time, median(time) as median_time from class_gaps group by 1")
def gap_summary(spark, sf_dir):
    return stats.gap_summary(views.passes(spark, sf_dir), R).withColumn("mean_time", F.round("mean_time", 6))


@query("select CLTMBH, CLLX, RLLX, {class_labels} as veh_type, {fuel_labels} as fuel_type from passes qualify row_number() over (partition by CLTMBH order by GCSJ, GCRQ, seq) = 1".replace("{class_labels}", "case CLLX when 'K1' then '大型客车' when 'K2' then '中型客车' when 'K3' then '小型客车' when 'K4' then '微型客车' when 'H1' then '重型货车' when 'H2' then '中型货车' when 'H3' then '轻型货车' when 'H4' then '微型货车' end").replace("{fuel_labels}", "case RLLX when 'A' then '汽油' when 'B' then '柴油' end"))
def vehicle_info(spark, sf_dir):
    return stats.vehicle_info(views.passes(spark, sf_dir))


@query("select CLLX, RLLX, count, p from raw_dist", hourly=True)
def joint_distribution(spark, sf_dir):
    return impute.sampling_distribution(views.raw(spark, sf_dir, hourly=True))


@query("select CLLX, sum(count)::bigint as count, sum(count) / (select sum(count) from raw_dist) as p from raw_dist group by 1")
def marginal_distribution(spark, sf_dir):
    m = impute.sampling_distribution(views.raw(spark, sf_dir)).groupBy("CLLX").agg(F.sum("count").alias("count"))
    return m.withColumn("p", F.col("count") / m.agg(F.sum("count")).first()[0])


@query(f"select CLLX, RLLX, count, ratio from {oracle.DIST('included')}")
def pair_distribution(spark, sf_dir):
    return stats.pair_distribution(rules.included(_normal(spark, sf_dir), R))


@query(f"""select coalesce(l.CLLX, r.CLLX) as CLLX, coalesce(l.RLLX, r.RLLX) as RLLX, coalesce(l.count, 0) as excluded_count, coalesce(l.ratio, 0) as excluded_ratio, coalesce(r.count, 0) as vehicle_count, coalesce(r.ratio, 0) as vehicle_ratio,
round((coalesce(l.ratio, 0) - coalesce(r.ratio, 0)) * 100, 9) as delta_pp, round(abs((coalesce(l.ratio, 0) - coalesce(r.ratio, 0)) * 100), 9) as abs_delta_pp from {oracle.DIST('excluded')} l full join {oracle.DIST('pool')} r on l.CLLX = r.CLLX and l.RLLX = r.RLLX""")
def distribution_compare(spark, sf_dir):
    left = stats.pair_distribution(rules.excluded(_normal(spark, sf_dir), R))
    right = stats.pair_distribution(impute.vehicle_pool(views.vehicles(spark, sf_dir), R))
    out = stats.compare_distributions(left, right, "excluded", "vehicle")
    return out.withColumns({c: F.round(c, 9) for c in ("delta_pp", "abs_delta_pp")})


# imputation


def _imputation(spark, sf_dir, r=R):
    excluded = rules.excluded(_normal(spark, sf_dir), r)
    pool = impute.vehicle_pool(views.vehicles(spark, sf_dir), r)
    return excluded, impute.device_attributes(excluded, pool, impute.sampling_distribution(views.raw(spark, sf_dir)), r)


@query("select CLTMBH, CLLX, RLLX from pool")
def vehicle_pool(spark, sf_dir):
    return impute.vehicle_pool(views.vehicles(spark, sf_dir), R).select("CLTMBH", "CLLX", "RLLX")


@query("select CLTMBH, CLLX, RLLX from drawn")
def device_sampling_joint(spark, sf_dir):
    return _imputation(spark, sf_dir)[1].where("assigned_by_sampling").select("CLTMBH", "CLLX", "RLLX")


MARGIN = "select {c}, (upto - count) / total as lo, case when last = 1 then 2.0 else upto / total end as hi from (select {c}, count, sum(count) over (order by count desc, {c} rows unbounded preceding) as upto, sum(count) over () as total, row_number() over (order by count, {c} desc) as last from (select {c}, sum(count) as count from raw_dist group by 1))"


@query(f"select CLTMBH, a.CLLX, b.RLLX from u join ({MARGIN.replace('{c}', 'CLLX')}) a on u >= a.lo and u < a.hi join ({MARGIN.replace('{c}', 'RLLX')}) b on u2 >= b.lo and u2 < b.hi")
def device_sampling_independent(spark, sf_dir):
    devices = rules.excluded(_normal(spark, sf_dir), R).select("CLTMBH")
    return impute.sample_devices(devices, impute.sampling_distribution(views.raw(spark, sf_dir)), replace(R, sampling_mode="independent"))


@query("select CLTMBH, CLLX, RLLX, is_in_vehicle_table, assigned_by_sampling, veh_type, fuel_type, CLTMBH as device_id from labels")
def device_attributes(spark, sf_dir):
    return _imputation(spark, sf_dir)[1]


@query("select e.seq, e.GCRQ, e.GCSJ, e.KKBH, e.FZJG, e.CLTMBH, e.CLLX as CLLX_raw, e.RLLX as RLLX_raw, a.CLLX, a.RLLX, a.veh_type, a.fuel_type, a.is_in_vehicle_table, a.assigned_by_sampling, e.CLTMBH as device_id from excluded e left join labels a using (CLTMBH)")
def impute_rebuild(spark, sf_dir):
    columns = "seq GCRQ GCSJ KKBH FZJG CLTMBH CLLX_raw RLLX_raw CLLX RLLX veh_type fuel_type is_in_vehicle_table assigned_by_sampling device_id".split()
    return impute.rebuild(*_imputation(spark, sf_dir)).select(*columns)


# diagnostics


def _final(spark, sf_dir):
    normal = _normal(spark, sf_dir)
    mapped = mapping.on_route(rules.included(normal, R), views.route(spark, sf_dir))
    return diagnostics.final_records(mapped, impute.rebuild(*_imputation(spark, sf_dir)))


@query("""select 'record' as level, count(*) filter (FZJG in ('粤E','粤X','粤Y')) as local_count, count(*) as total_count, count(*) filter (FZJG in ('粤E','粤X','粤Y')) / count(*) as ratio from final union all
select 'device', count(*) filter (FZJG in ('粤E','粤X','粤Y')), count(*), count(*) filter (FZJG in ('粤E','粤X','粤Y')) / count(*) from (select * from final qualify row_number() over (partition by CLTMBH order by source, seq) = 1)""")
def local_plate_share(spark, sf_dir):
    return diagnostics.local_share(_final(spark, sf_dir), R)


@query("select count(*) filter (assigned_by_sampling) as sampled_devices, count(*) as devices, count(*) filter (assigned_by_sampling) / count(*) as ratio from attributes")
def sampled_device_share(spark, sf_dir):
    return diagnostics.sampled_share(_imputation(spark, sf_dir)[1])


@query(f", {GROUPS}, one as ({PROFILE}) select metric, value::double as value from (unpivot one on columns(*) into name metric value value)", hourly=True)
def summary_unpivot(spark, sf_dir):
    return diagnostics.unpivot(clean.profile(views.raw(spark, sf_dir, hourly=True)))


# thresholds


@query('select B as "B" from fixed')
def fixed_threshold(spark, sf_dir):
    return thresholds.fixed_threshold(stats.gaps(views.passes(spark, sf_dir)), S)


@query("select from_KKBH, to_KKBH, n, round(std, 6) as std, n_high, n_flat, n_low, min, median, max, n < 50 or std < 100 or least(n_high, n_flat, n_low) = 0 as one_row from pairs")
def pair_classification(spark, sf_dir):
    return thresholds.classify(stats.gaps(views.passes(spark, sf_dir)), S).withColumn("std", F.round("std", 6))


@query("select kkod, period, min, median, max from rows_all")
def pair_threshold_all(spark, sf_dir):
    return thresholds.thresholds(stats.gaps(views.passes(spark, sf_dir)), PLAIN).select("kkod", "period", "min", "median", "max")


@query()
def iforest_thresholds(spark, sf_dir):
    return thresholds.thresholds(stats.gaps(views.passes(spark, sf_dir)), S).select("kkod", "period", "min", "median", "max")


def _points(spark, sf_dir, s):
    passes = views.passes(spark, sf_dir)
    gaps = sinks.checkpointed(stats.gaps(passes).drop("CLTMBH", "KKOD"))  # read by three plans
    r = views.view(spark, sf_dir, "select distinct event_type as KKBH, 'N-' || event_type as node from events where event_type <> (select max(event_type) from events)")
    return trips.points(passes, r), thresholds.thresholds(gaps, s), thresholds.fixed_threshold(gaps, s)


@query("select CLTMBH, z::bigint as z, prev, KKBH, least, most from bounded where z > 0")
def bounds_resolution(spark, sf_dir):
    out = trips.with_bounds(*_points(spark, sf_dir, PLAIN), PLAIN).where("z > 0")
    return out.select("CLTMBH", F.col("z").cast("long").alias("z"), "prev", "KKBH", "least", "most")


def _flat(found):
    return found.select("CLTMBH", "trip", F.array_join("checkpoint", ">").alias("checkpoints"), F.array_join("pos", ">").alias("nodes"), "start", "stop", "travel", "n_points")


@query(oracle.ISLANDS)
def trips_islands(spark, sf_dir):
    pts, rows, b = _points(spark, sf_dir, PLAIN)
    return _flat(trips.trips_islands(pts, PLAIN, rows, b))


@query(oracle.LEGACY, recursive=True)
def trips_legacy(spark, sf_dir):
    return _flat(trips.trips(trips.with_bounds(*_points(spark, sf_dir, PLAIN), PLAIN), PLAIN))


@query()
def trips_adaptive(spark, sf_dir):
    return _flat(trips.trips(trips.with_bounds(*_points(spark, sf_dir, S), S), S))


@query(f"select count(*) as trips, avg(n_points) as mean_points, median(n_points) as median_points, min(n_points) as min_points, max(n_points) as max_points from ({oracle.ISLANDS})")
def trip_length_stats(spark, sf_dir):
    pts, rows, b = _points(spark, sf_dir, PLAIN)
    return trips.length_stats(trips.trips_islands(pts, PLAIN, rows, b))


# road graph


def _graph(spark, sf_dir, exact=False):
    pts = topology.points(views.roads(spark, sf_dir))
    return pts, topology.nodes(pts), topology.edges(pts, T, exact)


def _named_edges(spark, sf_dir, exact):
    with sinks.held(views.roads(spark, sf_dir)) as roads:  # read by nodes and edges, both of which the table stores
        pts = topology.points(roads)
        return topology.edge_table(topology.edges(pts, T, exact), topology.nodes(pts))


@query("select seq, road_id, oneway, fclass, maxspeed, pt::int as pt, lon, lat, to_lon, to_lat from segments")
def road_segments(spark, sf_dir):
    return topology.segments(topology.points(views.roads(spark, sf_dir))).select("seq", "road_id", "oneway", "fclass", "maxspeed", "pt", "lon", "lat", "to_lon", "to_lat")


@query("select lon, lat, name, visits from nodes")
def node_naming(spark, sf_dir):
    return _graph(spark, sf_dir)[1]


@query("select name, count(*) as coordinates from nodes group by 1 having count(*) > 1")
def name_collisions(spark, sf_dir):
    return topology.name_collisions(_graph(spark, sf_dir)[1])


@query("select a.name as start_node, b.name as end_node, kind, round(duration, 6) as duration, round(length, 6) as road_length, case kind when 1 then '高速公路' when 2 then '城市快速路' when 3 then '主干道' when 6 then '一般道路' when 7 then '生活街区道路' else '未知' end as road_type from edges join nodes a on a.lon = start_lon and a.lat = start_lat join nodes b on b.lon = end_lon and b.lat = end_lat")
def edge_table(spark, sf_dir):
    return _named_edges(spark, sf_dir, exact=False).withColumns({c: F.round(c, 6) for c in ("duration", "road_length")})


@query("select (select count(*) from nodes) as nodes, count(*) as edges, round(sum(length) / 1000, 6) as total_km from edges")
def edge_totals(spark, sf_dir):
    _, nodes, edges = _graph(spark, sf_dir)
    return topology.totals(edges, nodes).withColumn("total_km", F.round("total_km", 6))


@query()
def edge_table_geodesic(spark, sf_dir):
    return _named_edges(spark, sf_dir, exact=True)


@query("select distinct road_id, oneway, maxspeed from pts")
def maxspeed_parse(spark, sf_dir):
    return topology.points(views.roads(spark, sf_dir)).select("road_id", "oneway", "maxspeed").distinct()


@query("select seq, pt::int as pt, kind, round(duration, 6) as duration from timed")
def duration_estimate(spark, sf_dir):
    s = topology.segments(topology.points(views.roads(spark, sf_dir)))
    s = s.withColumn("length", haversine_m(F.col("lon"), F.col("lat"), F.col("to_lon"), F.col("to_lat")))
    return s.select("seq", "pt", E.road_kind(F.col("fclass")).alias("kind"), F.round(E.duration(F.col("length"), F.col("fclass"), F.col("maxspeed"), T), 6).alias("duration"))


@query("select c_custkey::bigint as seq, pt::int as pt, (case pt when 0 then c_custkey % 100 else c_custkey % 7 + 0.5 end)::double as lon, (c_nationkey + pt)::double as lat from customer, (values (0), (1)) v(pt)")
def line_parts(spark, sf_dir):
    """Of lines of several parts the second counts; points are numbered along the line."""
    text = "concat_ws(' ', c_custkey % 100, c_nationkey), ', ', concat_ws(' ', concat(c_custkey % 7, '.5'), c_nationkey + 1)"
    wkt = views.view(spark, sf_dir, f"select cast(c_custkey as bigint) as seq, if(c_custkey % 2 = 0, concat('MULTILINESTRING ((9 9, 8 8), (', {text}, '))'), concat('LINESTRING (', {text}, ')')) as wkt from customer")
    point = F.posexplode(F.col("line"))
    return tables.lines_from_wkt(wkt).select("seq", point.alias("pt", "p")).select("seq", "pt", F.col("p.lon").alias("lon"), F.col("p.lat").alias("lat"))


# matching

NEAR = """near as materialized (select seq, KKBH, name as node, lon, lat, 2 * 6371008.8 * asin(sqrt(pow(sin(radians(Latitude - lat) / 2), 2) + cos(radians(lat)) * cos(radians(Latitude)) * pow(sin(radians(Longitude - lon) / 2), 2))) as dist
from positions join nodes on abs(lon - Longitude) <= 9.769874e-06 * 60 and abs(lat - Latitude) <= 8.993216e-06 * 60)"""


def _candidates(spark, sf_dir):
    return match.candidates(views.positions(spark, sf_dir), _graph(spark, sf_dir)[1], T, haversine_m)


@query(f", {NEAR} select KKBH, node, round(dist, 6) as dist from near where dist <= 60")
def bbox_candidates(spark, sf_dir):
    return _candidates(spark, sf_dir).select("KKBH", "node", F.round("dist", 6).alias("dist"))


# DuckDB follows serial choice by recursion: one level for each checkpoint, carrying the list of nodes taken
SERIAL = f""", {NEAR}, turns as materialized (select seq, KKBH, list(struct_pack(node := node, dist := dist) order by dist, lon, lat) as options, row_number() over (order by seq) as turn from near where dist <= 60 group by 1, 2),
chosen as (select 0::bigint as turn, 0::bigint as seq, ''::varchar as KKBH, null::struct(node varchar, dist double) as pick, []::varchar[] as taken
union all select turn, seq, KKBH, pick, case when pick is null then taken else list_append(taken, pick.node) end from (
  select t.turn, t.seq, t.KKBH, list_filter(t.options, lambda o: not list_contains(c.taken, o.node))[1] as pick, c.taken from chosen c join turns t on t.turn = c.turn + 1))
select seq, KKBH, pick.node as node, round_even(pick.dist, 2)::double as dist_m from chosen where pick is not null"""


@query(SERIAL, recursive=True)
def nearest_match(spark, sf_dir):
    return match.one_to_one(_candidates(spark, sf_dir))


@query()
def nearest_match_geodesic(spark, sf_dir):
    return match.one_to_one(match.candidates(views.positions(spark, sf_dir), _graph(spark, sf_dir)[1], T))


@query(f"{SERIAL.replace('select seq, KKBH, pick.node as node, round_even(pick.dist, 2)::double as dist_m from chosen where pick is not null', '')}, sums as (select (select count(*) from positions) as checkpoints, (select count(*) from nodes) as nodes, (select count(*) from chosen where pick is not null) as matched) select *, nodes - matched as virtual_nodes, matched / checkpoints as match_rate, matched / nodes as real_node_ratio, (nodes - matched) / nodes as virtual_node_ratio from sums", recursive=True)
def match_summary(spark, sf_dir):
    nodes = _graph(spark, sf_dir)[1]
    return match.summary(views.positions(spark, sf_dir), nodes, match.one_to_one(_candidates(spark, sf_dir)))


# scalar probes


@query("select event_id, lower(trim(v)) in ('1', 'true', 't', 'yes', 'y') as truth, coalesce(try_cast(v as bigint), 0) as number from (select event_id, case event_id % 7 when 0 then ' True ' when 1 then 'no' when 2 then '1' when 3 then 'Y' when 4 then '17' when 5 then '' else 'x' end as v from events)")
def text_parse(spark, sf_dir):
    v = views.view(spark, sf_dir, "select event_id, case event_id % 7 when 0 then ' True ' when 1 then 'no' when 2 then '1' when 3 then 'Y' when 4 then '17' when 5 then '' else 'x' end as v from events")
    return v.select("event_id", E.truth(F.col("v")).alias("truth"), E.whole_number(F.col("v")).alias("number"))
