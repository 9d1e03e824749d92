"""DuckDB SQL of the registered queries, built from common parts."""

from __future__ import annotations

from tollway.plans import views

VALID = "CLLX in ('K1','K2','K3','K4','H1','H2','H3','H4')"
FUEL = "RLLX in ('A','B')"
LOCAL = "FZJG in ('粤E','粤X','粤Y')"
STRIP = lambda c: f"trim({c}, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
TXT = lambda c: f"coalesce({c}, 'nan')"


def parts(hourly: bool = False) -> str:
    """CTEs of the views and of the steps that queries share."""
    return f"""
raw as ({views.raw_sql(hourly)}),
passes as ({views.passes_sql("duckdb")}),
vehicles as ({views.VEHICLES}),
route as ({views.ROUTE}),
positions as ({views.POSITIONS}),
road_points as ({views.ROADS}),
typed as (select seq, split_part({TXT("GCRQ")}, ' ', 1) as GCRQ, try_cast(GCSJ as timestamp) as GCSJ, {STRIP(TXT("KKBH"))} as KKBH, {STRIP(TXT("FZJG"))} as FZJG,
  {STRIP(TXT("CLTMBH"))} as CLTMBH, substring({STRIP(TXT("CLLX"))}, 1, 2) as CLLX, {STRIP(TXT("RLLX"))} as RLLX from raw where try_cast(GCSJ as timestamp) is not null),
normal as (select * from typed qualify row_number() over (partition by GCRQ, GCSJ, CLTMBH order by seq) = 1),
included as (select * from normal where {VALID} and {FUEL} and {LOCAL}),
excluded as (select *, not {VALID} as excluded_by_cllx, not {FUEL} as excluded_by_rllx, not {LOCAL} as excluded_by_fzjg from normal where not ({VALID} and {FUEL} and {LOCAL})),
center_ids as (select distinct event_type as KKBH from events where event_type <> (select max(event_type) from events)),
kinds as (select *, case when CLLX in ('K1','K2','K3','K4') then 'car' when CLLX in ('H1','H2','H3','H4') then 'truck' end as kind from passes),
class_gaps as (select kind, date_diff('microsecond', GCSJ, next_t) / 1e6 as time from (select *, lead(GCSJ) over w as next_t, lead(GCRQ) over w as next_d from kinds where kind is not null
  window w as (partition by kind, CLTMBH order by GCRQ, GCSJ, seq)) where GCRQ = next_d and date_diff('microsecond', GCSJ, next_t) >= 0),
gaps as (select CLTMBH, KKBH as from_KKBH, next_k as to_KKBH, KKBH || '-' || next_k as KKOD, date_diff('microsecond', GCSJ, next_t) / 1e6 as time, hour(GCSJ)::int as hour
  from (select *, lead(GCSJ) over w as next_t, lead(GCRQ) over w as next_d, lead(KKBH) over w as next_k from passes window w as (partition by CLTMBH order by GCRQ, GCSJ, seq))
  where GCRQ = next_d and date_diff('microsecond', GCSJ, next_t) >= 0),
fixed as (select quantile_cont(time, 0.7) as B from gaps),
pairs as (select from_KKBH, to_KKBH, count(*) as n, stddev_samp(time) as std, count(*) filter (hour in (7,8,17,18)) as n_high, count(*) filter (hour in (9,10,11,12,13,14,15,16,19,20,21)) as n_flat,
  count(*) filter (hour not in (7,8,17,18,9,10,11,12,13,14,15,16,19,20,21)) as n_low, min(time) as min, median(time) as median, max(time) as max from gaps group by all),
rows_all as (select from_KKBH, to_KKBH, from_KKBH || '-' || to_KKBH as kkod, 'all' as period, min, median, max from pairs),
pool as (select CLTMBH, CLLX, case fuel_type when '汽油' then 'A' when '柴油' then 'B' end as RLLX from vehicles where {VALID} qualify row_number() over (partition by CLTMBH order by seq) = 1),
raw_dist as (select CLLX, RLLX, count(*) as count, count(*) / sum(count(*)) over () as p from (
  select split_part(GCRQ, ' ', 1) as d, try_cast(GCSJ as timestamp) as t, {STRIP("CLTMBH")} as v, substring({STRIP("CLLX")}, 1, 2) as CLLX, {STRIP("RLLX")} as RLLX, seq
  from raw where CLLX is not null and RLLX is not null and GCRQ is not null and GCSJ is not null and CLTMBH is not null and try_cast(GCSJ as timestamp) is not null
  qualify row_number() over (partition by d, t, v order by seq) = 1) group by all),
devices as (select distinct CLTMBH from excluded),
u as (select CLTMBH, ('0x' || substr(md5('20260224:' || CLTMBH), 1, 8))::bigint / 4294967296.0::double as u, ('0x' || substr(md5('20260225:' || CLTMBH), 1, 8))::bigint / 4294967296.0::double as u2 from devices),
cdf as (select *, (upto - count) / total as lo, case when last = 1 then 2.0 else upto / total end as hi from (select *, sum(count) over (order by count desc, CLLX, RLLX rows unbounded preceding) as upto,
  sum(count) over () as total, row_number() over (order by count, CLLX desc, RLLX desc) as last from raw_dist)),
drawn as (select u.CLTMBH, CLLX, RLLX from u join cdf on u.u >= lo and u.u < hi where u.CLTMBH not in (select CLTMBH from pool)),
attributes as (select d.CLTMBH, coalesce(p.CLLX, s.CLLX) as CLLX, coalesce(p.RLLX, s.RLLX) as RLLX, p.CLLX is not null as is_in_vehicle_table, p.CLLX is null as assigned_by_sampling
  from devices d left join pool p using (CLTMBH) left join drawn s using (CLTMBH)),
labels as (select *, {{class_labels}} as veh_type, {{fuel_labels}} as fuel_type from attributes),
supplement as (select e.seq, e.GCRQ, e.GCSJ, e.KKBH, e.FZJG, e.CLTMBH, a.CLLX, a.RLLX from excluded e left join attributes a using (CLTMBH)),
included_mapped as (select * from included where KKBH in (select KKBH from route)),
final as (select CLTMBH, FZJG, 0 as source, seq from included_mapped union all select CLTMBH, FZJG, 1, seq from supplement),
pts as (select * from (select seq, osm_id as road_id, case when upper(trim(oneway)) in ('F','T','B') then upper(trim(oneway)) else 'B' end as oneway, fclass,
  case when try_cast(trim(lower(maxspeed)) as double) is not null then greatest(try_cast(trim(lower(maxspeed)) as double), 0) else
    coalesce(try_cast(nullif(regexp_extract(regexp_split_to_array(trim(lower(maxspeed)), '[;,/|]')[1], '\\d+(\\.\\d+)?', 0), '') as double), 0) end as maxspeed,
  row_number() over (partition by seq order by pt) - 1 as pt, count(*) over (partition by seq) as n_pts, lon, lat
  from (select * from road_points qualify row_number() over (partition by seq, lon, lat order by pt) = 1)) where n_pts >= 2),
segments as (select * from (select *, lead(lon) over w as to_lon, lead(lat) over w as to_lat from pts window w as (partition by seq order by pt)) where to_lon is not null),
nodes as (select lon, lat, case when count(*) = 1 then case when min(pt) = 0 then 'O' when min(pt) = min(n_pts) - 1 then 'D' else min(pt)::varchar end || '-' || min(road_id)
  else 'LINK-' || string_agg(road_id, '-' order by seq, pt) end as name, count(*)::int as visits from pts group by lon, lat),
measured as (select *, 2 * 6371008.8 * asin(sqrt(pow(sin(radians(to_lat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(to_lat)) * pow(sin(radians(to_lon - lon) / 2), 2))) as length from segments),
timed as (select *, case when fclass in ('motorway','motorway_link') then 1 when fclass in ('trunk','trunk_link') then 2 when fclass = 'primary' then 3 when fclass = 'residential' then 6 when fclass = 'living_street' then 7 else 0 end as kind,
  length / (greatest(case when maxspeed > 0 then maxspeed * 0.9 when fclass in ('motorway','motorway_link') then 100.0 when fclass in ('trunk','trunk_link') then 80.0 else 35.73 end, 1e-6) / 3.6) as duration from measured),
ways as (select seq, pt, 0 as way, lon as start_lon, lat as start_lat, to_lon as end_lon, to_lat as end_lat, length, kind, duration from timed where oneway <> 'T'
  union all select seq, pt, 1, to_lon, to_lat, lon, lat, length, kind, duration from timed where oneway <> 'F'),
edges as (select start_lon, start_lat, end_lon, end_lat, length, kind, duration from ways qualify row_number() over (partition by start_lon, start_lat, end_lon, end_lat order by seq desc, pt desc, way desc) = 1),
mapped as (select p.*, 'N-' || p.KKBH as pos from passes p where p.KKBH in (select event_type from events where event_type <> (select max(event_type) from events))
  and p.CLTMBH in (select CLTMBH from passes group by 1 having count(*) > 1)),
zs as (select *, row_number() over w - 1 as z, count(*) over (partition by CLTMBH) as n, lag(KKBH) over w as prev, lag(GCSJ) over w as prev_time from mapped window w as (partition by CLTMBH order by GCSJ, seq)),
bounded as (select zs.*, B, case when r.min is null or (r.min >= B and r.max - r.min < 60) then 1.0 else trunc(r.min) end as least,
  least(case when r.min is null or (r.min >= B and r.max - r.min < 60) then round_even(1.5 * B, 0)::double else round_even(r.max, 0)::double end, round_even(1.5 * B, 0)::double) as most
  from zs cross join fixed left join rows_all r on r.from_KKBH = zs.prev and r.to_KKBH = zs.KKBH)"""


def query(select: str, hourly: bool = False, recursive: bool = False) -> str:
    from tollway.config import CLASS_LABELS, FUEL_LABELS

    case = lambda c, t: "case " + c + "".join(f" when '{k}' then '{v}'" for k, v in t.items()) + " end"
    text = parts(hourly).replace("{class_labels}", case("CLLX", CLASS_LABELS)).replace("{fuel_labels}", case("RLLX", FUEL_LABELS))
    return f"with {'recursive ' if recursive else ''}{text}\n{select}"


BINS = "case when time > 0 and time <= 60 then '1m' when time > 60 and time <= 300 then '5m' when time > 300 and time <= 900 then '15m' when time > 900 and time <= 1800 then '30m' when time > 1800 and time <= 3600 then '1h' when time > 3600 and time <= 28800 then '8h' when time > 28800 and time <= 43200 then '12h' when time > 43200 and time <= 86400 then '24h' end"
DIST = lambda table: f"(select substring({STRIP('CLLX')}, 1, 2) as CLLX, {STRIP('RLLX')} as RLLX, count(*) as count, count(*) / sum(count(*)) over () as ratio from {table} where {STRIP('CLLX')} <> '' and {STRIP('RLLX')} <> '' and lower(substring({STRIP('CLLX')}, 1, 2)) <> 'nan' and lower({STRIP('RLLX')}) <> 'nan' group by 1, 2)"
TRIP_COLUMNS = "CLTMBH, trip, string_agg(KKBH, '>' order by z) as checkpoints, string_agg(pos, '>' order by z) as nodes, min(GCSJ) as start, max(GCSJ) as stop, date_diff('microsecond', min(GCSJ), max(GCSJ)) / 1e6 as travel, count(*)::int as n_points"
ISLANDS = f"""select * exclude (closed) from (select {TRIP_COLUMNS}, bool_and(closed) as closed from (select *, trip < max(trip) over (partition by CLTMBH) as closed from (
  select *, sum(case when ok then 0 else 1 end) over (partition by CLTMBH order by z)::bigint as trip from (select z.*, coalesce(z.z >= 2 and z.KKBH <> z.prev and date_diff('microsecond', z.prev_time, z.GCSJ) / 1e6
  between coalesce(r.min, 1.0) and least(coalesce(r.max, round_even(1.5 * B, 0)::double), round_even(1.5 * B, 0)::double), false) as ok
  from zs z cross join fixed left join rows_all r on r.from_KKBH = z.prev and r.to_KKBH = z.KKBH where z.z > 0)))
  group by CLTMBH, trip) where closed and n_points > 1 and travel > 300"""
LEGACY = f""", bounded2 as materialized (select CLTMBH, z, n, KKBH, pos, GCSJ, prev, prev_time, least, most, B from bounded),
walk as (
  select CLTMBH, z, n, 0::bigint as trip, null::timestamp as last, false as kept, false as closed, false as first_too, KKBH, pos, GCSJ from bounded2 where z = 0
  union all
  select b.CLTMBH, b.z, b.n,
    case when b.KKBH <> b.prev and ti <> 0 and ti between least and most then trip when (b.KKBH <> b.prev and ti > most) or (b.KKBH = b.prev and ti > B) then trip + 1 else trip end,
    case when (b.KKBH <> b.prev and ti <> 0 and ti between least and most) or (b.KKBH <> b.prev and ti > most) or (b.KKBH = b.prev and ti > B) then b.GCSJ else last end,
    (b.KKBH <> b.prev and ti <> 0 and ti between least and most) or (b.KKBH <> b.prev and ti > most) or (b.KKBH = b.prev and ti > B),
    b.KKBH <> b.prev and ti <> 0 and ti between least and most and b.z = b.n - 1 and b.z <> 1,
    b.KKBH <> b.prev and ti <> 0 and ti between least and most and b.z = 1, b.KKBH, b.pos, b.GCSJ
  from (select w.trip, w.last, b.*, date_diff('microsecond', coalesce(w.last, b.prev_time), b.GCSJ) / 1e6 as ti from walk w join bounded2 b on b.CLTMBH = w.CLTMBH and b.z = w.z + 1) b),
kept as (select CLTMBH, z, trip, KKBH, pos, GCSJ, closed from walk where kept union all select b.CLTMBH, 0, 0, b.KKBH, b.pos, b.GCSJ, false from walk w join bounded2 b on b.CLTMBH = w.CLTMBH and b.z = 0 where w.first_too)
select * exclude (closed) from (select {TRIP_COLUMNS}, bool_or(closed or trip < resets) as closed from (select *, max(trip) over (partition by CLTMBH) as resets from kept) group by CLTMBH, trip)
where closed and n_points > 1 and travel > 300"""
