"""Cleaning, rules, mapping and statistics on literal rows."""

import datetime as dt
import random
from dataclasses import replace

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tollway.config import Rules
from tollway.functions import exprs as E
from tollway.operators import clean, impute, mapping, rules, stats

R = Rules()
RAW = "GCRQ string, GCSJ string, KKBH string, FZJG string, CLTMBH string, CLLX string, RLLX string, seq long"


def raw(spark, rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], RAW)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_missing_columns(spark):
    with pytest.raises(ValueError, match="RLLX"):
        clean.normalize_for_split(spark.createDataFrame([], RAW).drop("RLLX"))


def test_null_codes_read_nan(spark):
    df = raw(spark, [("2022-06-18 0:00", "2022-06-18 07:00:00", " 007 ", "粤E", "v1", None, None)])
    row = clean.normalize_for_split(df).first()
    assert (row.CLLX, row.RLLX, row.KKBH, row.GCRQ) == ("na", "nan", "007", "2022-06-18")
    out = rules.excluded(clean.normalize_for_split(df), R).first()
    assert out.excluded_reason == "CLLX|RLLX" and out.excluded_by_cllx and not out.excluded_by_fzjg


def test_reason_names_all_rules(spark):
    df = raw(spark, [("d", "2022-06-18 07:00:00", "k", "京A", "v1", "X1", "Z"), ("d", "2022-06-18 07:00:01", "k", "粤E", "v1", "K1", "Z")])
    out = rules.excluded(clean.normalize_for_split(df), R).orderBy("seq").collect()
    assert [r.excluded_reason for r in out] == ["CLLX|RLLX|FZJG", "RLLX"]


def test_bad_times_go_and_first_stays(spark):
    df = raw(spark, [("d", "2022-06-18 07:00:00", "a", "粤E", "v", "K11", "A"), ("d", "2022-06-18 07:00:00", "b", "粤E", "v", "K1", "A"), ("d", "never", "c", "粤E", "v", "K1", "A")])
    out = clean.normalize_for_split(df).collect()
    assert [(r.KKBH, r.CLLX, r.seq) for r in out] == [("a", "K1", 0)]
    group = clean.conflict_groups(clean.typed(df)).first()
    assert group.group_size == 2 and group.KKBH_nunique == 2 and group.has_conflict
    p = clean.profile(df).first()
    assert (p.before_dropna, p.dropna_removed, p.dedup_removed, p.conflict_row_count) == (3, 1, 1, 2)


def test_slash_dates_by_format(spark):
    c = E.parse_time(F.lit("2022/6/18 7:00:01"), ("y/M/d H:m:s",))
    assert one(spark, c) == dt.datetime(2022, 6, 18, 7, 0, 1)
    assert one(spark, E.parse_time(F.lit("2022/6/x"))) is None


@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2)), min_size=1, max_size=20), st.integers(1, 5))
@settings(max_examples=8, deadline=None)
def test_keep_first_ignores_partitioning(spark, rows, n):
    want, data = {}, [(k, v, i) for i, (k, v) in enumerate(rows)]
    for k, v, i in data:
        want.setdefault(k, (v, i))
    random.Random(n).shuffle(data)
    got = clean.keep_first(spark.createDataFrame(data, "k int, v int, seq long").repartition(n), ["k"]).collect()
    assert {r.k: (r.v, r.seq) for r in got} == want


def test_gap_bins(spark):
    edges = [one(spark, E.bins(F.lit(x), R.travel_time_bins, R.travel_time_labels)) for x in (0, 60, 61, 300, 86400, 86401)]
    assert edges == [None, "1m", "5m", "5m", "24h", None]


def test_maxspeed_and_oneway(spark):
    values = [None, "60", "-5", "60 km/h", "60;80", "none"]
    assert [one(spark, E.maxspeed(F.lit(v).cast("string"))) for v in values] == [0, 60, 0, 60, 60, 0]
    assert [one(spark, E.oneway(F.lit(v).cast("string"))) for v in ("f", " T ", None, "X")] == ["F", "T", "B", "B"]


def test_small_expressions(spark):
    assert one(spark, E.strip(F.lit("\t a b \n"))) == "a b"
    assert one(spark, E.no_leading_zeros(F.lit("0070"))) == "70"
    assert one(spark, E.ratio(F.lit(1), F.lit(0))) == 0
    assert one(spark, E.percent(F.lit(0.1234))) == "12.34%"
    assert one(spark, E.truth(F.lit(" Yes "))) and not one(spark, E.truth(F.lit(None).cast("string")))
    assert 0 <= one(spark, E.bucket(F.lit("x"), 7)) < 7


def test_mapping(spark):
    passes = spark.createDataFrame([("1", 0), ("01", 1), ("2", 2)], "KKBH string, seq long")
    route = spark.createDataFrame([("1", "n1"), ("1", "n2"), (" ", "n3"), ("2", "")], "KKBH string, node string")
    assert {(r.KKBH, r.node) for r in mapping.node_map(route.coalesce(1)).collect()} == {("1", "n2")}
    assert mapping.on_route(passes, route).count() == 2
    probe = mapping.leading_zero_hits(passes, route).first()
    assert (probe.unmapped, probe.hits) == (1, 1)
    points = spark.createDataFrame([("1", 1.0, 2.0)], "KKBH string, Longitude double, Latitude double")
    assert mapping.match_topology(passes, route, points).count() == 3  # a checkpoint that is listed twice counts twice
    with pytest.raises(ValueError, match="node"):
        mapping.node_map(route.drop("node"))


def test_hours_without_records(spark):
    df = spark.createDataFrame([(dt.datetime(2022, 1, 1, 7), "K1")], "GCSJ timestamp_ntz, CLLX string")
    out = {r.hour: r for r in stats.hourly_volume(df, R).collect()}
    assert len(out) == 24 and out[7].car_perc == 1 and out[8].car_count == 0 and out[7].truck_perc == 0


def test_sampling(spark):
    dist = spark.createDataFrame([("K1", "A", 75, 0.75), ("H1", "B", 25, 0.25)], "CLLX string, RLLX string, count long, p double")
    devices = spark.range(4000).select(F.concat(F.lit("v"), "id").alias("CLTMBH"))
    got = impute.sample_devices(devices.repartition(3), dist, R)
    rows = {r.CLTMBH: (r.CLLX, r.RLLX) for r in got.collect()}
    assert rows == {r.CLTMBH: (r.CLLX, r.RLLX) for r in impute.sample_devices(devices.repartition(7), dist, R).collect()}
    assert len(rows) == 4000 and set(rows.values()) == {("K1", "A"), ("H1", "B")}
    share = sum(v[0] == "K1" for v in rows.values()) / 4000
    assert abs(share - 0.75) < 3 * (0.75 * 0.25 / 4000) ** 0.5
    free = {(r.CLLX, r.RLLX) for r in impute.sample_devices(devices, dist, replace(R, sampling_mode="independent")).collect()}
    assert ("K1", "B") in free
    with pytest.raises(ValueError, match="joint"):
        impute.sample_devices(devices, dist, replace(R, sampling_mode="x"))


def test_labels_and_bins_must_fit():
    with pytest.raises(ValueError):
        Rules(travel_time_labels=("1m",))
