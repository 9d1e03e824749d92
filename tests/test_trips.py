"""Thresholds and trips: literal cases, and a plain automaton as the judge."""

import datetime as dt

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tollway.config import Segmentation
from tollway.functions.forest import inliers, weighted_median
from tollway.operators import stats, thresholds, trips
from tollway.streaming.passes import step

S = Segmentation()
T0 = dt.datetime(2022, 6, 18, 7)


def passes(spark, rows):
    """rows: (vehicle, checkpoint, seconds)."""
    data = [(v, k, T0 + dt.timedelta(seconds=s), str((T0 + dt.timedelta(seconds=s)).date()), i) for i, (v, k, s) in enumerate(rows)]
    return spark.createDataFrame(data, "CLTMBH string, KKBH string, GCSJ timestamp_ntz, GCRQ string, seq long")


def segmented(spark, rows, limits, b=600.0):
    """limits: (from, to) -> (min, max), as rows `all`."""
    p = passes(spark, rows)
    nodes = spark.createDataFrame([(k, "n" + k) for k in "ABCD"], "KKBH string, node string")
    table = spark.createDataFrame([(a, c, f"{a}-{c}", "all", float(lo), 0.0, float(hi)) for (a, c), (lo, hi) in limits.items()] or [("-", "-", "-", "all", 0.0, 0.0, 0.0)], thresholds.ROWS)
    fixed = spark.createDataFrame([(b,)], "B double")
    found = trips.trips(trips.with_bounds(trips.points(p, nodes), table, fixed, S), S)
    return {(r.CLTMBH, tuple(r.checkpoint), r.travel) for r in found.collect()}


def plain(rows, limits, b=600.0):
    """The rule, one pass after the other."""
    cap, out = float(round(1.5 * b)), set()
    for v in {r[0] for r in rows}:
        pts = sorted(((s, i, k) for i, (w, k, s) in enumerate(rows) if w == v))
        kept, n = [], len(pts)

        def flush():
            if len(kept) > 1 and kept[-1][0] - kept[0][0] > 300:
                out.add((v, tuple(k for _, k in kept), float(kept[-1][0] - kept[0][0])))

        for z in range(1, n):
            (t0, _, k0), (t1, _, k1) = pts[z - 1], pts[z]
            lo, hi = limits.get((k0, k1), (1, cap))
            lo, hi = (1, cap) if (k0, k1) in limits and lo >= b and hi - lo < 60 else (lo, min(hi, cap))
            ti = t1 - (kept[-1][0] if kept else t0)
            if k0 != k1 and lo <= ti <= hi and ti != 0:
                if z == 1:
                    kept += [(t0, k0), (t1, k1)]
                else:
                    kept.append((t1, k1))
                    if z == n - 1:
                        flush()
            elif ti > (hi if k0 != k1 else b):
                flush()
                kept = [(t1, k1)]
    return out


def test_two_points_never_make_a_trip(spark):
    assert segmented(spark, [("v", "A", 0), ("v", "B", 600)], {}) == set()


def test_last_point_in_range_closes(spark):
    assert segmented(spark, [("v", "A", 0), ("v", "B", 200), ("v", "C", 400)], {}) == {("v", ("A", "B", "C"), 400.0)}


def test_exactly_the_minimum_is_too_short(spark):
    assert segmented(spark, [("v", "A", 0), ("v", "B", 100), ("v", "C", 300)], {}) == set()


def test_open_trip_is_lost(spark):
    assert segmented(spark, [("v", "A", 0), ("v", "B", 200), ("v", "C", 400), ("v", "C", 450)], {}) == set()


@given(st.lists(st.lists(st.tuples(st.sampled_from("ABC"), st.integers(0, 1100)), min_size=1, max_size=14), min_size=30, max_size=60))
@settings(max_examples=4, deadline=None)
def test_trips_follow_the_automaton(spark, vehicles):
    rows = []
    for i, steps in enumerate(vehicles):
        t = 0
        for k, gap in steps:
            t += gap
            rows.append((f"v{i}", k, t))
    limits = {("A", "B"): (50, 500), ("B", "C"): (0, 2000), ("C", "A"): (700, 720)}
    assert segmented(spark, rows, limits) == plain(rows, limits)
    assert {x for x in segmented(spark, rows, {})} == plain(rows, {})


def test_streaming_step_follows_the_automaton():
    rng = np.random.default_rng(3)
    limits = {("A", "B"): (50.0, 500.0), ("B", "C"): (0.0, 900.0)}
    for _ in range(300):
        t, rows, state, got = 0, [], (None, None, [], [], 0), []
        for _ in range(12):
            t += int(rng.integers(0, 1100))
            rows.append(("v", "ABC"[rng.integers(3)], t))
        for _, k, at in rows:
            lo, hi = limits.get((state[0], k), (1.0, 900.0))
            state, closed = step(state, k, float(at), lo, min(hi, 900.0), 600.0, S)
            got += [("v", tuple(closed[0]), closed[1][-1] - closed[1][0])] if closed else []
        ends = plain(rows, limits)
        # batch also closes a trip that the very last pass was accepted into
        assert set(got) <= ends and len(ends) - len(set(got)) <= 1


def test_pair_classes(spark):
    def gaps(n, spread, hours):
        return [("A", "B", float(i % 2 * spread + 10), hours[i % len(hours)]) for i in range(n)]

    def one_row(rows):
        df = spark.createDataFrame(rows, "from_KKBH string, to_KKBH string, time double, hour int")
        return thresholds.classify(df, S).first().one_row

    assert one_row(gaps(49, 1000, [7, 9, 0])) and one_row(gaps(60, 150, [7, 9, 0])) and one_row(gaps(60, 1000, [7, 9]))
    assert not one_row(gaps(60, 1000, [7, 9, 0]))


def test_bounds(spark):
    def bounds(rows, hour=7, b=100.0):
        m = F.map_from_entries(F.array(*[F.struct(F.lit(p), F.struct(F.lit(lo).alias("min"), F.lit(hi).alias("max"))) for p, lo, hi in rows])) if rows else F.lit(None).cast("map<string,struct<min:double,max:double>>")
        x = spark.range(1).select(m.alias("m")).select(*thresholds.bounds(F.col("m"), F.lit(hour), F.lit(b), S)).first()
        return tuple(x)

    assert bounds([]) == (1, 150)
    assert bounds([("all", 2.9, 20.5)]) == (2, 20)  # truncated; half goes to even
    assert bounds([("low", 2.9, 21.5)]) == (2, 22)  # the only row counts, whatever its label
    assert bounds([("all", 120.0, 150.0)]) == (1, 150)
    assert bounds([("all", 5.0, 500.0)]) == (5, 150)
    assert bounds([("high", 5.0, 50.0), ("low", 1.0, 2.0)]) == (5, 50)
    assert bounds([("flat", 5.0, 50.0), ("low", 1.0, 2.0)]) == (1, 150)
    assert bounds([("all", float("nan"), 2.0)]) == (1, 150)


def test_forest():
    rng = np.random.default_rng(1)
    values = np.r_[rng.normal(100, 5, 500), 5000.0]
    kept = inliers(values, 15, 2023, "a")
    assert 5000 not in kept and set(kept) <= set(values) and len(kept) > 250
    assert (kept == inliers(rng.permutation(values), 15, 2023, "a")).all()
    assert list(inliers(np.array([3.0, 900.0]), 15, 1)) == [3.0, 900.0]
    assert len(inliers(np.full(50, 7.0), 15, 1)) == 50


def test_gaps_stay_within_a_date(spark):
    rows = [("v", "A", 0), ("v", "B", 60), ("v", "C", 86400), ("w", "A", 5)]
    out = stats.gaps(passes(spark, rows)).collect()
    assert [(r.KKOD, r.time, r.hour) for r in out] == [("A-B", 60.0, 7)]


@given(st.lists(st.integers(0, 9), min_size=1, max_size=30))
def test_weighted_median(values):
    distinct, counts = np.unique(values, return_counts=True)
    assert weighted_median(distinct.astype(float), counts) == np.median(values)
