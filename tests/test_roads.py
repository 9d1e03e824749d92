"""Road graph, distances and matching."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tollway.config import Topology
from tollway.functions.geodesic import vincenty
from tollway.operators import match, topology
from tollway.sources import tables

T = Topology()
ROAD = "seq long, osm_id string, oneway string, fclass string, maxspeed string, line array<struct<lon:double,lat:double>>"


def graph(spark, roads):
    pts = topology.points(spark.createDataFrame([(i, *r) for i, r in enumerate(roads)], ROAD))
    return pts, topology.nodes(pts), topology.edges(pts, T)


def test_shared_coordinates_are_links(spark):
    roads = [("1", "B", "primary", None, [(0.0, 0.0), (0.0, 1.0)]), ("2", "F", "track", "60", [(1.0, 0.0), (0.0, 0.0), (2.0, 0.0)]), ("3", "T", "trunk", "", [(3.0, 3.0), (0.0, 0.0)])]
    _, nodes, edges = graph(spark, roads)
    names = {(r.lon, r.lat): r.name for r in nodes.collect()}
    assert names == {(0.0, 0.0): "LINK-1-2-3", (0.0, 1.0): "D-1", (1.0, 0.0): "O-2", (2.0, 0.0): "D-2", (3.0, 3.0): "O-3"}
    table = {(r.start_node, r.end_node): r for r in topology.edge_table(edges, nodes).collect()}
    assert set(table) == {("LINK-1-2-3", "D-1"), ("D-1", "LINK-1-2-3"), ("O-2", "LINK-1-2-3"), ("LINK-1-2-3", "D-2"), ("LINK-1-2-3", "O-3")}
    e = table["O-2", "LINK-1-2-3"]
    assert e.kind == 0 and e.duration == pytest.approx(e.road_length / (54 / 3.6))
    assert topology.totals(edges, nodes).first().edges == 5


def test_long_names_are_not_exchanged(spark):
    """Roads that meet on a grid of 6 by 6: cells give the rows that joins give, and no exchange carries names."""
    rng = np.random.default_rng(3)
    roads = [(str(i), "BFT"[i % 3], "primary", None, [(float(x), float(y)) for x, y in rng.integers(0, 6, (4, 2))]) for i in range(300)]
    _, nodes, edges = graph(spark, roads)
    found = topology.edge_table(edges, nodes, long=0)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    rows, want = ([tuple(r) for r in topology.edge_table(edges, nodes, long=n).collect()] for n in (0, 1 << 20))
    assert sorted(rows) == sorted(want) and len(rows) == edges.count() > 500
    names = {(r.lon, r.lat): r.name for r in nodes.collect()}
    assert sorted((names[r.start_lon, r.start_lat], names[r.end_lon, r.end_lat], r.length) for r in edges.collect()) == sorted((r[0], r[1], r[4]) for r in rows)


def test_written_cells_have_each_name_once(spark, tmp_path):
    """128 nodes with names of 40 KB and 2560 edges: 205 MB of names in the rows, 42 MB in the dictionaries of 16 cells."""
    name = F.concat_ws("-", F.transform(F.sequence(F.lit(1), F.lit(620)), lambda i: F.sha2(F.concat_ws(":", "id", i), 256)))
    nodes = spark.range(128).select(F.col("id").cast("double").alias("lon"), F.lit(0.0).alias("lat"), name.alias("name"))
    ends = [F.col("id") % 128, F.lit(0), (F.col("id") % 128 + F.expr("id div 128") * 6) % 128, F.lit(0)]
    edges = spark.range(2560).select(*[c.cast("double").alias(n) for c, n in zip(ends, ("start_lon", "start_lat", "end_lon", "end_lat"), strict=True)], F.lit(1).alias("kind"), F.lit(1.0).alias("duration"), F.lit(2.0).alias("length"))
    topology.edge_table(edges, nodes).write.parquet(f"{tmp_path}/edges")
    assert sum(p.stat().st_size for p in (tmp_path / "edges").iterdir()) < 60e6
    found = spark.read.parquet(f"{tmp_path}/edges")
    assert found.select(F.count("*"), F.countDistinct(F.xxhash64("start_node")), F.countDistinct(F.xxhash64("end_node"))).first()[:] == (2560, 128, 128)


def test_repeated_points_and_later_roads(spark):
    a, b = (0.0, 0.0), (0.0, 0.1)
    _, nodes, edges = graph(spark, [("1", "F", "primary", "10", [a, b, a]), ("2", "F", "motorway", None, [a, b]), ("3", "F", "primary", None, [a])])
    rows = edges.collect()
    assert len(rows) == 1 and rows[0].kind == 1 and nodes.count() == 2
    assert rows[0].duration == pytest.approx(rows[0].length / (100 / 3.6))


def test_parts(spark):
    df = spark.createDataFrame([("MULTILINESTRING ((0 0, 1 1), (2 2, 3 3))",), ("LINESTRING(5 5,6 6)",)], "wkt string")
    assert [[(p.lon, p.lat) for p in r.line] for r in tables.lines_from_wkt(df).collect()] == [[(2, 2), (3, 3)], [(5, 5), (6, 6)]]
    with pytest.raises(Exception, match="two parts"):
        tables.lines_from_wkt(df.limit(0).union(spark.createDataFrame([("MULTILINESTRING((0 0,1 1))",)], "wkt string"))).collect()
    points = spark.createDataFrame([("POINT (113.5 23.25)",), ("LINESTRING(0 0,1 1)",)], "wkt string")
    assert [(r.Longitude, r.Latitude) for r in tables.points_from_wkt(points).collect()] == [(113.5, 23.25)]


def test_geodesic_lines():
    """A quarter meridian, a degree on the equator, and a published line (Flinders Peak to Buninyong)."""
    f = lambda *x: float(vincenty(*(np.array([v]) for v in x))[0])
    assert f(0.0, 0.0, 0.0, 90.0) == pytest.approx(10001965.729, abs=0.001)
    assert f(0.0, 0.0, 1.0, 0.0) == pytest.approx(111319.491, abs=0.001)
    assert f(5.0, 5.0, 5.0, 5.0) == 0
    dms = lambda d, m, s: d + m / 60 + s / 3600
    line = f(dms(144, 25, 29.52440), -dms(37, 57, 3.72030), dms(143, 55, 35.38390), -dms(37, 39, 10.15610))
    assert line == pytest.approx(54972.271, abs=0.01)


def test_second_checkpoint_takes_the_next_node(spark):
    nodes = spark.createDataFrame([("n1", 113.0, 23.0), ("n2", 113.0, 23.0003)], "name string, lon double, lat double")
    points = spark.createDataFrame([(0, "a", 113.0, 23.00001), (1, "b", 113.0, 23.0), (2, "c", 114.0, 23.0), (3, "d", 113.0, 23.0)], "seq long, KKBH string, Longitude double, Latitude double")
    out = {r.KKBH: (r.node, r.dist_m) for r in match.one_to_one(match.candidates(points, nodes, T)).collect()}
    assert out["a"][0] == "n1" and out["b"][0] == "n2" and set(out) == {"a", "b"}
    assert out["b"][1] == pytest.approx(33.23, abs=0.02)


def test_match_is_serial_choice(spark):
    rng = np.random.default_rng(7)
    rows = [(int(s), f"p{s}", f"n{n}", float(rng.integers(0, 60)), float(n), 0.0) for s in range(60) for n in rng.choice(40, 4, replace=False)]
    found = spark.createDataFrame(rows, "seq long, KKBH string, node string, dist double, lon double, lat double")
    taken, want = set(), {}
    for s in range(60):
        for _, _, n, d, *_ in sorted((r for r in rows if r[0] == s), key=lambda r: (r[3], r[4])):
            if n not in taken:
                taken.add(n)
                want[s] = n
                break
    assert {r.seq: r.node for r in match.one_to_one(found).collect()} == want


def test_no_candidates(spark):
    empty = spark.createDataFrame([], "seq long, KKBH string, node string, dist double, lon double, lat double")
    assert match.one_to_one(empty).count() == 0
    points = spark.createDataFrame([], "seq long, KKBH string, Longitude double, Latitude double")
    nodes = spark.createDataFrame([("n", 0.0, 0.0)], "name string, lon double, lat double")
    assert match.summary(points, nodes, match.one_to_one(empty).select(F.lit(1))).first().match_rate == 0


def test_geodesic_table_reads_stored_tables(spark):
    """Its plan reads stored nodes and edges; roads, which both need, are not read and measured once more."""
    from tollway.plans import catalog

    plan = catalog.queries()["edge_table_geodesic"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan and "ArrowEvalPython" not in plan
