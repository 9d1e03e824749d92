"""Readers, writers, configuration, and the pipelines from files to files."""

import json
import struct
import zipfile
from pathlib import Path
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from tollway import __main__ as cli
from tollway.config import Rules, Segmentation, Topology, align, dump, load, overlay, sections
from tollway.plans import stages
from tollway.sources import arrays, shapefile, sinks, tables

TEXT = "KKBH,FZJG\n007,粤E\n8,粤X\n"


@pytest.mark.parametrize("encoding", ["gbk", "gb18030", "utf-8-sig", "utf-8"])
def test_encodings(spark, tmp_path, encoding):
    (tmp_path / "a.csv").write_bytes((TEXT + "9,粤Y和一些更长的文字\n").encode(encoding))
    preferred = encoding if encoding.startswith("utf") else None
    df = tables.read_csv(spark, str(tmp_path / "a.csv"), preferred)
    assert df.columns == ["KKBH", "FZJG"]
    assert [(r.KKBH, r.FZJG) for r in df.collect()][:2] == [("007", "粤E"), ("8", "粤X")]


def test_detection():
    assert tables.detect_encoding("粤".encode("gbk")) == "gbk"
    assert tables.detect_encoding("粤".encode()[:2], ("utf-8",)) == "utf-8"  # cut off, not wrong
    with pytest.raises(ValueError):
        tables.detect_encoding(b"\xff\xff\xff", ("utf-8",))


@pytest.mark.parametrize(("encoding", "last"), [("utf-8", "9,粤"), ("gb18030", "9,㐀"), ("gbk", "9,粤")])
def test_encoding_of_a_long_file(spark, tmp_path, encoding, last):
    """What tells the encoding stands beyond the head that is probed."""
    (tmp_path / "a.csv").write_bytes(b"KKBH,FZJG\n" + b"1,ascii\n" * (tables.PROBE_BYTES // 7) + (last + "\n").encode(encoding))
    df = tables.read_csv(spark, str(tmp_path / "a.csv"))
    assert [r.FZJG for r in df.where("KKBH = '9'").collect()] == [last[2:]]


def test_parquet_is_preferred(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a\n1\n")
    path = str(tmp_path / "t.csv")
    assert tables.read_table(spark, path).first().a == "1"
    assert sinks.write_parquet(spark.range(1).withColumnRenamed("id", "a"), path).endswith("t.parquet")
    assert tables.read_table(spark, path).first().a == 0
    with pytest.raises(FileNotFoundError, match="pool"):
        tables.read_parquet(spark, str(tmp_path / "none.parquet"), "pool")


def test_bom_and_gml(spark, tmp_path):
    sinks.write_csv(spark.range(2), str(tmp_path / "c"))
    assert next(Path(tmp_path / "c").glob("*.csv")).read_bytes().startswith(b"\xef\xbb\xbfid\n")
    nodes = spark.createDataFrame([('a"', 0.0, 0.0), ("b", 1.0, 1.0)], "name string, lon double, lat double")
    edges = spark.createDataFrame([('a"', "b", 1.0, 2, 3.0)], "start_node string, end_node string, road_length double, kind int, duration double")
    sinks.write_gml(nodes, edges, str(tmp_path / "g"))
    text = next(Path(tmp_path / "g").glob("*.txt")).read_text()
    assert text.startswith("graph [") and text.rstrip().endswith("]") and text.count("node [") == 2 and "&quot;" in text


def test_cache(spark, tmp_path):
    made = []

    def make():
        made.append(1)
        return spark.range(3)

    path = str(tmp_path / "d.parquet")
    for key, rebuild in (({"a": 1}, False), ({"a": 1}, False), ({"a": 2}, False), ({"a": 2}, True)):
        assert sinks.cached(spark, path, key, make, rebuild).count() == 3
    assert len(made) == 3


def test_arrays_and_spreadsheets(spark, tmp_path):
    matched = spark.createDataFrame([(1, "n2", "008", 3.5), (0, "n1", "007", 1.25)], "seq long, node string, KKBH string, dist_m double")
    arrays.write_match_npy(matched, str(tmp_path / "m.npy"))
    assert [tuple(r) for r in arrays.read_match_npy(spark, str(tmp_path / "m.npy")).orderBy("seq").collect()] == [(0, "n1", "007", 1.25), (1, "n2", "008", 3.5)]
    nodes = spark.createDataFrame([("a", 1.0, 2.0)], "name string, lon double, lat double")
    arrays.write_positions_npy(nodes, str(tmp_path / "p.npz"))
    assert arrays.read_positions_npy(spark, str(tmp_path / "p.npz")).collect() == nodes.collect()
    arrays.write_xlsx(spark.createDataFrame([("1m & more", 2, 0.5), (None, 3, 0.25)], "label string, n long, p double"), str(tmp_path / "x.xlsx"))
    with zipfile.ZipFile(tmp_path / "x.xlsx") as z:
        sheet = ElementTree.fromstring(z.read("xl/worksheets/sheet1.xml"))
    assert ["".join(c.itertext()) for c in sheet.iter() if c.tag.endswith("}c")] == ["label", "n", "p", "1m & more", "2", "0.5", "", "3", "0.25"]
    with pytest.raises(ValueError, match="more than 1 rows"):
        arrays.write_xlsx(spark.range(3), str(tmp_path / "y.xlsx"), most=1)


def test_config(tmp_path):
    path = str(tmp_path / "r.json")
    dump(Rules(), path)
    assert load(Rules, path) == Rules() and load(Rules, None) == Rules()
    assert overlay(Rules(), {"valid_fuel_types": ["A"]}).valid_fuel_types == ("A",)
    with pytest.raises(ValueError, match="colour"):
        overlay(Rules(), {"colour": 1})
    assert align(Segmentation(), {"colour": 1, "cap_scale": 2.0}).cap_scale == 2.0


def test_flat_config():
    """Keys of flat files; unknown ones raise, those about processes are passed over."""
    flat = {
        "bayonet_shp_path": "/a/points.shp", "raw_bayonet_csv_path": "/a/raw.csv", "preprocessed_data_path": "/b/passes.csv", "raw_csv_encoding": None, "output_csv_encoding": "gbk", "parallel_workers": 60,
        "random_seed": 7, "travel_time_bins": [0, 60], "travel_time_labels": ["1m"], "kkod_std_threshold": 90.0, "iforest_n_estimators": 4, "high_hours": [7], "flat_hours": [8], "low_hours": [0, 1, 2, 3, 4, 5, 6, *range(9, 24)],
        "match_threshold_m": 50.0, "sampling_dist_force_rebuild": True,
    }
    out = sections(flat)
    assert out["paths"] == {"checkpoints": "/a/points.shp", "raw": "/a/raw.csv", "passes": "/b/passes.csv", "output": "/b"} and out["output_encoding"] == "gbk" and out["rebuild"] is True
    assert overlay(Rules(), out["rules"]).travel_time_bins == (0, 60) and overlay(Segmentation(), out["segmentation"]).n_estimators == 4 and overlay(Topology(), out["topology"]).match_distance_m == 50.0
    assert sections({"paths": {}}) == {"paths": {}}
    with pytest.raises(ValueError, match="colour"):
        sections({**flat, "colour": 1})
    with pytest.raises(ValueError, match="low_hours"):
        sections({**flat, "low_hours": [1]})


@pytest.mark.parametrize("encoding", ["gbk", "gb18030", "utf-8", "utf-8-sig", None])
def test_csv_output_encodings(spark, tmp_path, encoding):
    sinks.write_csv(spark.createDataFrame([("粤E", 1)], "a string, b int"), str(tmp_path / "o"), encoding)
    data = next((tmp_path / "o").glob("*.csv")).read_bytes()
    assert data.decode(encoding or "utf-8-sig").split() == ["a,b", "粤E,1"] and data.startswith(b"\xef\xbb\xbf") == (encoding in ("utf-8-sig", None))


def test_empty_pool_is_an_error(spark):
    from tollway.plans import stages, views

    sf = "/root/testdata/sf0.001"
    points = views.view(spark, sf, "select distinct event_type as KKBH, 113.0D as Longitude, 23.0D as Latitude from events")
    s = stages.Sources(views.raw(spark, sf), points, views.route(spark, sf), views.vehicles(spark, sf).where("1 = 0"))
    with pytest.raises(ValueError, match="no vehicle"):
        stages.supplement(s, Rules())


def test_fixed_threshold_is_the_quantile(spark):
    """Against NumPy: whole and broken seconds, one value, none."""
    import numpy as np

    from tollway.operators.thresholds import fixed_threshold

    rng = np.random.default_rng(3)
    for values in (rng.integers(0, 5000, 700).astype(float), rng.random(301) * 200, np.array([42.0]), np.repeat(7.0, 50), np.zeros(0)):
        for q in (0.7, 0.0, 1.0, 0.333):
            got = fixed_threshold(spark.createDataFrame([(float(v),) for v in values], "time double"), Segmentation(fixed_quantile=q)).first()["B"]
            assert got == pytest.approx(np.quantile(values, q), rel=1e-12) if len(values) else got is None


def shp(kind, bodies):
    out = bytearray(100)
    for i, body in enumerate(bodies):
        out += struct.pack(">ii", i + 1, (4 + len(body)) // 2) + struct.pack("<i", kind) + body
    return bytes(out)


def dbf(fields, rows):
    width = 1 + sum(w for _, w in fields)
    head = struct.pack("<B3BIHH20x", 3, 1, 1, 1, len(rows), 33 + 32 * len(fields), width)
    for name, w in fields:
        head += name.encode().ljust(11, b"\0") + b"C" + bytes(4) + bytes([w, 0]) + bytes(14)
    return head + b"\r" + b"".join(b" " + b"".join(v.encode().ljust(w) for v, (_, w) in zip(r, fields, strict=True)) for r in rows)


def line(*parts):
    xy = [c for p in parts for pt in p for c in pt]
    starts = [sum(map(len, parts[:i])) for i in range(len(parts))]
    return struct.pack("<4d", 0, 0, 1, 1) + struct.pack(f"<2i{len(parts)}i", len(parts), len(xy) // 2, *starts) + struct.pack(f"<{len(xy)}d", *xy)


def test_shapefiles(spark, tmp_path):
    (tmp_path / "r.shp").write_bytes(shp(3, [line([(0.0, 1.0), (2.0, 3.0)]), line([(0.0, 0.0), (1.0, 1.0)], [(5.0, 5.0), (6.0, 6.0)])]))
    (tmp_path / "r.dbf").write_bytes(dbf([("osm_id", 5), ("oneway", 1), ("fclass", 10), ("maxspeed", 4)], [("11", "F", "primary", "60"), ("12", "", "track", "")]))
    (tmp_path / "other.shp").write_bytes(shp(3, [line([(9.0, 9.0), (8.0, 8.0)])]))
    rows = stages.read_source(spark, "roads", str(tmp_path / "r.shp")).orderBy("seq").collect()
    assert [(r.osm_id, r.oneway, [(p.lon, p.lat) for p in r.line]) for r in rows] == [("11", "F", [(0, 1), (2, 3)]), ("12", "", [(5, 5), (6, 6)])]
    (tmp_path / "p").mkdir()
    (tmp_path / "p/k.shp").write_bytes(shp(1, [struct.pack("<2d", 113.0, 23.0)]))
    (tmp_path / "p/k.dbf").write_bytes(dbf([("KKBH", 4)], [("007",)]))
    assert stages.read_source(spark, "checkpoints", str(tmp_path / "p/k.shp")).collect() == shapefile.checkpoints(spark, str(tmp_path / "p")).collect()
    r = shapefile.checkpoints(spark, str(tmp_path / "p")).first()
    assert (r.KKBH, r.Longitude, r.Latitude) == ("007", 113.0, 23.0)


def test_all_stages(spark, tmp_path):
    from tollway.plans import views

    sf = "/root/testdata/sf0.001"
    write = lambda df, name: df.coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    write(views.raw(spark, sf).where("GCSJ <> 'unknown'"), "raw")
    write(views.view(spark, sf, "select distinct event_type as KKBH, cast(113 + length(event_type) / 2000.0 as double) as Longitude, cast(23.0 as double) as Latitude from events"), "checkpoints")
    write(views.route(spark, sf).withColumn("KKBH", F.regexp_replace("KKBH", "^0", "")), "route")
    write(views.vehicles(spark, sf), "vehicles")
    roads = views.roads(spark, sf).select("seq", "osm_id", "oneway", "fclass", "maxspeed", F.concat(F.lit("LINESTRING("), F.array_join(F.transform("line", lambda p: F.concat_ws(" ", p["lon"], p["lat"])), ","), F.lit(")")).alias("wkt"))
    write(roads, "roads")
    paths = {n: str(tmp_path / f"{n}.parquet") for n in ("raw", "checkpoints", "route", "vehicles", "roads")} | {"output": str(tmp_path / "out")}
    config = tmp_path / "c.json"
    config.write_text(json.dumps({"paths": paths, "segmentation": {"n_estimators": 3}}))
    for stage in cli.STAGES:
        cli.main([stage, "--config", str(config)])
    out = tmp_path / "out"
    read = lambda n: spark.read.parquet(str(out / f"{n}.parquet"))
    assert read("passes").count() > 100 and read("trips").count() > 10 and read("excluded_supplement").where("CLLX is null").count() == 0
    assert json.loads((out / "partition.json").read_text())["fixed_b"] > 0
    about = json.loads((out / "partition.json").read_text())
    assert about["trips"] == read("trips").count() and about["gaps"] == spark.read.csv(str(out / "adjacent_gaps.csv"), header=True).count() > 0
    assert arrays.read_thresholds_npy(spark, str(out / "thresholds.npy")).count() == about["threshold_rows"]
    nodes, edges = tables.read_gml(spark, str(out / "graph.gml"))
    assert sorted(nodes.select("name").collect()) == sorted(read("nodes").select("name").collect()) == sorted(arrays.read_positions_npy(spark, str(out / "positions.npz")).select("name").collect())
    assert sorted(map(tuple, edges.collect())) == sorted(map(tuple, read("edges").select("start_node", "end_node", "road_length", "kind", "duration").collect()))
    # the route as a match array, under a prefix
    arrays.write_match_npy(spark.read.parquet(paths["route"]).select(F.col("KKBH").alias("node"), "KKBH", F.lit(0.0).alias("dist_m"), F.monotonically_increasing_id().alias("seq")), str(tmp_path / "route.npy"))
    config.write_text(json.dumps({"output_dir": str(out), "output_prefix": "x_", "bayonet_match_path": str(tmp_path / "route.npy"), "iforest_n_estimators": 3, "workers": 60, "output_csv_encoding": "gbk"}))
    cli.main(["partition", "--config", str(config)])
    assert json.loads((out / "x_partition.json").read_text())["fixed_b"] == about["fixed_b"] and read("x_trips").count() > 0
    summary = {r.metric: r.value for r in spark.read.csv(str(out / "diagnostics_summary.csv"), header=True).toDF("metric", "value").collect()}
    assert float(summary["included_records"]) + float(summary["excluded_records"]) == float(summary["center_records_before_split"])
    assert (out / "match.csv").is_dir() and (out / "dist_compare_supplement_vs_raw.csv").is_dir()
    cli.main(["--dump-config", str(tmp_path / "t.json")])
    assert json.loads((tmp_path / "t.json").read_text())["rules"]["sampling_mode"] == "joint"
