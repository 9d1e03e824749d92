"""Command line: python -m tollway STAGE --config FILE, or --dump-config FILE.

The configuration is a JSON object with `paths` (raw, checkpoints, route, vehicles, roads, output), any parameters of
the stage under `rules`, `segmentation` or `topology`, and `encoding`, `output_encoding`, `id_field` and `rebuild`; or a
flat object of the keys in ``config.FLAT``. Checkpoints and roads may be shapefiles, the route a match array (.npy).
Results go to `output`, but those that `paths` has a place for under their own name."""

from __future__ import annotations

import argparse
import json
from dataclasses import asdict
import time
from pathlib import Path

from tollway.config import Rules, Segmentation, Topology, overlay, read_json, sections
from tollway.operators import clean, impute
from tollway.plans import stages
from tollway.session import local_session
from tollway.sources import arrays, sinks, tables

STAGES = ("preprocess", "statistics", "supplement", "partition", "topology", "match", "diagnose")


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tollway", description=__doc__)
    parser.add_argument("stage", nargs="?", choices=STAGES)
    parser.add_argument("--config")
    parser.add_argument("--dump-config")
    parser.add_argument("--topk", type=int, default=20)
    parser.add_argument("--skip-raw-distribution", action="store_true")
    args = parser.parse_args(argv)
    if args.dump_config:
        empty = {"paths": {}, "encoding": None, "rules": asdict(Rules()), "segmentation": asdict(Segmentation()), "topology": asdict(Topology())}
        Path(args.dump_config).write_text(json.dumps(empty, ensure_ascii=False, indent=2) + "\n", "utf-8")
        return 0
    if not args.stage or not args.config:
        parser.error("a stage and --config are needed")
    config = sections(read_json(args.config))
    if not config.get("paths", {}).get("output"):
        parser.error("the configuration names no output folder")
    r, g, t = (overlay(kind(), config.get(name, {})) for kind, name in ((Rules, "rules"), (Segmentation, "segmentation"), (Topology, "topology")))
    run(local_session("*"), args.stage, config["paths"], config.get("encoding"), r, g, t, args.topk, not args.skip_raw_distribution, config.get("output_encoding"), config.get("id_field", "KKBH"), bool(config.get("rebuild")))
    return 0


def run(spark, stage: str, paths: dict[str, str], encoding: str | None, r: Rules, g: Segmentation, t: Topology, k: int = 20, with_raw: bool = True, output_encoding: str | None = None, id_field: str = "KKBH", rebuild: bool = False) -> None:
    out, started = paths["output"].rstrip("/"), time.time()
    prefix = paths.get("prefix", "")
    table = lambda name: sinks.parquet_path(paths.get(name, f"{out}/{name}.parquet"))
    report = lambda df, name, one=True: sinks.write_csv(df, f"{out}/{name}.csv", output_encoding, one)
    source = lambda name: stages.read_source(spark, name, paths[name], encoding, id_field)
    if stage == "preprocess":
        passes, vehicles = stages.preprocess(stages.read_sources(spark, paths, encoding, id_field), r)
        sinks.write_parquet(passes, table("passes"))
        sinks.write_parquet(vehicles, table("vehicle_info"))
    elif stage == "statistics":
        hours, histogram = stages.statistics(tables.read_parquet(spark, table("passes"), "passes"), r)
        for df, name in ((hours.orderBy("hour"), "hourly"), (histogram, "gaps")):
            report(df, name)
            sheet = paths.get(name, f"{out}/{name}.xlsx")
            if "://" not in sheet:
                arrays.write_xlsx(df, sheet if sheet.endswith(".xlsx") else f"{sheet}.xlsx")
    elif stage == "supplement":
        s = stages.read_sources(spark, paths, encoding, id_field)
        key = sinks.signature(spark, paths["raw"], encoding=encoding)
        dist = sinks.cached(spark, f"{out}/sampling_distribution.parquet", key, lambda: impute.sampling_distribution(clean.with_sequence(s.raw), r.timestamp_formats), rebuild)
        rebuilt, attributes = stages.supplement(s, r, dist)
        sinks.write_parquet(rebuilt, table("excluded_supplement"))
        sinks.write_parquet(attributes, table("device_attributes"))
    elif stage == "partition":
        records = stages.read_source(spark, "excluded_supplement", paths.get("excluded_supplement", f"{out}/excluded_supplement.parquet"), encoding)
        found, rows, gaps, about = stages.partition(records, source("route"), g)
        sinks.write_trips(found, f"{out}/{prefix}trips.parquet")
        report(rows, f"{prefix}thresholds")
        report(gaps, f"{prefix}adjacent_gaps", one=False)
        if "://" not in out:
            arrays.write_thresholds_npy(rows, f"{out}/{prefix}thresholds.npy")
        trips = spark.read.parquet(f"{out}/{prefix}trips.parquet").count()
        sinks.write_json(about | {"trips": trips, "seconds": round(time.time() - started, 1), "written": time.strftime("%Y-%m-%d %H:%M:%S"), "parameters": asdict(g)}, f"{out}/{prefix}partition.json")
    elif stage == "topology":
        roads = source("roads")
        nodes, edges = stages.road_graph(roads if "line" in roads.columns else tables.lines_from_wkt(roads), t)
        sinks.write_parquet(nodes, f"{out}/nodes.parquet")
        sinks.write_parquet(edges, f"{out}/edges.parquet")
        report(edges, "edges")
        sinks.write_gml(nodes, edges, f"{out}/graph.gml")
        if "://" not in out:
            arrays.write_positions_npy(nodes, f"{out}/positions.npz")
    elif stage == "match":
        points = source("checkpoints")
        points = points if "Longitude" in points.columns else tables.points_from_wkt(points)
        points = points.withColumns({c: points[c].cast("double") for c in ("Longitude", "Latitude")})
        found = stages.match_checkpoints(points, tables.read_parquet(spark, f"{out}/nodes.parquet", "nodes"), t)
        found = sinks.checkpointed(found)
        report(found.orderBy("seq").drop("seq"), "match")
        if "://" not in out:
            arrays.write_match_npy(found, f"{out}/match.npy")
    else:
        s = stages.read_sources(spark, paths, encoding, id_field)
        read = lambda name: tables.read_parquet(spark, table(name), name)
        for name, df in stages.diagnose(s, read("excluded_supplement"), read("device_attributes"), r, k, with_raw).items():
            report(df, name)


if __name__ == "__main__":
    raise SystemExit(main())
