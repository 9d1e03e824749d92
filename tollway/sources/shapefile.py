"""ESRI shapefiles (points and polylines) with their dBASE attributes, read on executors through Spark's binary source.

The format puts a file's records one after the other, so a file is one task; sets of many files are read in parallel."""

from __future__ import annotations

import struct

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollway.sources.tables import exists

POINT, LINE = 1, 3
SCHEMA = "path string, seq long, points array<array<struct<lon:double,lat:double>>>, attributes map<string,string>"


def shapes(data: bytes):
    """Of each record: a list of parts, each a list of (x, y); an empty list for other kinds and null shapes."""
    at = 100
    while at + 8 <= len(data):
        size = 2 * struct.unpack(">i", data[at + 4 : at + 8])[0]
        body = data[at + 8 : at + 8 + size]
        kind = struct.unpack("<i", body[:4])[0] % 10
        if kind == POINT:
            yield [[struct.unpack("<2d", body[4:20])]]
        elif kind == LINE:
            parts, n = struct.unpack("<2i", body[36:44])
            starts = [*struct.unpack(f"<{parts}i", body[44 : 44 + 4 * parts]), n]
            xy = struct.unpack(f"<{2 * n}d", body[44 + 4 * parts : 44 + 4 * parts + 16 * n])
            points = list(zip(xy[::2], xy[1::2], strict=True))
            yield [points[a:b] for a, b in zip(starts, starts[1:], strict=False)]
        else:
            yield []
        at += 8 + size


def attributes(data: bytes, encoding: str = "utf-8"):
    """Of each record: its fields as text, stripped."""
    n, head, width = struct.unpack("<IHH", data[4:12])
    fields, at = [], 32
    while data[at] != 13:
        fields.append((data[at : at + 11].split(b"\0")[0].decode("ascii"), data[at + 16]))
        at += 32
    for i in range(n):
        row, pos, out = data[head + i * width : head + (i + 1) * width], 1, {}
        for name, size in fields:
            out[name] = row[pos : pos + size].decode(encoding, "replace").strip()
            pos += size
        yield out


def read(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    """One row per shape of a file, or of all files of a folder: path, seq (its place in the file), points (parts), attributes."""
    names = [path] if not path.endswith(".shp") else [x for x in (path, path[:-4] + ".dbf") if x == path or exists(spark, x)]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{shp,dbf}").load(names)
    stem = F.regexp_replace("path", "\\.(shp|dbf)$", "")
    both = files.groupBy(stem.alias("stem")).agg(F.first(F.when(F.col("path").endswith(".shp"), F.col("content")), ignorenulls=True).alias("shp"), F.first(F.when(F.col("path").endswith(".dbf"), F.col("content")), ignorenulls=True).alias("dbf"))

    def parse(batches):
        import pandas as pd

        for pdf in batches:
            for stem_, shp, dbf in zip(pdf["stem"], pdf["shp"], pdf["dbf"], strict=True):
                rows = list(shapes(shp)) if shp is not None else []
                more = list(attributes(dbf, encoding)) if dbf is not None else [{}] * len(rows)
                yield pd.DataFrame({"path": stem_, "seq": range(len(rows)), "points": [[[{"lon": x, "lat": y} for x, y in p] for p in r] for r in rows], "attributes": more[: len(rows)]})

    return both.mapInPandas(parse, SCHEMA)


def roads(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    """osm_id, oneway, fclass, maxspeed and line of polylines; of several parts the second is taken."""
    x = read(spark, path, encoding)
    get = lambda c: F.col("attributes")[c].alias(c)
    line = F.when(F.size("points") == 1, F.col("points")[0]).otherwise(F.element_at("points", 2))
    return x.where(F.size("points") > 0).select("seq", get("osm_id"), get("oneway"), get("fclass"), get("maxspeed"), line.alias("line"))


def checkpoints(spark: SparkSession, path: str, id_field: str = "KKBH", encoding: str = "utf-8") -> DataFrame:
    """seq, KKBH, Longitude, Latitude of point shapes."""
    x = read(spark, path, encoding).where((F.size("points") == 1) & (F.size(F.col("points")[0]) == 1))
    p = F.col("points")[0][0]
    return x.select("seq", F.coalesce(F.col("attributes")[id_field], F.col("seq").cast("string")).alias("KKBH"), p["lon"].alias("Longitude"), p["lat"].alias("Latitude"))
