"""Readers: CSV with encoding detection, Parquet where there is one, road lines and points from shapefiles or text."""

from __future__ import annotations

import codecs
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENCODINGS = ("gbk", "gb18030", "utf-8-sig", "utf-8")
#: Bytes of a file's head that are decoded at the driver, with its byte order mark; all lines are decoded by Spark.
PROBE_BYTES = 1 << 20
CHARSETS = "spark.sql.legacy.javaCharsets"


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def head_bytes(spark: SparkSession, path: str, n: int = PROBE_BYTES) -> bytes:
    """The first bytes of a file, through Hadoop's file systems."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(p)
    try:
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(jvm.org.apache.commons.io.input.BoundedInputStream(stream, n)))
    finally:
        stream.close()


def detect_encoding(data: bytes, encodings: Sequence[str] = ENCODINGS) -> str:
    """The first encoding that decodes the bytes; a character cut off at their end does not count against it."""
    for name in encodings:
        try:
            codecs.getincrementaldecoder(name)("strict").decode(data, final=False)
        except UnicodeDecodeError:
            continue
        return name
    raise ValueError(f"none of {', '.join(encodings)} decodes the file")


def decodable(spark: SparkSession, path: str, encodings: Sequence[str]) -> list[str]:
    """Those of the encodings that decode every line of the file. None of them has line ends within a character."""

    def failed(batches):
        bad = set()
        for batch in batches:
            for line in batch.column("line").to_pylist():
                for name in encodings:
                    if name not in bad:
                        try:
                            line.decode(name)
                        except UnicodeDecodeError:
                            bad.add(name)
        yield pa.RecordBatch.from_arrays([pa.array(sorted(bad), pa.string())], names=["name"])

    lines = spark.read.text(path).select(F.col("value").cast("binary").alias("line"))
    bad = {r.name for r in lines.mapInArrow(failed, "name string").distinct().collect()}
    return [e for e in encodings if e not in bad]


def read_csv(spark: SparkSession, path: str, preferred: str | None = None, encodings: Sequence[str] = ENCODINGS) -> DataFrame:
    """All columns as text, so that ids keep their leading zeros."""
    order = [preferred, *[e for e in encodings if e != preferred]] if preferred else encodings
    whole = decodable(spark, path, order)
    if not whole:
        raise ValueError(f"none of {', '.join(order)} decodes the file")
    name = detect_encoding(head_bytes(spark, path), whole)
    charset = {"utf-8-sig": "UTF-8"}.get(name, name.upper())
    if charset in ("GBK", "GB18030"):
        spark.conf.set(CHARSETS, "true")
    df = spark.read.csv(path, header=True, encoding=charset, inferSchema=False)
    return df.withColumnsRenamed({c: c.lstrip("﻿") for c in df.columns if c.startswith("﻿")})


def read_parquet(spark: SparkSession, path: str, what: str = "table") -> DataFrame:
    if not exists(spark, path):
        raise FileNotFoundError(f"{what}: there is no {path}; has the stage that writes it run?")
    return spark.read.parquet(path)


def read_table(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    """The Parquet table of that name, if there is one; else the CSV file."""
    swapped = path.rsplit(".", 1)[0] + ".parquet" if path.endswith(".csv") else path
    return spark.read.parquet(swapped) if exists(spark, swapped) and swapped.endswith(".parquet") else read_csv(spark, path, encoding)


def read_gml(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(nodes: id, name; edges: start_node, end_node, road_length, kind, duration) of a graph file. What the file lacks is null."""
    parts = spark.read.text(path, wholetext=True).select(F.explode(F.split("value", "(?=\\b(?:node|edge)\\s*\\[)")).alias("part"))
    number = lambda c: F.regexp_extract("part", rf"\b{c}\s+(-?[0-9][0-9.eE+-]*)", 1)
    some = lambda c, kind: F.when(number(c) != "", number(c).cast(kind))
    text = F.regexp_replace(F.regexp_replace(F.regexp_extract("part", '\\blabel\\s+"([^"]*)"', 1), "&quot;", '"'), "&amp;", "&")
    nodes = parts.where(F.col("part").startswith("node")).select(some("id", "long").alias("id"), text.alias("name"))
    edges = parts.where(F.col("part").startswith("edge")).select(some("source", "long").alias("source"), some("target", "long").alias("target"), some("length", "double").alias("road_length"), some("kind", "int").alias("kind"), some("duration", "double").alias("duration"))
    start, end = (nodes.select(F.col("id").alias(i), F.col("name").alias(n)) for i, n in (("source", "start_node"), ("target", "end_node")))
    return nodes, edges.join(start, "source").join(end, "target").select("start_node", "end_node", "road_length", "kind", "duration")


def lines_from_wkt(df: DataFrame, column: str = "wkt") -> DataFrame:
    """df with `line` (array of lon, lat), from LINESTRING or MULTILINESTRING text; of several parts the second is taken."""
    parts = F.split(F.regexp_replace(F.col(column), "^[^(]*\\(+|\\)+\\s*$", ""), "\\)\\s*,\\s*\\(")
    many = F.upper(F.trim(F.col(column))).startswith("MULTI")
    short = F.raise_error(F.lit("a line of several parts needs two parts at least")).cast("string")
    text = F.when(~many, parts[0]).when(F.size(parts) >= 2, F.element_at(parts, 2)).otherwise(short)
    point = lambda p: F.struct(F.split(F.trim(p), "\\s+")[0].cast("double").alias("lon"), F.split(F.trim(p), "\\s+")[1].cast("double").alias("lat"))
    return df.withColumn("line", F.transform(F.split(text, ","), point))


def points_from_wkt(df: DataFrame, column: str = "wkt") -> DataFrame:
    """df with Longitude and Latitude from POINT text; rows with another geometry go."""
    pair = F.split(F.trim(F.regexp_extract(column, "(?i)^\\s*POINT\\s*\\(([^)]*)\\)", 1)), "\\s+")
    x = df.where(F.upper(F.trim(F.col(column))).startswith("POINT"))
    return x.withColumns({"Longitude": pair[0].cast("double"), "Latitude": pair[1].cast("double")})
