"""Writers, and the cache of the sampling distribution."""

from __future__ import annotations

import json
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollway.sources.tables import CHARSETS

LOGIC_VERSION = 1
#: Parquet's usual pages for tables of our own, whatever a result in the session asks for; page and row group are measured from the
#: first row on: by default each has 100 rows at least, which rows of some MB make hundreds of MB on the heap and in the codec.
CHECKS = {f"parquet.{x}.size.row.check.min": "1" for x in ("page", "block")}
PAGES = {"parquet.dictionary.page.size": str(1 << 20), "parquet.page.size": str(1 << 20)} | CHECKS
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpoint_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, which driver and executors share.

    A session on one machine without such a folder gets one; on a cluster it is an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not re.match(r"local(\[|$)", sc.master):
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            folder = f"file://{tempfile.gettempdir()}/checkpoints"
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """df, materialised in the session's checkpoint folder (reliable, not on executors)."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, by: str | None = None) -> DataFrame:
    """df as a Parquet table in the checkpoint folder, of which later plans read the columns and rows they need.

    by: one folder for each of its values. The shuffle files of the write go when it ends, so disk holds those of one step at a time."""
    spark = df.sparkSession
    path, before = f"{checkpoint_folder(spark)}/{uuid.uuid4().hex}", spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        out = df.write.options(**PAGES)
        (out.partitionBy(by) if by else out).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    out = spark.read.schema(df.schema).parquet(path)
    out.folder_ = path
    return out


@contextmanager
def held(df: DataFrame) -> Iterator[DataFrame]:
    """df, stored for the time of the block: nothing lazy may read it later."""
    table = stored(df)
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(table.folder_)
    try:
        yield table
    finally:
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def parquet_path(path: str) -> str:
    """The path with the suffix .parquet, whatever suffix it had."""
    stem, dot, suffix = path.rpartition(".")
    return f"{stem if dot and '/' not in suffix else path}.parquet"


def write_parquet(df: DataFrame, path: str, partitions: int | None = None) -> str:
    path = parquet_path(path)
    (df.repartition(partitions) if partitions else df).write.mode("overwrite").parquet(path)
    return path


def write_csv(df: DataFrame, path: str, encoding: str | None = "utf-8-sig", one: bool = True) -> None:
    """CSV with a header; under `utf-8-sig` the first column's name carries the byte order mark that spreadsheets look for.

    one: a single file, for reports; else as many as there are partitions, each with a header."""
    encoding = (encoding or "utf-8-sig").lower()
    if encoding == "utf-8-sig" and df.columns:
        df = df.withColumnRenamed(df.columns[0], "﻿" + df.columns[0])
    charset = "UTF-8" if encoding.startswith("utf-8") else encoding.upper()
    if charset in ("GBK", "GB18030"):
        df.sparkSession.conf.set(CHARSETS, "true")
    (df.coalesce(1) if one else df).write.mode("overwrite").csv(path, header=True, encoding=charset)


def write_json(values: dict, path: str) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(values, ensure_ascii=False, indent=2, default=str) + "\n", "utf-8")


def write_trips(found: DataFrame, path: str) -> str:
    """Trips as one nested table; parallel lists of other formats are its array columns, n_points their lengths."""
    return write_parquet(found, path)


def write_gml(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """The graph as GML text lines; for exchange with graph tools."""
    quote = lambda c: F.concat(F.lit('"'), F.regexp_replace(F.regexp_replace(c, "&", "&amp;"), '"', "&quot;"), F.lit('"'))
    n = nodes.select(F.lit(1).alias("part"), F.concat(F.lit("  node [ id "), F.xxhash64("name"), F.lit(" label "), quote(F.col("name")), F.lit(" ]")).alias("value"))
    e = edges.select(F.lit(2).alias("part"), F.concat(F.lit("  edge [ source "), F.xxhash64("start_node"), F.lit(" target "), F.xxhash64("end_node"), F.lit(" length "), F.col("road_length"), F.lit(" kind "), F.col("kind"), F.lit(" duration "), F.col("duration"), F.lit(" ]")).alias("value"))
    ends = nodes.sparkSession.createDataFrame([(0, "graph [\n  directed 1"), (3, "]")], "part int, value string")
    ends.unionByName(n).unionByName(e).sort("part").select("value").coalesce(1).write.mode("overwrite").text(path)


def signature(spark: SparkSession, path: str, **settings) -> dict:
    """What a cached result depends on: the input's name, size and time, the settings, and the logic's version."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {"path": path, "size": fs.getContentSummary(p).getLength(), "modified": fs.getFileStatus(p).getModificationTime(), "logic_version": LOGIC_VERSION, **settings}


def cached(spark: SparkSession, path: str, key: dict, make, rebuild: bool = False) -> DataFrame:
    """The table at path, if it was made with the same key; else made and written. The key is a row of its own table beside it."""
    from tollway.sources.tables import exists

    note, want = path + ".key", json.dumps(key, sort_keys=True)
    if not rebuild and exists(spark, path) and exists(spark, note):
        found = spark.read.text(note, wholetext=True).first()
        if found is not None and found[0].strip() == want:
            return spark.read.parquet(path)
    make().write.mode("overwrite").parquet(path)
    spark.createDataFrame([(want,)], "value string").coalesce(1).write.mode("overwrite").text(note)
    return spark.read.parquet(path)
