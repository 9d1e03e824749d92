"""What the operators of this subpackage share: text columns, row keys, the shared folder."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollway.sources.sinks import PAGES

#: ASCII white space, as `[\x20\x09-\x0D]`.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(c: Column) -> Column:
    """A-Z in lower case, all else as it is. The quick built-in serves texts that are ASCII."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def blank_words(c: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` as an array; null and blank texts give an empty one."""
    trimmed = F.trim(F.coalesce(c, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))


def row_key(c: Column) -> list[Column]:
    """Two hashes that, with doc_id, tell different rows apart; rows equal in all have equal results."""
    return [F.xxhash64(c).alias("k1"), F.xxhash64(F.lit(1), c).alias("k2")]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share: spark.checkpoint.dir of the session.

    Where no such folder is set, one under the system's temporary folder serves a session on one machine (tests); on a
    cluster it is an error."""
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not top:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        top = f"file://{tempfile.gettempdir()}/checkpoints"
        spark.conf.set("spark.checkpoint.dir", top)
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Folders of the tables written in the steps that are under way, the innermost last.
_steps: ContextVar[tuple[set[str], ...]] = ContextVar("steps", default=())


@contextmanager
def step(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A step whose ``written`` tables go when it ends, but for those that are handed to the function it yields."""
    outer, mine, kept = _steps.get(), set(), set()
    token = _steps.set((*outer, mine))

    def keep(table: DataFrame) -> DataFrame:
        kept.add(table.folder_)
        return table

    try:
        yield keep
    finally:
        _steps.reset(token)
        if outer:
            outer[-1].update(kept)
        conf = spark._jsc.hadoopConfiguration()
        for folder in mine - kept:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


#: Settings that bound what is read and sent to a Python worker at once, and their values here and by default. Rows of packed hashes have some MB.
BATCHES = {"spark.sql.parquet.columnarReaderBatchSize": ("64", "4096"), "spark.sql.execution.arrow.maxRecordsPerBatch": ("1000", "10000"), "spark.sql.execution.arrow.maxBytesPerBatch": (str(4 << 20), "67108864")}


def small_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches in the session by rows and bytes, so that long texts don't pile up; a user's own settings stay."""
    for name, (value, default) in BATCHES.items():
        if spark.conf.get(name, default) in (default, "-1", f"{default}b"):
            spark.conf.set(name, value)


def trim() -> None:
    """Hands memory that this process has freed, but keeps for later, back to the system."""
    pa.default_memory_pool().release_unused()
    if give := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc has it
        give(0)


def released(f: Callable) -> Callable:
    """f over Arrow batches; its worker keeps nothing when the task ends, as idle workers count in an executor's memory."""

    def run(batches):
        try:
            yield from f(batches)
        finally:
            trim()

    return run


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: lineage ends here, and a lost executor costs no rerun.

    The shuffle files of the write go when it ends, so that disk holds those of one step at a time."""
    spark = df.sparkSession
    path, before = shared_folder(spark, name), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.options(**PAGES).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    for folders in _steps.get()[-1:]:
        folders.add(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.folder_ = path
    return out
