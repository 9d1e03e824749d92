"""Streaming forms, fed from files."""

import datetime as dt

from tollway.config import Segmentation
from tollway.streaming import passes as P

T0 = dt.datetime(2022, 6, 18, 7, tzinfo=dt.UTC)
SCHEMA = "CLTMBH string, KKBH string, GCRQ string, GCSJ timestamp, seq long"


def feed(spark, path, rows):
    data = [(v, k, "2022-06-18", T0 + dt.timedelta(seconds=s), i) for i, (v, k, s) in enumerate(rows)]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def drained(df, name, tmp_path):
    q = df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / f"c_{name}")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return df.sparkSession.table(name).collect()


def test_dedup(spark, tmp_path):
    path = str(tmp_path / "in")
    feed(spark, path, [("v", "A", 0), ("v", "B", 0), ("v", "A", 60), ("w", "A", 0)])
    feed(spark, path, [("v", "C", 0), ("v", "A", 120)])
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
    got = drained(P.dedup(stream), "dedup", tmp_path)
    assert sorted((r.CLTMBH, int(r.GCSJ.replace(tzinfo=None).timestamp())) for r in got) == sorted({(r.CLTMBH, int(r.GCSJ.replace(tzinfo=None).timestamp())) for r in got})
    assert len(got) == 4


def test_trips(spark, tmp_path):
    path = str(tmp_path / "in")
    feed(spark, path, [("v", "A", 0), ("v", "B", 200), ("v", "C", 400), ("w", "A", 0)])
    feed(spark, path, [("v", "A", 5000), ("v", "B", 5100), ("w", "B", 100)])
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
    got = drained(P.trips(stream, {("A", "B"): (1.0, 300.0)}, 600.0, Segmentation()), "trips", tmp_path)
    assert [(r.CLTMBH, r.checkpoints, r.travel) for r in got if r.CLTMBH == "v"][:1] == [("v", ["A", "B", "C"], 400.0)]
