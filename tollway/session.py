"""Session defaults for local runs; a cluster passes its own settings."""

from __future__ import annotations

from pyspark import SparkConf
from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.legacy.javaCharsets": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = 8, partitions: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A session with the defaults above, local unless a master is set. ``conf`` overrides any of them."""
    builder = SparkSession.builder.appName("tollway")
    if not SparkConf().contains("spark.master"):  # spark-submit names a cluster and its sizes
        builder = builder.master(f"local[{cores}]").config("spark.driver.memory", memory)
    for key, value in (DEFAULTS | {"spark.sql.shuffle.partitions": str(partitions)} | conf).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
