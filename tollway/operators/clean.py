"""Cleaning of pass records: required columns, normalisation, ordered dedup, cleaning profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tollway.functions import exprs as E

KEY = ("GCRQ", "GCSJ", "CLTMBH")
RAW = ("GCRQ", "GCSJ", "KKBH", "FZJG", "CLTMBH", "CLLX", "RLLX")


def require(df: DataFrame, columns: Sequence[str], what: str = "input") -> DataFrame:
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"{what} lacks the columns {', '.join(missing)}")
    return df


def with_sequence(df: DataFrame, name: str = "seq") -> DataFrame:
    """df with its input order, if it has none yet: taken at the scan, before any exchange."""
    return df if name in df.columns else df.withColumn(name, F.monotonically_increasing_id())


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = ("seq",)) -> DataFrame:
    """The first row of each key in the given order. Partial aggregation keeps one row for each key and task before the exchange."""
    rest = [c for c in df.columns if c not in keys]
    # one sortable struct: min_by on it is the first row
    rank = F.struct(*[(F.col(o) if isinstance(o, str) else o).alias(f"o{i}") for i, o in enumerate(order)])
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), rank).alias("_first"))
    return first.select(*keys, "_first.*").select(*df.columns)


def normalize_for_split(df: DataFrame, formats: Sequence[str] = ()) -> DataFrame:
    """Text columns stripped, class cut to two characters, date and time parsed, first record of each key kept.

    Missing texts read `nan`, as records without class or fuel are wanted later on. Times that do not parse go."""
    require(df, RAW)
    return keep_first(typed(df, formats), KEY)


def typed(df: DataFrame, formats: Sequence[str] = ()) -> DataFrame:
    x = with_sequence(df).withColumns(
        {c: E.strip(E.as_text(F.col(c))) for c in ("CLTMBH", "KKBH", "FZJG", "RLLX")}
        | {"CLLX": E.prefix2(E.strip(E.as_text(F.col("CLLX")))), "GCRQ": E.date_part(E.as_text(F.col("GCRQ"))), "GCSJ": E.parse_time(F.col("GCSJ"), formats)}
    )
    return x.where(F.col("GCSJ").isNotNull())


def normalize_for_partition(df: DataFrame, formats: Sequence[str] = ()) -> DataFrame:
    """The same for the four columns that segmentation needs; other columns pass."""
    require(df, ("GCRQ", "GCSJ", "KKBH", "CLTMBH"))
    x = with_sequence(df).withColumns(
        {c: E.strip(E.as_text(F.col(c))) for c in ("CLTMBH", "KKBH")}
        | {"GCRQ": E.date_part(E.as_text(F.col("GCRQ"))), "GCSJ": E.parse_time(F.col("GCSJ").cast("string"), formats)}
    )
    return keep_first(x.where(F.col("GCSJ").isNotNull()), KEY)


def center_filter(df: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Records with all key columns, at one of the checkpoints; class cut to two characters (a missing one reads `na`)."""
    require(df, RAW)
    x = df.dropna(subset=list(RAW[:5])).withColumns({"CLLX": E.prefix2(E.as_text(F.col("CLLX"))), "KKBH": E.strip(F.col("KKBH").cast("string"))})
    ids = checkpoints.select(E.strip(F.col("KKBH").cast("string")).alias("KKBH")).distinct()
    return x.join(ids, "KKBH", "left_semi").select(*df.columns)


def center_counts(df: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """(total_rows, matched_rows) of the center filter, in one pass."""
    x = df.dropna(subset=list(RAW[:5])).select(E.strip(F.col("KKBH").cast("string")).alias("KKBH"))
    ids = checkpoints.select(E.strip(F.col("KKBH").cast("string")).alias("KKBH"), F.lit(1).alias("hit")).distinct()
    return x.join(ids, "KKBH", "left").agg(F.count("*").alias("total_rows"), F.count("hit").alias("matched_rows"))


def key_groups(df: DataFrame) -> DataFrame:
    """Each key with its number of records, their distinct values (a missing one counts as a value), and whether they conflict.

    Sets of values, not several distinct counts: those would send each record once for each column."""
    others = ("KKBH", "FZJG", "CLLX", "RLLX")
    distinct = [(F.size(F.collect_set(c)) + F.max(F.col(c).isNull().cast("int"))).cast("long").alias(f"{c}_nunique") for c in others]
    out = df.groupBy(*KEY).agg(F.count("*").alias("group_size"), *distinct)
    return out.withColumn("has_conflict", F.greatest(*[f"{c}_nunique" for c in others]) > 1)


def conflict_groups(df: DataFrame) -> DataFrame:
    """Keys with several records."""
    return key_groups(df).where("group_size > 1")


def profile(df: DataFrame, formats: Sequence[str] = ()) -> DataFrame:
    """One row: what parsing and dedup remove, and how many duplicate keys conflict. Records are exchanged once."""
    before = df.agg(F.count("*").alias("before_dropna"), F.lit(1).alias("one"))
    clash = F.when(F.col("has_conflict") & (F.col("group_size") > 1), F.col("group_size"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0).cast("long"))
    after = key_groups(typed(df, formats)).agg(
        total(F.col("group_size")).alias("after_dropna"), F.count("*").alias("after_dedup"), F.count_if(F.col("group_size") > 1).alias("duplicate_group_count"),
        F.count(clash).alias("conflict_group_count"), total(clash).alias("conflict_row_count"), F.lit(1).alias("one"),
    )
    col = F.col
    return before.join(after, "one").select(
        "before_dropna", "after_dropna", (col("before_dropna") - col("after_dropna")).alias("dropna_removed"), "after_dedup",
        (col("after_dropna") - col("after_dedup")).alias("dedup_removed"), (col("before_dropna") - col("after_dedup")).alias("total_removed"),
        "duplicate_group_count", "conflict_group_count", "conflict_row_count",
    )


def duplicated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows whose key is not alone."""
    return df.withColumn("_n", F.count("*").over(W.partitionBy(*keys))).where("_n > 1").drop("_n")


def fraction_samples(df: DataFrame, k: int = 10) -> DataFrame:
    """Up to k times that are not whole seconds, in input order."""
    return with_sequence(df).where(E.has_fraction(F.col("GCSJ"))).orderBy("seq").limit(k).select("seq", "GCSJ")
