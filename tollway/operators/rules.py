"""Inclusion rules: class, fuel and plate prefix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollway.config import Rules
from tollway.functions import exprs as E
from tollway.operators.clean import KEY, keep_first, require, with_sequence


def tests(r: Rules) -> dict[str, Column]:
    return {
        "CLLX": E.one_of(F.col("CLLX"), r.valid_vehicle_types),
        "RLLX": E.one_of(F.col("RLLX"), r.valid_fuel_types),
        "FZJG": E.one_of(F.col("FZJG"), r.local_plate_prefixes),
    }


def included(df: DataFrame, r: Rules) -> DataFrame:
    t = tests(r)
    return df.where(t["CLLX"] & t["RLLX"] & t["FZJG"])


def excluded(df: DataFrame, r: Rules) -> DataFrame:
    """The complement, with a flag for each rule that failed and the flags' names."""
    t = tests(r)
    names = {"CLLX": "excluded_by_cllx", "RLLX": "excluded_by_rllx", "FZJG": "excluded_by_fzjg"}
    flags = df.withColumns({names[k]: ~ok for k, ok in t.items()})
    flags = flags.where(F.col("excluded_by_cllx") | F.col("excluded_by_rllx") | F.col("excluded_by_fzjg"))
    return flags.withColumn("excluded_reason", F.concat_ws("|", *[F.when(F.col(flag), F.lit(k)) for k, flag in names.items()]))


def valid_records(df: DataFrame, r: Rules) -> DataFrame:
    """Rules first, dedup after: where a key has an included and an excluded record, the included one stays."""
    require(df, (*KEY, "CLLX", "RLLX", "FZJG"))
    x = included(with_sequence(df), r).withColumns({"GCRQ": E.date_part(E.as_text(F.col("GCRQ"))), "GCSJ": E.parse_time_strict(F.col("GCSJ"))})
    return keep_first(x, KEY)
