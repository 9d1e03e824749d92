"""Column expressions. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000


def strip(c: Column) -> Column:
    """Without white space at either end, line breaks and tabs included."""
    return F.regexp_replace(c, "(?U)^\\s+|\\s+$", "")


def as_text(c: Column) -> Column:
    """Text of a value; a missing one reads `nan`, and so can be told apart from an empty one."""
    return F.coalesce(c.cast("string"), F.lit("nan"))


def prefix2(c: Column) -> Column:
    return F.substring(c, 1, 2)


def date_part(c: Column) -> Column:
    """What stands before the first space. Dates are compared as text."""
    return F.substring_index(c, " ", 1)


def parse_time(c: Column, formats: Sequence[str] = ()) -> Column:
    """Timestamp without zone; NULL if neither ISO nor one of the formats fits."""
    return F.coalesce(c.try_cast("timestamp_ntz"), *[F.try_to_timestamp(c, F.lit(f)).cast("timestamp_ntz") for f in formats])


def parse_time_strict(c: Column) -> Column:
    """As parse_time for ISO spellings, but raises on anything else."""
    return c.cast("timestamp_ntz")


def seconds_between(a: Column, b: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", a, b) / F.lit(float(MICROS))


def has_fraction(c: Column) -> Column:
    return F.date_format(c, "SSSSSS") != "000000"


def mapped(c: Column, table: dict) -> Column:
    """The table's value; NULL for unknown keys."""
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[c]


def one_of(c: Column, values: Sequence) -> Column:
    """Membership without NULL: a missing value is not a member."""
    return F.coalesce(c.isin(list(values)), F.lit(False))


def pair_key(a: Column, b: Column) -> Column:
    return F.concat_ws("-", a, b)


def period(hour: Column, high: Sequence[int], flat: Sequence[int]) -> Column:
    return F.when(hour.isin(list(high)), "high").when(hour.isin(list(flat)), "flat").otherwise("low")


def maxspeed(c: Column) -> Column:
    """km/h of a speed tag: its first part, first number in it; 0 if there is none or it is negative."""
    text = F.trim(F.lower(c.cast("string")))
    number = text.try_cast("double")
    first = F.element_at(F.split(text, "[;,/|]"), 1)
    found = F.nullif(F.regexp_extract(first, "\\d+(\\.\\d+)?", 0), F.lit("")).try_cast("double")
    return F.when(number.isNotNull() & ~F.isnan(number), F.greatest(number, F.lit(0.0))).otherwise(F.coalesce(found, F.lit(0.0)))


def oneway(c: Column) -> Column:
    """F (along the line), T (against it) or B (both); B for all else."""
    x = F.upper(F.trim(c.cast("string")))
    return F.when(x.isin("F", "T", "B"), x).otherwise("B")


# Road classes by kind, and the kinds' names.
ROAD_KINDS = {
    "motorway": 1, "motorway_link": 1, "trunk": 2, "trunk_link": 2, "primary": 3, "primary_link": 3, "secondary": 4,
    "secondary_link": 4, "tertiary": 5, "tertiary_link": 5, "unclassified": 6, "residential": 6, "living_street": 7,
}
KIND_NAMES = {1: "高速公路", 2: "城市快速路", 3: "主干道", 4: "次干道", 5: "支路", 6: "一般道路", 7: "生活街区道路", 0: "未知"}


def road_kind(c: Column, kinds: dict[str, int] = ROAD_KINDS) -> Column:
    return F.coalesce(mapped(c, kinds), F.lit(0))


def speed(fclass: Column, limit: Column, t) -> Column:
    """km/h on a road: discounted limit if there is one, else the class's usual speed."""
    usual = F.when(fclass.isin("motorway", "motorway_link"), t.motorway_speed_kmh).when(fclass.isin("trunk", "trunk_link"), t.trunk_speed_kmh).otherwise(t.default_speed_kmh)
    return F.greatest(F.when(limit > 0, limit * t.maxspeed_discount).otherwise(usual), F.lit(t.min_speed_kmh))


def duration(length_m: Column, fclass: Column, limit: Column, t) -> Column:
    """Seconds along an edge."""
    return length_m / (speed(fclass, limit, t) / 3.6)


def truth(c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin("1", "true", "t", "yes", "y"), F.lit(False))


def no_leading_zeros(c: Column) -> Column:
    return F.ltrim(c, F.lit("0"))


def whole_number(c: Column) -> Column:
    return F.coalesce(c.try_cast("bigint"), F.lit(0).cast("bigint"))


def ratio(n: Column, d: Column) -> Column:
    """0 where there is nothing to divide by."""
    return F.when(d > 0, n / d).otherwise(F.lit(0.0))


def percent(c: Column) -> Column:
    return F.concat(F.format_number(c * 100, 2), F.lit("%"))


def nan_like(c: Column) -> Column:
    return c.isNull() | F.isnan(c)


def bucket(key: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n))


def uniform(seed: int, key: Column) -> Column:
    """A number in [0, 1) by seed and key; the same in any engine that has MD5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))


def bins(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the bin (edge, next edge]; NULL outside all."""
    out = None
    for low, high, label in zip(edges, edges[1:], labels, strict=False):
        test = (value > low) & (value <= high)
        out = F.when(test, label) if out is None else out.when(test, label)
    return out
