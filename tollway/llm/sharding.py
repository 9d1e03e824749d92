"""Sharding by histogram sort.

Every row has a 128-bit key: a hash of its id and text, then a number that tells equal rows apart. Splitters are
found by counting, over all partitions, the exact weight of each key cell that may hold one, and dividing those
cells until their weight meets the tolerance or they have one row. Then the rows are exchanged once. The driver holds
65,536 counts in the first round and 256 for each open splitter in later ones, whatever the number of rows.

Law `bytes`: shards are near equal in bytes; `rows`: near equal in rows. Null texts have no bytes and weigh
OVERHEAD. Equal rows may fall into different shards. An empty table gives no rows. Extra columns are kept."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tollway.llm.common import row_key, written

OVERHEAD = 16
#: Share of a shard by which a splitter may miss its target.
TOLERANCE = 0.002
#: Bits by which cells are divided in the first round and in those that follow.
FIRST, STEP = 16, 8
BITS = 128
#: Rows that are ordered in one task at most, on average.
CELL_ROWS = 500_000


def weigh(docs: DataFrame) -> DataFrame:
    """docs as `row`, with its size and key, in the shared folder."""
    k1, k2 = row_key(F.col("text"))
    size = (F.octet_length(F.coalesce(F.col("text"), F.lit(""))) + OVERHEAD).cast("long")
    return docs.select("row", size.alias("size"), F.xxhash64("doc_id", k1, k2).alias("hi"), F.xxhash64(F.monotonically_increasing_id()).alias("lo"))


def _cells(rows: DataFrame, depth: int, step: int, prefixes: list[int], weight: Column) -> dict[int, list[tuple[int, int, int]]]:
    """For each prefix of `depth` bits, its cells of `depth` + `step` bits, in order, with their weights and rows."""
    after, measured = depth + step, [F.sum(weight).alias("w"), F.count("*").alias("n")]
    if after <= 64:
        half = 1 << (depth - 1) if depth else 0
        kept = rows.where(F.shiftright("hi", 64 - depth).isin([p - half for p in prefixes])) if depth else rows
        got = kept.groupBy(F.shiftright("hi", 64 - after).alias("c")).agg(*measured).collect()
        found = [(r["c"] + (1 << (after - 1)), r["w"], r["n"]) for r in got]
    else:
        low = depth - 64
        mine = F.lit(False)
        for p in prefixes:
            here = F.col("hi") == F.lit((p >> low) - (1 << 63))
            mine = mine | (here & (F.shiftright("lo", 64 - low) == (p & ((1 << low) - 1)) - (1 << (low - 1))) if low else here)
        got = rows.where(mine).groupBy("hi", F.shiftright("lo", 64 - low - step).alias("c")).agg(*measured).collect()
        found = [((r["hi"] + (1 << 63) << low + step) + r["c"] + (1 << (low + step - 1)), r["w"], r["n"]) for r in got]
    out: dict[int, list[tuple[int, int, int]]] = {p: [] for p in prefixes}
    for c, w, n in sorted(found):
        out[c >> step].append((c, w, n))
    return out


@dataclass
class Probe:
    """A splitter: the weight that should lie below it, and the cell that it is in."""

    target: float
    below: int = 0
    cell: int = 0
    depth: int = 0
    weight: int = 0

    def key(self) -> int:
        up = self.below + self.weight - self.target < self.target - self.below
        return (self.cell + up) << (BITS - self.depth)


@dataclass
class Histogram:
    cuts: list[int]
    rows: int
    #: rows of the fullest cell of the first round
    fullest: int


def splitters(rows: DataFrame, shards: int, law: str = "bytes", tolerance: float = TOLERANCE) -> Histogram:
    """Keys at which shards 1 and on begin. A cell is divided no more when its weight meets the tolerance or it has one row."""
    weight = F.col("size") if law == "bytes" else F.lit(1)
    first = _cells(rows, 0, FIRST, [0], weight)[0]
    total = sum(w for _, w, _ in first)
    probes = [Probe(total * i / shards) for i in range(1, shards)]
    cells, open_, depth = {0: first}, probes, FIRST
    while open_:
        rest = []
        for s in open_:
            below = s.below
            for cell, w, n in cells[s.cell]:
                s.below, at, s.weight, many = below, cell, w, n
                if below + w > s.target:
                    break
                below += w
            if not cells[s.cell]:
                continue
            s.cell, s.depth = at, depth
            if s.weight > total / shards * tolerance and many > 1 and depth < BITS:
                rest.append(s)
        open_ = rest
        if open_:
            cells = _cells(rows, depth, STEP, sorted({s.cell for s in open_}), weight)
            depth += STEP
    return Histogram([s.key() for s in probes], sum(n for *_, n in first), max((n for *_, n in first), default=0))


def shard_of(cuts: list[int]) -> Column:
    """How many of the keys in cuts lie at or below the row's."""
    out = F.lit(0)
    for cut in cuts:
        if cut < 1 << BITS:
            hi, lo = (cut >> 64) - (1 << 63), (cut & ((1 << 64) - 1)) - (1 << 63)
            out = out + ((F.col("hi") > hi) | ((F.col("hi") == hi) & (F.col("lo") >= lo))).cast("int")
    return out


def place(rows: DataFrame, shards: int, law: str = "bytes", tolerance: float = TOLERANCE) -> DataFrame:
    """Weighed rows with shard and slot: `row`, size, shard, slot. Slots count from 0, without gaps.

    Rows of a shard are numbered in cells of its key range, and the cells' exact counts give where each begins. Equal
    rows share the first half of the key; where they fill a cell, it is cut by the other half, too."""
    rows = written(rows, "shards")
    found = splitters(rows, shards, law, tolerance)
    bits = min(FIRST, max(4, (max(found.rows // CELL_ROWS, 1) - 1).bit_length() + 3))
    more = (max(found.fullest // CELL_ROWS, 1) - 1).bit_length()
    fine = F.shiftright("lo", 64 - more) if more else F.lit(0).cast("long")
    rows = rows.withColumns({"shard": shard_of(found.cuts), "cell": F.shiftright("hi", 64 - bits), "fine": fine})
    before = W.partitionBy("shard").orderBy("cell", "fine").rowsBetween(W.unboundedPreceding, -1)
    cell = ["shard", "cell", "fine"]
    starts = rows.groupBy(*cell).count().select(*cell, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(W.partitionBy(*cell).orderBy("hi", "lo")) - 1
    return rows.withColumn("at", inside).join(starts, cell).select("row", "size", "shard", (F.col("start") + F.col("at")).alias("slot"))


def assign(docs: DataFrame, shards: int = 40, law: str = "bytes", tolerance: float = TOLERANCE) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard (null: this law has none)."""
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    rows = weigh(docs.select("doc_id", "text", F.struct("doc_id", crc.alias("text_crc32")).alias("row")))
    out = place(rows, shards, law, tolerance)
    return out.select("row.doc_id", "size", "row.text_crc32", F.lit(law).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def shard(docs: DataFrame, shards: int = 40, law: str = "bytes", tolerance: float = TOLERANCE) -> DataFrame:
    """The documents with all their columns, and `shard` and `slot` after them (columns of those names are replaced)."""
    keep = [c for c in docs.columns if c not in ("shard", "slot")]
    out = place(weigh(docs.select("doc_id", "text", F.struct(*keep).alias("row"))), shards, law, tolerance)
    return out.select("row.*", "shard", "slot")
