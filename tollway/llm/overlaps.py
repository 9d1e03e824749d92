"""Documents whose sets of shingles have a share in common (Jaccard): every such pair is found, and no other is linked.

Two sets with the share in common meet, in any one order of all shingles, within their first
n - ceil(share * n) + 1. The order is rarest first: shingles that occur once in the corpus (``exchange``), which have no
one to meet, then by counts in WIDTH cells that shingles are hashed to. A document with enough shingles of its own can
have no partner: it takes no further part and is not counted, so that only the first step reads the whole corpus in
Python. The counts decide the work, not the result.

Pairs are proposed in three ways and verified on the whole sets: by the fingerprints' trie; by a few leaders of each
crowded shingle, who meet all its others; and at last by all pairs of sets of different components that share a
shingle of their prefixes, each looked at where its least common shingle is, and kept if their prefixes allow the
share. A large group of near copies is one component after the first two, so that the third finds little left of it.
Crowded shingles are cut into chunks, so that no task takes more than two of them.

A set goes by a 64-bit hash of its shingles' hashes. Blank texts have the empty set, which is equal to itself only."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollway.llm import exchange, rolling, simhash
from tollway.llm.common import BLANKS, released, written

#: Bytes of a word and its blank, for the number of shingles to expect.
WORD_BYTES = 5
#: Cells of the counts (8 bytes each at the driver and in every task), and slices that they are summed in.
WIDTH, SLICES = 1 << 20, 64
#: A shingle that so many sets have is crowded: its LEADERS meet all others before any two meet.
CROWD, LEADERS = 16, 4
#: Sets of a shingle in one chunk; groups above SMALL are compared by bits; pairs that are compared at once.
CHUNK, SMALL, PAIRS = 2048, 24, 1 << 18
PRINTS = "doc_id long, k1 long, k2 long, fp long, own long, n int, prefix binary"


def sets_of(column: pa.Array, shingle: int) -> list[np.ndarray]:
    """Sorted hashes of the distinct shingles of each text."""
    h, many = simhash.hashes_of(column, shingle)
    return [np.unique(x) for x in np.split(h, np.cumsum(many)[:-1])]


def cells_of(x: simhash.Shingles) -> np.ndarray:
    """The cell that each shingle is counted in."""
    return (simhash.rolled(x) % np.uint64(WIDTH)).astype(np.int64)


def hasher(shingle: int) -> exchange.Hasher:
    def hashes(data, at, batch):
        x = simhash.shingles_of(batch.column("text"), shingle)
        return simhash.rolled(x), x.left, x.first

    return hashes


def name_of(own: np.ndarray) -> int:
    return int(np.array(xxhash.xxh64_intdigest(own.tobytes(), simhash.SEED), np.uint64).view(np.int64))


def needed(n: int, share: float) -> int:
    """Shingles that a set of n must have in common with another to reach the share."""
    return math.ceil(share * n - 1e-9)


def prefix_of(own: np.ndarray, weight: np.ndarray, share: float) -> np.ndarray:
    """Of the rarest shingles of a set, one of which stands in the prefix of any set that reaches the share with it, those that others may have.

    The order of all shingles is by weight, then by hash; a weight below zero says that no other set has it."""
    if not len(own):
        return own
    order = np.lexsort((own, weight))[: len(own) - needed(len(own), share) + 1]
    return own[order[weight[order] >= 0]]


def counted(docs: DataFrame, shingle: int) -> np.ndarray:
    """How many shingles of the documents each cell has."""
    width = WIDTH // SLICES

    def count(batches):
        total = np.zeros(WIDTH, np.int64)
        for batch in rolling.chunks(batches, "text"):
            total += np.bincount(cells_of(simhash.shingles_of(batch.column("text"), shingle)), minlength=WIDTH)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(SLICES)), pa.array([exchange.planes(total[i * width : (i + 1) * width]) for i in range(SLICES)], pa.binary())], names=["slice", "body"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, body in zip(batch.column("slice").to_pylist(), batch.column("body").to_pylist(), strict=True):
                total[i] = total.get(i, 0) + exchange.from_planes(body, np.int64)
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["slice", "body"])

    parts = docs.select("text").mapInArrow(released(count), "slice long, body binary").repartition("slice").mapInArrow(released(add), "slice long, body binary").collect()
    out = np.zeros(WIDTH, np.int64)
    for r in parts:
        out[r["slice"] * width : (r["slice"] + 1) * width] += np.frombuffer(r["body"], np.int64)
    return out


def likely(docs: DataFrame, shingle: int, share: float) -> DataFrame:
    """doc_id, k1, k2, text and hits (shingles that occur again) of the documents that may have a partner: at most 1 - share of their shingles are their own."""
    rows = exchange.keyed(docs)
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    again = exchange.repeats(rows, hasher(shingle), "again", n_bytes // WORD_BYTES)
    # repeated in one document: counted more than once here, so that none is missed
    many = F.greatest(F.col("size") - (shingle - 1), F.lit(1))
    some = again.where(F.col("n") >= F.ceil(F.lit(share) * many - 1e-9))
    return written(exchange.joined(rows, exchange.gathered(some), "inner"), "likely")


def prints(some: DataFrame, shingle: int, share: float) -> DataFrame:
    """doc_id, k1, k2, fp, own (the name of its set), n (its size) and prefix of each document that may have a partner."""
    counts = some.sparkSession.sparkContext.broadcast(counted(some, shingle))

    def each(batches):
        for batch in rolling.chunks(batches, "text"):
            x = simhash.shingles_of(batch.column("text"), shingle)
            common = np.zeros(int(x.first[-1]) + 1, bool)
            for first, hits in zip(x.first.tolist(), batch.column("hits").to_pylist(), strict=False):
                common[exchange.positions(hits) + first] = True
            h, weight, cut = simhash.digests(x), np.where(common[x.left], counts.value[cells_of(x)], -1), np.cumsum(x.many)[:-1]
            fp, own, prefix = simhash.majorities(h, x.many), [], []
            for mine, w in zip(np.split(h, cut), np.split(weight, cut), strict=True):
                mine, at = np.unique(mine, return_index=True)
                own.append(mine)
                prefix.append(prefix_of(mine, w[at], share).tobytes())
            more = [pa.array(fp.view(np.int64)), pa.array([name_of(x) for x in own], pa.int64()), pa.array([len(x) for x in own], pa.int32()), pa.array(prefix, pa.binary())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "k1", "k2")), *more], names=["doc_id", "k1", "k2", "fp", "own", "n", "prefix"])

    return some.mapInArrow(released(each), PRINTS)


def _flat(batches):
    """(h, own) of each shingle of the prefixes."""
    for batch in batches:
        h = [np.frombuffer(x, np.int64) for x in batch.column("prefix").to_pylist()]
        own = np.repeat(batch.column("own").to_numpy(), [len(x) for x in h])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(h) if h else np.zeros(0, np.int64)), pa.array(own)], names=["h", "own"])


def _pairs(a: np.ndarray, b: np.ndarray, names: tuple[str, str] = ("a", "b")) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=list(names))


def _led(share: float):
    """Pairs of a few sets of each crowded shingle, of its largest component first, with its sets of other components."""

    def led(batches):
        for run in exchange.sorted_runs(batches, ["h"]):
            if run.num_rows <= CROWD:
                continue
            own, n, top = (run.column(c).to_numpy() for c in ("own", "n", "top"))
            _, of, many = np.unique(top, return_inverse=True, return_counts=True)
            for i in np.lexsort((own, top, -many[of]))[:LEADERS]:
                far = (top != top[i]) & (np.minimum(n, n[i]) >= share * np.maximum(n, n[i]) - 1e-9)
                if far.any():
                    yield _pairs(np.full(int(far.sum()), own[i]), own[far])

    return led


def _enough(c, na, nb, share: float):
    """Whether sets whose prefixes share c shingles may have the share in common.

    Up to the end of the shorter prefix c are shared; beyond it, all that is left of that set at most."""
    left = np.maximum(np.ceil(share * na - 1e-9), np.ceil(share * nb - 1e-9)) - 1
    return c + left >= share / (1 + share) * (na + nb) - 1e-6


def _compared(prefix: list[np.ndarray], h: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs of prefixes: how many shingles they share, and whether h is the least of them."""
    if len(prefix) <= SMALL:
        sets = [set(x.tolist()) for x in prefix]
        both = [sets[x] & sets[y] for x, y in zip(i.tolist(), j.tolist(), strict=True)]
        return np.array([len(x) for x in both], np.int64), np.array([min(x) == h for x in both], bool)
    size = [len(x) for x in prefix]
    value, column, times = np.unique(np.concatenate(prefix), return_inverse=True, return_counts=True)
    use = times[column] > 1
    row, column = np.repeat(np.arange(len(prefix)), size)[use], (np.cumsum(times > 1) - 1)[column[use]]
    value = value[times > 1]
    bits = np.zeros((len(prefix), -(-len(value) // 64)), np.uint64)
    np.bitwise_or.at(bits, (row, column >> 6), np.uint64(1) << (column & 63).astype(np.uint64))
    k = int(np.searchsorted(value, h))
    word, below = k >> 6, np.uint64((1 << (k & 63)) - 1)
    c, least = np.zeros(len(i), np.int64), np.ones(len(i), bool)
    for x in range(bits.shape[1]):
        both = bits[i, x] & bits[j, x]
        c += np.bitwise_count(both)
        if x <= word:
            least &= (both if x < word else both & below) == 0
    return c, least


def _met(share: float):
    """The pairs of sets of different components that have h as the least common shingle of their prefixes and may have the share in common."""

    def met(batches):
        for run in exchange.sorted_runs(batches, ["h", "p", "q"]):
            h, p, q = (run.column(c)[0].as_py() for c in ("h", "p", "q"))
            own, n, top, cut = (run.column(c).to_numpy() for c in ("own", "n", "top", "cut"))
            prefix = [np.frombuffer(x, np.int64) for x in run.column("prefix").to_pylist()]
            if p == q:
                left, right = np.arange(len(own)), None
            else:
                left, right = np.flatnonzero(cut == p), np.flatnonzero(cut == q)
            step = max(1, PAIRS // max(1, len(own)))
            for k in range(0, len(left), step):
                some = left[k : k + step]
                if right is None:
                    i = np.repeat(some, len(own) - 1 - some)
                    j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(len(own) - 1 - some) - (len(own) - 1 - some), len(own) - 1 - some)
                else:
                    i, j = np.repeat(some, len(right)), np.tile(right, len(some))
                ok = (top[i] != top[j]) & (np.minimum(n[i], n[j]) >= share * np.maximum(n[i], n[j]) - 1e-9)
                i, j = i[ok], j[ok]
                if len(i):
                    c, least = _compared(prefix, h, i, j)
                    ok = least & _enough(c, n[i], n[j], share)
                    if ok.any():
                        yield _pairs(own[i[ok]], own[j[ok]])

    return met


PAIR = "a long, b long"


def bodies(rows: DataFrame, own: DataFrame, some: DataFrame, shingle: int) -> DataFrame:
    """(own, body): the whole set of each name in `own`, from one text of each."""
    key = ["id", "k1", "k2"]
    known = F.coalesce("doc_id", F.lit(exchange.LARGEST)).alias("id")
    one = rows.join(own.select("own"), "own", "left_semi").groupBy("own").agg(F.min(F.struct(known, "k1", "k2")).alias("r"))
    text = some.select(known, "k1", "k2", "text").join(one.select("own", "r.*"), key).select("own", "text")

    def sets(batches):
        for batch in rolling.chunks(batches, "text"):
            found = sets_of(batch.column("text"), shingle)
            yield pa.RecordBatch.from_arrays([batch.column("own"), pa.array([x.tobytes() for x in found], pa.binary())], names=["own", "body"])

    return written(text.mapInArrow(released(sets), "own long, body binary").dropDuplicates(["own"]), "sets")


def verified(pairs: DataFrame, body: DataFrame, share: float) -> DataFrame:
    """(u, v): the pairs (a, b) of sets that have the share in common."""

    def check(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= share * (len(x) + len(y) - both) - 1e-9)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(keep, pa.bool_())), batch.column("b").filter(pa.array(keep, pa.bool_()))], names=["u", "v"])

    full = pairs.join(body.select(F.col("own").alias("a"), F.col("body").alias("x")), "a").join(body.select(F.col("own").alias("b"), F.col("body").alias("y")), "b")
    return full.mapInArrow(released(check), "u long, v long")


def chunked(postings: DataFrame, own: DataFrame) -> DataFrame:
    """Postings (h, own, n, top) of shingles of several components, with their prefixes, once for each pair (p, q) of chunks that they are in."""
    cuts = postings.groupBy("h").agg(F.min("top").alias("low"), F.max("top").alias("high"), F.ceil(F.count("*") / CHUNK).cast("int").alias("cuts")).where("low <> high")
    cuts = written(cuts.select("h", "cuts"), "cuts")
    mine = postings.join(cuts, "h").withColumn("cut", F.pmod(F.xxhash64("own"), "cuts").cast("int"))
    mine = mine.join(own.select("own", "prefix"), "own").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    return mine.select("h", F.least("cut", "other").alias("p"), F.greatest("cut", "other").alias("q"), "own", "n", "top", "cut", "prefix")


def grouped(docs: DataFrame, shingle: int, budget: int, share: float) -> DataFrame:
    """doc_id, k1, k2 and component (the smallest name of its sets, or the document's own) of each document."""
    some = likely(docs, shingle, share)
    rows = written(prints(some, shingle, share), "documents")
    own = written(rows.where(F.octet_length("prefix") > 0).groupBy("own").agg(F.min("fp").alias("fp"), F.max("n").alias("n"), F.max("prefix").alias("prefix")), "own")
    body = bodies(rows, own, some, shingle)
    shared = own.mapInArrow(released(_flat), "h long, own long")
    several = shared.groupBy("h").count().where("count > 1").select("h")
    shared = written(shared.join(several, "h").join(own.select("own", "n"), "own").select("h", "own", "n"), "shared")
    # sets of one fingerprint, and fingerprints that the trie links
    first = written(own.groupBy("fp").agg(F.min("own").alias("first")), "first")
    trie = simhash.links(own.select("fp"), budget)
    far = trie.join(first.select(F.col("fp").alias("u"), F.col("first").alias("a")), "u").join(first.select(F.col("fp").alias("v"), F.col("first").alias("b")), "v").select("a", "b")
    same = own.join(first, "fp").where("own <> first").select(F.col("own").alias("a"), F.col("first").alias("b"))
    ends = lambda x: x.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    sure = written(verified(written(ends(far.unionByName(same)), "proposed"), body, share), "sure")
    stars = simhash.components(sure)
    postings = lambda: shared.join(stars.withColumnRenamed("u", "own"), "own", "left").select("h", "own", "n", F.coalesce("v", "own").alias("top"))
    asked = written(postings().repartition("h").sortWithinPartitions("h").mapInArrow(released(_led(share)), PAIR).distinct(), "led")
    stars = simhash.components(stars.unionByName(written(verified(asked, body, share), "found")))
    rest = chunked(postings(), own).repartition("h", "p", "q").sortWithinPartitions("h", "p", "q").mapInArrow(released(_met(share)), PAIR)
    more = written(verified(written(rest, "rest"), body, share), "more")
    stars = simhash.components(stars.unionByName(more))
    named = rows.select("own").distinct().join(stars.withColumnRenamed("u", "own"), "own", "left").select("own", F.coalesce("v", "own").alias("component"))
    # equal rows are one here: each is the other's partner
    named = rows.select("doc_id", "k1", "k2", "own").distinct().join(named, "own").select("doc_id", "k1", "k2", "component")
    named = written(named, "named")
    every = exchange.keyed(docs).select("doc_id", "k1", "k2", (F.trim(F.coalesce("text", F.lit("")), F.lit(BLANKS)) == "").alias("blank"))
    same = every["doc_id"].eqNullSafe(named["doc_id"]) & (every["k1"] == named["k1"]) & (every["k2"] == named["k2"])
    alone = F.when(every["blank"], F.lit(0).cast("long")).otherwise(F.xxhash64(every["k1"], every["k2"]))
    return every.join(named, same, "left").select(every["doc_id"], every["k1"], every["k2"], F.coalesce("component", alone).alias("component"))
