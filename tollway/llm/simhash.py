"""SimHash near-dedup by a binary trie self-join.

Fingerprints that differ in few bits are found by walking a trie of all distinct fingerprints in node pairs: a pair
adds up the bits in which its two paths differ and is dropped once they exceed the budget. The top of the trie is
walked by Spark: every node at depth `bits` meets the nodes whose prefixes are within the budget, and each such
pair is a task. Nodes with many fingerprints are cut into chunks, so a pair of nodes is several tasks. A task
walks on, level by level, on sorted arrays, and returns a spanning forest of the links it has found, as many rows
as fingerprints at most. Components come from alternating star contractions, each written to the shared folder.

Null and blank texts have fingerprint 0 and are linked like any other. Null doc_ids never name a component unless
it has no other. Equal rows get equal results, one each. Extra columns are not read by ``link`` and kept by
``keep_one``."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollway.llm import exchange, rolling
from tollway.llm.common import partitions, released, step, written

SHINGLE = 3
BITS = 2
SEED = 42
#: For documents that share 0.8 of their five-word shingles: fingerprints of them, bits that may differ for the trie to propose a pair, and that share.
NEAR = {"shingle": 5, "budget": 2, "share": 0.8}
#: Fingerprints of a node that one task takes; and pairs that are compared at once without walking on.
CHUNK = 4096
LEAF = 64
#: Node pairs that are walked at once, and hashes whose bits are counted at once.
PAIRS = 1 << 15
HASHES = 1 << 17
PRINTS = pa.schema([("doc_id", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("fp", pa.int64())])
LARGEST = exchange.LARGEST


class Shingles(NamedTuple):
    """Shingles of texts; a text of fewer words is one."""

    #: lower-cased words, each followed by one space; where each begins and ends
    words: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    #: first and last word of each shingle
    left: np.ndarray
    right: np.ndarray
    #: shingles of each text, and its first word (one more at the end)
    many: np.ndarray
    first: np.ndarray


def shingles_of(column: pa.Array, shingle: int) -> Shingles:
    data, at = rolling.texts(column)
    data = rolling.TO_LOWER[data]
    start, end, first = rolling.words(data, at, ~rolling.IS_BLANK)
    size = end - start
    own = np.full(int(size.sum()) + len(size), 32, np.uint8)
    begin = np.cumsum(size + 1) - size - 1
    own[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())] = data[~rolling.IS_BLANK[data]]
    n = np.diff(first)
    many = np.maximum(n - shingle + 1, (n > 0).astype(n.dtype))
    left = np.repeat(first[:-1] - (np.cumsum(many) - many), many) + np.arange(many.sum())
    right = np.minimum(left + shingle, np.repeat(first[1:], many)) - 1
    return Shingles(own, begin, begin + size, left, right, many, first)


def digests(x: Shingles) -> np.ndarray:
    """XXH64 of each shingle."""
    text, digest = x.words.tobytes(), xxhash.xxh64_intdigest
    return np.fromiter((digest(text[a:b], SEED) for a, b in zip(x.begin[x.left].tolist(), x.end[x.right].tolist(), strict=True)), np.uint64, len(x.left))


def rolled(x: Shingles) -> np.ndarray:
    """A rolling hash of each shingle: quick, but not for texts made to collide."""
    return rolling.stretch(rolling.prefix(rolling.word_hashes(x.words, x.begin, x.end)), x.left, x.right + 1)


def hashes_of(column: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of texts, and how many each text has."""
    found = shingles_of(column, shingle)
    return digests(found), found.many


def fingerprints_of(column: pa.Array, shingle: int) -> np.ndarray:
    """64-bit fingerprints of texts: a bit is 1 if it is 1 in over half of the shingles' hashes."""
    return majorities(*hashes_of(column, shingle))


def majorities(h: np.ndarray, many: np.ndarray) -> np.ndarray:
    ones = np.zeros((len(many), 64), np.int64)
    end = np.cumsum(many)
    for k in range(0, len(h), HASHES):
        bit = np.unpackbits(h[k : k + HASHES].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own = np.arange(np.searchsorted(end, k, "right"), np.searchsorted(end, k + len(bit) - 1, "right") + 1)
        own = own[many[own] > 0]
        ones[own] += np.add.reduceat(bit, np.maximum((end - many)[own] - k, 0), axis=0, dtype=np.int64)
    return np.packbits(2 * ones > many[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, k1, k2 and fp of each document."""

    def prints(batches):
        for batch in rolling.chunks(batches, "text"):
            fp = fingerprints_of(batch.column("text"), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "k1", "k2")), pa.array(fp)], schema=PRINTS)

    return exchange.keyed(docs).mapInArrow(released(prints), "doc_id long, k1 long, k2 long, fp long")


def _expand(a0, a1, b0, b1):
    """All index pairs of the ranges."""
    na, nb = a1 - a0, b1 - b0
    n = na * nb
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    nb_ = np.repeat(nb, n)
    return np.repeat(a0, n) + k // nb_, np.repeat(b0, n) + k % nb_


def walk(a: np.ndarray, b: np.ndarray, depth: int, budget: int, block: int = 64, first: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Batches of index pairs of sorted fingerprints a and b that differ in `budget` bits or fewer, and in `first` of their first
    `block` bits; those of a share their first `depth` bits, and so do those of b."""
    first = budget if first is None else first
    mask = np.uint64(((1 << depth) - 1) << (64 - depth))
    pa_, pb = a[:1] & mask, b[:1] & mask
    zero = np.zeros(1, np.int64)
    # levels with their node pairs: ranges in a and b, both prefixes, bits spent; taken depth first, so that few are held
    stack = [(depth, (zero, zero + len(a), zero, zero + len(b), pa_, pb, np.bitwise_count(pa_ ^ pb).astype(np.int64)))]
    while stack:
        level, (a0, a1, b0, b1, pa_, pb, spent) = stack.pop()
        leaf = (a1 - a0) * (b1 - b0) <= LEAF
        i, j = _expand(a0[leaf], a1[leaf], b0[leaf], b1[leaf])
        near = np.bitwise_count(a[i] ^ b[j]) <= budget  # a leaf may find links that the first block rules out: they are links
        if near.any():
            yield i[near], j[near]
        if leaf.all():
            continue
        a0, a1, b0, b1, pa_, pb, spent = (x[~leaf] for x in (a0, a1, b0, b1, pa_, pb, spent))
        bit = np.uint64(1 << (63 - level))
        am, bm = np.searchsorted(a, pa_ | bit), np.searchsorted(b, pb | bit)
        parts = [(a0, am, b0, bm, pa_, pb, spent), (am, a1, bm, b1, pa_ | bit, pb | bit, spent), (a0, am, bm, b1, pa_, pb | bit, spent + 1), (am, a1, b0, bm, pa_ | bit, pb, spent + 1)]
        a0, a1, b0, b1, pa_, pb, spent = (np.concatenate(x) for x in zip(*parts, strict=True))
        alive = np.flatnonzero((spent <= (first if level < block else budget)) & (a1 > a0) & (b1 > b0))
        for k in range(0, len(alive), PAIRS):
            some = alive[k : k + PAIRS]
            stack.append((level + 1, tuple(x[some] for x in (a0, a1, b0, b1, pa_, pb, spent))))


def roots(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The smallest node of each node's component, of nodes 0 to n - 1 with edges u, v."""
    top = np.arange(n)
    while len(u):
        low = np.minimum(top[u], top[v])
        np.minimum.at(top, top[u], low)
        np.minimum.at(top, top[v], low)
        while (top != top[top]).any():
            top = top[top]
        open_ = top[u] != top[v]
        u, v = u[open_], v[open_]
    return top


def turned(fp: np.ndarray, by: int) -> np.ndarray:
    """Fingerprints with their bits turned to the left."""
    return fp if by % 64 == 0 else (fp << np.uint64(by % 64)) | (fp >> np.uint64(64 - by % 64))


def _links(depth: int, budget: int, block: int, first: int):
    def links(batches):
        for batch in batches:
            for turn, one, two in zip(batch.column("turn").to_pylist(), batch.column("one"), batch.column("two"), strict=True):
                a, b = (np.sort(turned(x.values.to_numpy().view(np.uint64), turn)) for x in (one, two))
                both = np.unique(np.concatenate([a, b]))
                in_a, in_b = np.searchsorted(both, a), np.searchsorted(both, b)
                top, far = np.arange(len(both)), np.zeros(0, np.int64)
                for i, j in walk(a, b, depth, budget, block, first):
                    u, v = in_a[i], in_b[j]
                    new = top[u] != top[v]
                    if new.any():  # the forest so far and what it lacks
                        top = roots(len(both), np.r_[far, u[new]], np.r_[top[far], v[new]])
                        far = np.flatnonzero(top != np.arange(len(both)))
                if len(far):
                    u, v = turned(both[far], 64 - turn), turned(both[top[far]], 64 - turn)
                    yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

    return links


def links(prints: DataFrame, budget: int = BITS, chunk: int = CHUNK, blocks: int = 1) -> DataFrame:
    """(u, v): edges that connect whatever distinct fingerprints are linked, through others or not.

    A large budget would leave the top of the trie unpruned. Then the bits are cut into `blocks`: of `budget` errors,
    one block has budget // blocks at most, so a trie for each block, with its bits on top and that smaller budget
    for them, finds every link."""
    block, first = 64 // blocks, budget // blocks
    own = written(prints.select("fp").distinct(), "prints")
    n = own.count()
    depth = min(block, max(1, (n // (chunk // 4)).bit_length()))
    masks = [sum(1 << i for i in c) for k in range(first + 1) for c in combinations(range(depth), k)]
    # the small table may lie in one file: it is dealt out before it is multiplied
    own = own.repartition(partitions(own.sparkSession)).withColumn("turn", F.explode(F.array(*[F.lit(block * i) for i in range(blocks)])))
    top = F.expr("if(turn = 0, fp, shiftleft(fp, turn) | shiftrightunsigned(fp, 64 - turn))")
    own = own.withColumn("node", F.shiftrightunsigned(top, 64 - depth))
    cuts = own.groupBy("turn", "node").agg(F.ceil(F.count("*") / chunk).cast("int").alias("cuts"))
    # as many nodes as 2^depth for each block, that is about 4 n / chunk
    cuts = written(cuts, "nodes")
    mine = own.join(cuts, ["turn", "node"]).withColumn("cut", F.pmod(F.xxhash64("fp"), "cuts").cast("int")).drop("cuts")
    mine = mine.withColumn("mask", F.explode(F.array(*[F.lit(m).cast("long") for m in masks]))).withColumn("other", F.col("node").bitwiseXOR(F.col("mask")))
    pair = mine.join(cuts.select("turn", F.col("node").alias("other"), "cuts"), ["turn", "other"])
    pair = pair.withColumn("far", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    same, low = F.col("node") == F.col("other"), F.col("node") < F.col("other")
    flip = F.when(same, F.col("cut") > F.col("far")).otherwise(~low)
    key = [F.least("node", "other").alias("p"), F.greatest("node", "other").alias("q"), F.when(flip, F.col("far")).otherwise(F.col("cut")).alias("i"), F.when(flip, F.col("cut")).otherwise(F.col("far")).alias("j")]
    alone = same & (F.col("cut") == F.col("far"))
    side = pair.select("fp", "turn", *key, flip.alias("flip"), alone.alias("alone"))
    task = side.groupBy("turn", "p", "q", "i", "j").agg(F.collect_list(F.when(~F.col("flip") | F.col("alone"), F.col("fp"))).alias("one"), F.collect_list(F.when(F.col("flip") | F.col("alone"), F.col("fp"))).alias("two"))
    task = task.where((F.size("one") > 0) & (F.size("two") > 0)).select("turn", "one", "two")
    return task.mapInArrow(released(_links(depth, budget, block, first)), "u long, v long")


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _contracted(edges: DataFrame) -> DataFrame:
    """One round: large stars, then small stars.

    The smallest neighbours are written on their own, so that a node with very many neighbours is a skewed join that
    Spark can split."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = written(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "low")
    large = written(_ends(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))), "large")
    low = written(large.groupBy("u").agg(F.min("v").alias("m")), "low")
    small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
    return written(_ends(small), "edges")


def _ends(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v): v is the smallest node of u's component; nodes that are the smallest have no row.

    Large stars and small stars in turn, until nothing changes. Each round is written and what came before it goes."""
    spark = edges.sparkSession
    with step(spark) as keep_all:
        edges = written(_ends(edges), "edges")
        before = _mark(edges)
        while True:
            with step(spark) as keep:
                edges = keep(_contracted(edges))
            after = _mark(edges)
            if after == before:
                return keep_all(edges)
            before = after


def grouped(docs: DataFrame, shingle: int = SHINGLE, budget: int = BITS, blocks: int = 1) -> DataFrame:
    """doc_id, k1, k2, fp, component_id and component (its smallest fingerprint) of each document."""
    prints = written(fingerprints(docs, shingle), "documents")
    with step(docs.sparkSession) as keep:
        own = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "own")
        stars = components(links(own, budget, blocks=blocks))
        top = own.join(stars.withColumnRenamed("u", "fp"), "fp", "left").select("fp", F.coalesce("v", "fp").alias("component"), "least")
        top = written(top, "top")
        names = written(top.groupBy("component").agg(F.min("least").alias("component_id")), "names")
        named = keep(written(top.select("fp", "component").join(names, "component"), "named"))
    return prints.join(named, "fp")


def link(docs: DataFrame, shingle: int = SHINGLE, budget: int = BITS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id that links reach)."""
    return grouped(docs, shingle, budget).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, budget: int = BITS, blocks: int = 1, share: float | None = None) -> DataFrame:
    """One document of each component, that of the smallest doc_id (null ids last), with its own columns.

    With a share, the links are the pairs whose shingle sets have that share in common (see ``overlaps``)."""
    from tollway.llm import overlaps

    with step(docs.sparkSession) as keep:
        own = grouped(docs, shingle, budget, blocks) if share is None else overlaps.grouped(docs, shingle, budget, share)
        rows = own.select(F.coalesce("doc_id", F.lit(LARGEST)).alias("id"), "k1", "k2", "component")
        best = rows.groupBy("component").agg(F.min(F.struct("id", "k1", "k2")).alias("best")).select("best.*")
        best = keep(written(best, "best"))
        same = rows.groupBy("id", "k1", "k2").count().where("count > 1").limit(1).count() > 0
    k1, k2 = exchange.row_key(F.col("text"))
    row = docs.select(F.struct("*").alias("_row"), F.coalesce("doc_id", F.lit(LARGEST)).alias("id"), k1.alias("k1"), k2.alias("k2"))
    kept = row.join(best, ["id", "k1", "k2"], "left_semi")
    if same:
        kept = kept.groupBy("id", "k1", "k2").agg(F.first("_row").alias("_row"))
    return kept.select("_row.*")
