"""Benchmark decontamination by a prefix-filtered set join.

Each window of an item is a set of word shingles. For exact containment one shingle is prefix enough, and the one
that is rarest in the corpus is taken. Documents probe with all their shingles; a hit fixes where the window would
have to stand (position bound) and whether it fits (length bound); then its words are compared.

Documents are read twice, whatever the size of the benchmark: once to count the benchmark's shingles in them, once to
send the words around every shingle that may be a prefix to the join with the windows. Both passes look shingles
up in a bitmap of at most MOST_BITS bits, which is all that is broadcast; what passes by chance falls out of the joins.

Null texts have no words. A null item_id reads "null". Equal documents get equal results, one each; items that repeat
count once. Extra columns are not read by ``match`` and kept by ``clean``."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollway.llm import exchange, rolling
from tollway.llm.common import row_key, step, written

WINDOW = 13
SHINGLE = 5
#: Bits of the bitmap: so many for each shingle, a power of two between these. Two of them are set for each, so that one in a thousand
#: others passes.
BITS_EACH, LEAST_BITS, MOST_BITS = 64, 1 << 16, 1 << 29
SHINGLES = pa.schema([("window", pa.binary()), ("item_id", pa.string()), ("words", pa.string()), ("size", pa.int32()), ("part", pa.int32()), ("shift", pa.int32()), ("h", pa.int64())])
PROBES = pa.schema([("doc_id", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("n_words", pa.int64()), ("h", pa.int64()), ("at", pa.int64()), ("lead", pa.int32()), ("around", pa.string())])
KEY = ["doc_id", "k1", "k2"]


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, start and end of each word, first word of each text."""
    data, at = rolling.texts(column)
    data = rolling.TO_LOWER[data]
    return data, *rolling.words(data, at, rolling.IS_LETTER)


def spaced(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words, each followed by one space, and where each begins and ends there."""
    size = end - start
    begin = np.cumsum(size + 1) - size - 1
    out = np.full(int(size.sum()) + len(size), 32, np.uint8)
    step = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
    out[step] = data[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())]
    return out.tobytes(), begin, begin + size


def shingles(items: DataFrame, window: int, shingle: int) -> DataFrame:
    """A row for each shingle of each window of each item: window (its name), item_id, words, size, part (words of the shingle), shift (its place), h.

    An item of fewer words than a window is one window, a window of fewer words than a shingle one shingle."""

    def each(batches):
        for batch in rolling.chunks(batches, "text"):
            data, start, end, first = tokens(batch.column("text"))
            s = rolling.prefix(rolling.word_hashes(data, start, end))
            text, begin, stop = spaced(data, start, end)
            n = np.diff(first)
            many = np.where(n > 0, np.maximum(n - window, 0) + 1, 0)
            doc = np.repeat(np.arange(len(n)), many)
            at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + first[doc]
            size = np.minimum(n[doc], window)
            words = [text[a:b] for a, b in zip(begin[at].tolist(), stop[at + size - 1].tolist(), strict=True)]
            name = [hashlib.blake2b(w, digest_size=16).digest() for w in words]
            part = np.minimum(size, shingle)
            k = size - part + 1
            of = np.repeat(np.arange(len(at)), k)
            shift = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
            h = rolling.stretch(s, at[of] + shift, at[of] + shift + part[of])
            of_ = pa.array(of)
            yield pa.RecordBatch.from_arrays([
                pa.array(name, pa.binary()).take(of_), batch.column("item_id").take(pa.array(doc)).take(of_), pa.array([w.decode() for w in words], pa.string()).take(of_),
                pa.array(size[of].astype(np.int32)), pa.array(part[of].astype(np.int32)), pa.array(shift.astype(np.int32)), pa.array(h.view(np.int64)),
            ], schema=SHINGLES)

    return items.mapInArrow(each, "window binary, item_id string, words string, size int, part int, shift int, h long")


class Sieve:
    """Which hashes may be in a table of (part, h): a bitmap, and the sizes of its shingles."""

    def __init__(self, table: DataFrame):
        spark = table.sparkSession
        self.parts = sorted(r["part"] for r in table.select("part").distinct().collect())
        n = table.count()
        self.bits = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_EACH * n).bit_length()))
        place = F.explode(F.array(F.pmod("h", F.lit(self.bits)), F.pmod(F.shiftright("h", 32), F.lit(self.bits)))).alias("p")
        word = table.select(place).select(F.shiftright("p", 6).alias("i"), F.expr("shiftleft(1L, cast(p & 63 as int))").alias("b")).groupBy("i").agg(F.bit_or("b").alias("b")).toArrow()
        bitmap = np.zeros(self.bits >> 6, np.int64)
        bitmap[word.column("i").to_numpy()] = word.column("b").to_numpy()
        self.sent = spark.sparkContext.broadcast(bitmap.view(np.uint8))

    def passes(self, h: np.ndarray) -> np.ndarray:
        bitmap = self.sent.value
        out = np.ones(len(h), bool)
        for half in (h, (h.view(np.int64) >> 32).view(np.uint64)):
            place = half & np.uint64(self.bits - 1)
            out &= (bitmap[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0
        return out


def _count(sieve: Sieve):
    parts, passes = sieve.parts, sieve.passes

    def count(batches):
        for batch in rolling.chunks(batches, "text"):
            data, start, end, first = tokens(batch.column("text"))
            s = rolling.prefix(rolling.word_hashes(data, start, end))
            for part in parts:
                pos = rolling.windows(first, part)
                h = rolling.stretch(s, pos, pos + part)
                h, n = np.unique(h[passes(h)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], names=["h", "n"])

    return count


def _probe(sieve: Sieve, window: int):
    parts, passes = sieve.parts, sieve.passes

    def probe(batches):
        for batch in rolling.chunks(batches, "text"):
            data, start, end, first = tokens(batch.column("text"))
            s = rolling.prefix(rolling.word_hashes(data, start, end))
            text, begin, stop = spaced(data, start, end)
            n = np.diff(first)
            keys = [batch.column(c) for c in KEY]
            none = [pa.nulls(len(n), f.type) for f in PROBES][4:]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(n.astype(np.int64)), *none], schema=PROBES)
            for part in parts:
                pos = rolling.windows(first, part)
                h = rolling.stretch(s, pos, pos + part)
                some = passes(h)
                pos, h = pos[some], h[some]
                if not len(pos):
                    continue
                doc = np.searchsorted(first, pos, "right") - 1
                # a window that has the shingle lies within these words
                low, high = np.maximum(pos - (window - part), first[doc]), np.minimum(pos + window, first[doc + 1])
                around = pa.array([text[a:b].decode() for a, b in zip(begin[low].tolist(), stop[high - 1].tolist(), strict=True)], pa.string())
                where = pa.array(doc)
                yield pa.RecordBatch.from_arrays([*(k.take(where) for k in keys), pa.nulls(len(pos), pa.int64()), pa.array(h.view(np.int64)), pa.array(pos - first[doc]), pa.array((pos - low).astype(np.int32)), around], schema=PROBES)

    return probe


def _sum(batches):
    for batch in batches:
        n_hit, digest, n_items = [], [], []
        for spans, items in zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist(), strict=True):
            last = n = 0
            for x in sorted(spans or (), key=lambda x: x["at"]):
                n += max(0, x["at"] + x["size"] - max(x["at"], last))
                last = max(last, x["at"] + x["size"])
            n_hit.append(n)
            n_items.append(len(items or ()))
            digest.append(hashlib.sha256(",".join(sorted(items or ())).encode()).hexdigest())
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (*KEY, "n_words")), pa.array(n_hit, pa.int64()), pa.array(n_items, pa.int64()), pa.array(digest, pa.string())], names=[*KEY, "n_words", "n_hit", "n_items", "items_sha256"])


def _contained() -> Column:
    """The window's words stand at their place among the words around."""
    begin = F.col("lead") - F.col("shift")
    return (begin >= 0) & (F.array_join(F.slice(F.split("around", " "), F.greatest(begin, F.lit(0)) + 1, F.col("size")), " ") == F.col("words"))


def prefixes(rows: DataFrame, every: DataFrame) -> DataFrame:
    """(window, part, shift, h): the shingle of each window that is rarest in the corpus, the first of equals."""
    table = written(every.select("part", "h").distinct(), "shingles")
    counts = rows.select("text").mapInArrow(_count(Sieve(table)), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    counts = written(counts, "counts")
    known = every.select("window", "part", "shift", "h").distinct().join(counts, "h", "left")
    best = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shift", "part", "h")).alias("x")
    return written(known.groupBy("window").agg(best).select("window", "x.part", "x.shift", "x.h"), "prefixes")


def _matched(docs: DataFrame, benchmark: DataFrame, window: int, shingle: int) -> DataFrame:
    rows = exchange.keyed(docs)
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    same = lambda a, b: a["doc_id"].eqNullSafe(b["_doc_id"]) & (a["k1"] == b["_k1"]) & (a["k2"] == b["_k2"])
    with step(docs.sparkSession) as keep:
        every = written(shingles(items, window, shingle), "windows")
        picked = prefixes(rows, every)
        probes = written(rows.mapInArrow(_probe(Sieve(picked), window), "doc_id long, k1 long, k2 long, n_words long, h long, at long, lead int, around string"), "probes")
        target = picked.join(every.select("window", "words", "size").distinct(), "window")
        found = probes.where("h is not null").join(target, "h").where(_contained())
        found = written(found.select(*KEY, (F.col("at") - F.col("shift")).alias("at"), "size", "window").distinct(), "found")
        named = found.join(every.select("window", "item_id").distinct(), "window")
        hits = named.groupBy(*KEY).agg(F.collect_set("item_id").alias("items")).withColumnsRenamed({c: f"_{c}" for c in KEY})
        spans = found.groupBy(*KEY).agg(F.collect_set(F.struct("at", "size")).alias("spans"))
        hits = keep(written(spans.join(hits, same(spans, hits)).select("_doc_id", "_k1", "_k2", "spans", "items"), "hits"))
        own = keep(written(probes.where("n_words is not null").select(*KEY, "n_words"), "words"))
    out = own.join(hits, same(own, hits), "left").select(*KEY, "n_words", "spans", "items")
    out = out.mapInArrow(_sum, "doc_id long, k1 long, k2 long, n_words long, n_hit long, n_items long, items_sha256 string")
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def match(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return _matched(docs, benchmark, window, shingle).drop("k1", "k2")


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    with step(docs.sparkSession) as keep:
        bad = _matched(docs, benchmark, window, shingle).where("contaminated").select(F.col("doc_id").alias("_id"), F.col("k1").alias("_k1"), F.col("k2").alias("_k2")).distinct()
        bad = keep(written(bad, "contaminated"))  # a table's size is known, so that a small one is broadcast and texts stay where they are
    k1, k2 = row_key(F.col("text"))
    row = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_doc"), k1.alias("_a"), k2.alias("_b"))
    same = row["_doc"].eqNullSafe(bad["_id"]) & (row["_a"] == bad["_k1"]) & (row["_b"] == bad["_k2"])
    return row.join(bad, same, "left_anti").select("_row.*")
