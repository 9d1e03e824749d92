"""Suffix-array dedup over bytes, blockwise with difference covers.

Suffixes that share their first LENGTH bytes with another are neighbours in the suffix array. It is never built as a
whole:

1. The sample of the corpus at positions whose residue modulo PERIOD lies in a difference cover is put into classes
   by its first LENGTH - PERIOD + 1 bytes. For any two suffixes there is a shift below PERIOD that takes both into the
   sample, so a suffix with no sampled position of a shared class less than PERIOD ahead has no twin.
2. The suffixes in doubt are put into classes by a hash of LENGTH bytes, which leaves the twins and few others.
3. Their text goes to buckets in stretches (``verified``). A task sorts one bucket of suffixes at a time; suffixes that
   tie in their first bytes are told apart by the ranks of the bucket's own cover sample (``ranks``); neighbours
   are then compared in their LENGTH bytes. Steps 1 and 2 only rule out: no hash removes a byte.

Texts are UTF-8 bytes; null texts are empty; no string crosses documents. Equal rows are each other's copies and
get equal results, one each; a null doc_id is a document like any other. Extra columns are not read. Memory of a task:
some 60 times its longest document."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollway.llm import exchange, ranks, rolling, verified
from tollway.llm.common import released, step, written

LENGTH = 200
# A perfect difference set. Every residue modulo 133 but 0 is exactly one difference of two of them.
PERIOD, COVER = 133, (0, 1, 3, 12, 20, 34, 38, 81, 88, 94, 104, 109)
OUT = pa.schema([("doc_id", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])


def is_cover(period: int, cover: tuple[int, ...]) -> bool:
    return {(a - b) % period for a in cover for b in cover} == set(range(period))


def _ramp(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1 .. for n[0] numbers, then the same of first[1]."""
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())


def cover_hasher(length: int, period: int, cover: tuple[int, ...]) -> exchange.Hasher:
    """Hashes of the sampled suffixes, as far as every twin of LENGTH bytes must agree with them."""
    part = length - period + 1
    steps = np.array(cover)

    def hashes(data, at, _):
        room = np.diff(at) - part + 1
        n = np.maximum(0, -(-room // period))
        pos = (np.repeat(_ramp(np.zeros(len(n), np.int64), n) * period, len(steps)).reshape(-1, len(steps)) + steps).ravel()
        doc = np.repeat(np.arange(len(n)), n * len(steps))
        fits = pos < room[doc]
        pos = (pos + at[doc])[fits]
        return rolling.byte_hashes(data, pos, pos + part), pos, at

    return hashes


def doubtful(samples: np.ndarray, n: int, length: int, period: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs [a, b) of suffixes of n bytes in doubt: those with a sampled suffix of a shared class less than `period` ahead."""
    if not len(samples):
        return samples, samples
    a, b = rolling.runs(samples - period + 1, period)
    return np.maximum(a, 0), np.minimum(b, n - length + 1)


def suffix_hasher(length: int, period: int) -> exchange.Hasher:
    def hashes(data, at, batch):
        first, n = [], []
        for i, hits in enumerate(batch.column("hits").to_pylist()):
            a, b = doubtful(exchange.positions(hits), int(at[i + 1] - at[i]), length, period)
            some = b > a
            first.append(a[some] + at[i])
            n.append((b - a)[some])
        pos = _ramp(np.concatenate(first), np.concatenate(n)) if first else np.zeros(0, np.int64)
        return rolling.byte_hashes(data, pos, pos + length), pos, at

    return hashes


def cutter(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    place = np.arange(len(data) + 1)
    return rolling.prefix(rolling.BYTE_VALUES[data]), at, data, place, place[1:]


def classes(length: int) -> verified.Classes:
    def classes(bodies):
        size = np.array([len(x) for x in bodies])
        begin, n = np.cumsum(size) - size, size - length + 1
        text = np.frombuffer(b"".join(bodies), np.uint8)
        return ranks.Suffixes(text, length).classes(_ramp(begin, n)), np.r_[0, np.cumsum(n)]

    return classes


def _cut(length: int, texts: bool):
    def cut(batches):
        for batch in rolling.chunks(batches, "text"):
            data, at = rolling.texts(batch.column("text"))
            rows = []
            for i, (key, (a, b)) in enumerate(zip(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "k1", "k2")), strict=True), verified.covered(batch.column("hits"), length), strict=True)):
                raw = data[at[i] : at[i + 1]]
                kept = b"".join(raw[x:y].tobytes() for x, y in zip([0, *b.tolist()], [*a.tolist(), len(raw)], strict=True))
                rows.append((*key, int((b - a).sum()), len(a), hashlib.sha256(kept).hexdigest(), kept if texts else None))
            yield exchange._rows(OUT, rows)

    return cut


def total(found: DataFrame) -> int:
    return found.agg(F.sum("n")).first()[0] or 0


def dedup(docs: DataFrame, length: int = LENGTH, period: int = PERIOD, cover: tuple[int, ...] = COVER, texts: bool = True, per_bucket: int = exchange.PER_BUCKET) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (bytes left; null without `texts`)."""
    if not is_cover(period, cover) or period > length:
        raise ValueError("cover must be a difference cover of a period that the length holds")
    rows = exchange.keyed(docs)
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    with step(docs.sparkSession) as keep:
        sampled = exchange.repeats(rows, cover_hasher(length, period, cover), "cover", n_bytes * len(cover) // period, per_bucket)
        # equal rows stay apart: each is a twin of the other
        doubt = keep(written(exchange.joined(rows, exchange.gathered(sampled), "inner"), "doubt"))
        twins = exchange.repeats(doubt, suffix_hasher(length, period), "suffixes", total(sampled) * period // len(cover), per_bucket)
        likely = exchange.joined(doubt.drop("hits"), exchange.gathered(twins), "inner")
        found = keep(written(verified.repeats(likely, total(twins), cutter, classes(length), length, length // 2), "twins"))
    cut = exchange.joined(doubt.drop("hits"), found, "inner").mapInArrow(released(_cut(length, texts)), "doc_id long, k1 long, k2 long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    cut = cut.dropDuplicates(["doc_id", "k1", "k2"]) if not texts else cut.groupBy("doc_id", "k1", "k2").agg(*(F.first(c).alias(c) for c in ("n_removed", "n_spans", "kept_sha256", "kept")))
    text = F.coalesce(F.col("text"), F.lit(""))
    whole = rows.select("doc_id", "k1", "k2", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text.cast("binary"), 256).alias("sha"), *([text.cast("binary").alias("raw")] if texts else []))
    same = whole["doc_id"].eqNullSafe(cut["doc_id"]) & (whole["k1"] == cut["k1"]) & (whole["k2"] == cut["k2"])
    # a document that loses all its bytes keeps an empty text, not a null one
    out = whole.join(cut, same, "left").select(
        whole["doc_id"], "n_bytes", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"), (F.coalesce("kept", "raw") if texts else F.lit(None).cast("binary")).alias("kept"),
    )
    return out
