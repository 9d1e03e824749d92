"""Substring dedup over words: Rabin-Karp hashes of every window of 50 words, first occurrence kept.

A window goes where its words also start in a document with a smaller doc_id; overlapping windows merge into
maximal removal intervals. Hashes that several windows have make candidates; whether they are equal is settled by
their words (``verified``), so that no hash removes a word. Null texts have no words; a null doc_id counts as larger than any other. Documents
with one doc_id leave each other alone. Equal rows get equal results, one each. Extra columns are not read."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollway.llm import exchange, rolling, verified
from tollway.llm.common import released, step, written

WINDOW = 50
#: Bytes of a word and its blank, for the number of windows to expect.
WORD_BYTES = 5
OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())])


def hasher(window: int) -> exchange.Hasher:
    def hashes(data, at, _):
        start, end, first = rolling.words(data, at, ~rolling.IS_BLANK)
        pos = rolling.windows(first, window)
        return rolling.stretch(rolling.prefix(rolling.word_hashes(data, start, end)), pos, pos + window), pos, first

    return hashes


def cutter(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Words as units, each followed by one space."""
    start, end, first = rolling.words(data, at, ~rolling.IS_BLANK)
    size = end - start
    begin = np.cumsum(size + 1) - size - 1
    units = np.full(int(size.sum()) + len(size), 32, np.uint8)
    units[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())] = data[~rolling.IS_BLANK[data]]
    return rolling.prefix(rolling.word_hashes(data, start, end)), first, units, begin, begin + size


def classes(window: int) -> verified.Classes:
    """Words get numbers, then windows of 2, 4, 8 .. words, and at last of `window` words, by the numbers of their halves."""

    def classes(bodies):
        numbers: dict[bytes, int] = {}
        words = [[numbers.setdefault(w, len(numbers)) for w in x.split(b" ")] for x in bodies]
        many = np.array([len(w) for w in words])
        first, n = np.cumsum(many) - many, many - window + 1
        name, have = np.concatenate(words).astype(np.int64), 1
        while have < window:
            step = min(have, window - have)
            pair = name[:-step] * (int(name.max()) + 1) + name[step:]
            name, have = np.unique(pair, return_inverse=True)[1], have + step
        upto = np.cumsum(n)
        return name[np.repeat(first - (upto - n), n) + np.arange(upto[-1])], np.r_[0, upto]

    return classes


def _cut(window: int, texts: bool):
    def cut(batches):
        for batch in rolling.chunks(batches, "text"):
            data, at = rolling.texts(batch.column("text"))
            start, end, first = rolling.words(data, at, ~rolling.IS_BLANK)
            out = []
            for i, (doc_id, (s, e)) in enumerate(zip(batch.column("doc_id").to_pylist(), verified.covered(batch.column("hits"), window), strict=True)):
                a, b = first[i], first[i + 1]
                raw = data[at[i] : at[i + 1]].tobytes()
                kept, last = [], 0
                for x, y in [*zip(s, e, strict=True), (b - a, b - a)]:
                    if x > last:
                        kept += raw[start[a + last] - at[i] : end[a + x - 1] - at[i]].split()
                    last = y
                body = b" ".join(kept)
                out.append((doc_id, int(b - a), int((e - s).sum()), len(s), hashlib.sha256(body).hexdigest(), body.decode() if texts else None))
            yield exchange._rows(OUT, out)

    return cut


def dedup(docs: DataFrame, window: int = WINDOW, texts: bool = True, per_bucket: int = exchange.PER_BUCKET) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, n_spans, kept_sha256, kept (the words left; null without `texts`)."""
    rows = exchange.keyed(docs)
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    with step(docs.sparkSession) as keep:
        again = exchange.repeats(rows, hasher(window), "substrings", n_bytes // WORD_BYTES, per_bucket)
        windows = again.agg(F.sum("n")).first()[0] or 0
        likely = exchange.joined(rows, exchange.gathered(again), "inner")
        found = keep(written(verified.repeats(likely, windows, cutter, classes(window), window, max(1, window // 3), ordered=True), "verified"))
    return exchange.joined(rows, found, "left").select("doc_id", "text", "hits").mapInArrow(released(_cut(window, texts)), "doc_id long, n_words long, n_removed long, n_spans long, kept_sha256 string, kept string")
