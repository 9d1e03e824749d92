"""Repeated windows, settled by the texts themselves.

Candidate windows that follow one another are sent as one stretch of text, as long as the smallest hash of their
inner pieces of `part` units stays the same; that hash names the bucket. Windows that are equal have the same pieces,
so they meet. A task takes one bucket at a time, in the order that Spark has sorted them into, and gives every window
of its distinct stretches a class: equal numbers for equal texts, by comparison and not by hash. A window is
repeated if its class has two places, or, where order counts, a place in a document of a smaller doc_id.

A stretch that a block of documents has several times is sent once, with its places. A piece of `part` units must be
common to many different repeated passages for a bucket to be large."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollway.llm import exchange, rolling
from tollway.llm.common import partitions, released

LARGEST = exchange.LARGEST
#: Windows that a bucket takes, on average.
PER_BUCKET = 1 << 18
SENT = pa.schema([("bucket", pa.int64()), ("low", pa.int64()), ("n", pa.int64()), ("body", pa.binary()), *((c, pa.int64()) for c in ("doc_id", "known", "k1", "k2", "pos")), ("more", pa.binary())])
PLACE = ["doc_id", "known", "k1", "k2", "pos"]
#: (data, text offsets) -> (hash prefix sums over units, first unit of each text, bytes of units, where each unit begins in them, and ends)
Cutter = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
#: (distinct stretches) -> (class of each window, first window of each stretch, one more at the end)
Classes = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]


def least(h: np.ndarray, size: int) -> np.ndarray:
    """Minimum of every `size` numbers in a row."""
    have = 1
    while 2 * have <= size:
        h = np.minimum(h[:-have], h[have:])
        have *= 2
    return h if have == size else np.minimum(h[: len(h) - (size - have)], h[size - have :])


def stretches(marks: np.ndarray, s: np.ndarray, size: int, part: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of marked windows: first window, number of windows, and the smallest hash that all of them have."""
    at = np.arange(len(s) - part)
    low = least(rolling.stretch(s, at, at + part), size - part + 1)[marks]
    new = np.flatnonzero(np.r_[True, (marks[1:] != marks[:-1] + 1) | (low[1:] != low[:-1])])
    return marks[new], np.diff(np.r_[new, len(marks)]), low[new]


def _send(cutter: Cutter, size: int, part: int, buckets: int):
    def send(batches):
        for batch in rolling.chunks(batches, "text", exchange.BLOCK):
            index: dict[bytes, int] = {}
            ofs, places, lows, ns = [], [], [], []
            for piece in rolling.chunks([batch], "text", exchange.PIECE):
                s, first, units, begin, end = cutter(*rolling.texts(piece.column("text")))
                marks = np.concatenate([exchange.positions(hits) + first[i] for i, hits in enumerate(piece.column("hits").to_pylist())])
                if not len(marks):
                    continue
                start, n, low = stretches(marks, s, size, part)
                doc = np.searchsorted(first, start, "right") - 1
                raw = units.tobytes()
                ofs += [index.setdefault(raw[a:b], len(index)) for a, b in zip(begin[start].tolist(), end[start + n + size - 2].tolist(), strict=True)]
                ids = piece.column("doc_id").fill_null(LARGEST).to_numpy()
                known = piece.column("doc_id").is_valid().to_numpy(zero_copy_only=False).astype(np.int64)
                k1, k2 = (piece.column(k).to_numpy() for k in ("k1", "k2"))
                places.append(np.stack([ids[doc], known[doc], k1[doc], k2[doc], start - first[doc]], 1))
                lows.append(low)
                ns.append(n)
            if not ofs:
                continue
            of, low, n = np.array(ofs), np.concatenate(lows), np.concatenate(ns)
            order = np.argsort(of, kind="stable")
            place = np.concatenate(places)[order]
            lead = np.searchsorted(of[order], np.arange(len(index)))
            upto = np.r_[lead[1:], len(of)]
            more: list[bytes | None] = [None] * len(index)
            for i in np.flatnonzero(upto - lead > 1).tolist():
                more[i] = place[lead[i] + 1 : upto[i]].tobytes()
            low = low[order[lead]]
            bucket = (low % np.uint64(buckets)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(low.view(np.int64)), pa.array(n[order[lead]]), pa.array(list(index), pa.binary()), *(pa.array(place[lead, c]) for c in range(5)), pa.array(more, pa.binary())], schema=SENT)

    return send


def runs_in(hit: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of hits in consecutive segments of n: segment, start in it, length."""
    first = np.cumsum(n) - n
    edge = np.zeros(len(hit) + 1, bool)
    edge[first] = True
    if not len(hit):
        return first[:0], first[:0], first[:0]
    before = np.r_[False, hit[:-1]] & ~edge[:-1]
    after = np.r_[hit[1:], False] & ~np.r_[edge[1:-1], True]
    start, end = np.flatnonzero(hit & ~before), np.flatnonzero(hit & ~after) + 1
    segment = np.searchsorted(first, start, "right") - 1
    return segment, start - first[segment], end - start


def judged(rows: pa.Table, classes: Classes, ordered: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the stretches of one bucket: their places, those that have repeated windows, once for each run; the run's first window and length.

    Only windows of stretches with the same smallest hash can be equal. Where each of these has two places all windows
    are repeated, and where there is one stretch only its least doc_id is asked for: the rest gets classes."""
    place = np.stack([rows.column(c).to_numpy() for c in PLACE], 1)
    index: dict[bytes, int] = {}
    of = np.array([index.setdefault(x, len(index)) for x in rows.column("body").to_pylist()])
    lead = np.unique(of, return_index=True)[1]
    n, group = (rows.column(c).to_numpy()[lead] for c in ("n", "low"))
    rest = [(i, np.frombuffer(x, np.int64).reshape(-1, 5)) for i, x in enumerate(rows.column("more").to_pylist()) if x is not None]
    place = np.concatenate([place, *(x for _, x in rest)])
    of = np.concatenate([of, *(np.full(len(x), of[i]) for i, x in rest)])
    times, group = np.bincount(of), np.unique(group, return_inverse=True)[1]
    open_ = (np.bincount(group) > 1 if ordered else np.bincount(group, times == 1) > 0)[group]
    name = np.zeros(0, np.int64)
    begin = np.cumsum(np.where(open_, n, 0)) - np.where(open_, n, 0)
    if open_.any():
        name, _ = classes([x for x, o in zip(index, open_.tolist(), strict=True) if o])
    if ordered:
        low = np.full(len(index), LARGEST)
        np.minimum.at(low, of, place[:, 0])
        lowest = np.full(int(name.max(initial=0)) + 1, LARGEST)
        np.minimum.at(lowest, name, np.repeat(low[open_], n[open_]))
        whole = np.flatnonzero(~open_[of] & (low[of] < place[:, 0]))
        mine = np.flatnonzero(open_[of])
        own = n[of[mine]]
        window = np.repeat(begin[of[mine]] - (np.cumsum(own) - own), own) + np.arange(own.sum())
        which, start, length = runs_in(lowest[name[window]] < np.repeat(place[mine, 0], own), own)
        which, start, length = np.r_[mine[which], whole], np.r_[start, np.zeros(len(whole), np.int64)], np.r_[length, n[of[whole]]]
    else:
        total = np.bincount(name, np.repeat(times[open_], n[open_]))
        body, start, length = runs_in(total[name] > 1, n[open_])
        whole = np.flatnonzero(~open_)
        body, start, length = np.r_[np.flatnonzero(open_)[body], whole], np.r_[start, np.zeros(len(whole), np.int64)], np.r_[length, n[whole]]
        # each run goes to every place of its stretch
        order = np.argsort(of, kind="stable")
        low, high = np.searchsorted(of[order], body), np.searchsorted(of[order], body, "right")
        many = high - low
        which = order[np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum())]
        start, length = np.repeat(start, many), np.repeat(length, many)
    return place[which], start, length


def _judge(classes: Classes, ordered: bool):
    def judge(batches):
        for run in exchange.sorted_runs(batches, ["bucket"]):
            place, start, length = judged(run, classes, ordered)
            ids = pa.array(place[:, 0], pa.int64(), mask=place[:, 1] == 0)
            yield pa.RecordBatch.from_arrays([ids, pa.array(place[:, 2]), pa.array(place[:, 3]), pa.array(place[:, 4] + start), pa.array(length)], names=["doc_id", "k1", "k2", "pos", "n"])

    return judge


def repeats(docs: DataFrame, windows: int, cutter: Cutter, classes: Classes, size: int, part: int, ordered: bool = False) -> DataFrame:
    """(doc_id, k1, k2, hits): the windows of `size` units of each document that are repeated, as runs (pos, n) of their starts.

    docs: doc_id, k1, k2, text and hits, the candidates of ``exchange.repeats``; windows: how many they are in all.
    ordered: only places in documents with a smaller doc_id count (a null id is the largest)."""
    n = partitions(docs.sparkSession)
    buckets = max(8 * n, windows // PER_BUCKET)
    sent = docs.mapInArrow(released(_send(cutter, size, part, buckets)), "bucket long, low long, n long, body binary, doc_id long, known long, k1 long, k2 long, pos long, more binary")
    met = sent.repartition(n, "bucket").sortWithinPartitions("bucket")
    hits = met.mapInArrow(released(_judge(classes, ordered)), "doc_id long, k1 long, k2 long, pos long, n long")
    return hits.groupBy("doc_id", "k1", "k2").agg(F.collect_set(F.struct("pos", "n")).alias("hits"))


def covered(hits: pa.ListArray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of each document: the maximal runs [start, end) of units that its repeated windows cover."""
    flat = hits.flatten()
    pos, n = (flat.field(c).to_numpy() for c in ("pos", "n"))
    many = pc.fill_null(pc.list_value_length(hits), 0).to_numpy()
    for end, k in zip(np.cumsum(many).tolist(), many.tolist(), strict=True):
        a, b = pos[end - k : end], n[end - k : end]
        order = np.argsort(a)
        a = a[order]
        b = np.maximum.accumulate(a + b[order] - 1 + size) if k else a
        gap = np.flatnonzero(a[1:] > b[:-1])
        yield (a[np.r_[0, gap + 1]], b[np.r_[gap, k - 1]]) if k else (a, b)
