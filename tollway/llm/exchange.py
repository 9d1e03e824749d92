"""Which windows of a corpus may occur again: hashes are packed by bucket, exchanged once, and answered.

A block is a chunk of documents of one task. It sends 32 bits of the hash of each distinct window once, in one
packed row for each bucket, and a home row with its document keys and the windows that repeat within it. A bucket
sorts the hashes of all blocks and answers with the positions of those that several have. Answers and home row meet
by block. A window that stands in a third of all documents is sent once for each block.

Answers are candidates: every window that occurs twice is one, and so are a few others whose bits are equal by
chance. ``verified`` settles them by the texts themselves.

What a bucket holds is bounded (PER_BUCKET): more windows take more shares. Then texts are hashed once, into a table
whose rows are sorted by share, and shares are exchanged one after the other, many blocks as one, so that packing pays
however many buckets there are.

Documents are told apart by (doc_id, k1, k2)."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollway.llm import rolling
from tollway.llm.common import partitions, released, row_key, small_batches, written

LARGEST = np.iinfo(np.int64).max
#: Bytes of text in a block, but one document at least, and of what is hashed at once.
BLOCK, PIECE = 2 << 20, 1 << 18
#: A block ends at the piece that brings it to so many windows: arrays of some 60 bytes each.
WINDOWS = 1 << 19
#: Hashes of a share that are packed at once, at least, and for each bucket.
PACK, PER_ROW = 1 << 20, 64
#: Hashes that a bucket holds, on average: some 25 bytes each.
PER_BUCKET = 4 << 20
PACKED = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("home", pa.bool_()), ("body", pa.binary())])
ANSWER = pa.schema([("block", pa.int64()), ("home", pa.bool_()), ("body", pa.binary())])
SPANS = pa.schema([("doc_id", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("hits", pa.binary()), ("n", pa.int64()), ("size", pa.int64())])
#: (data, text offsets, batch) -> (hash of each window, its position, first position of each text)
Hasher = Callable[[np.ndarray, np.ndarray, pa.RecordBatch], tuple[np.ndarray, np.ndarray, np.ndarray]]


def planes(a: np.ndarray) -> bytes:
    """Bytes of the numbers, least significant ones first, so that a codec finds the zeros."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()


def from_planes(b: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(size, -1).T).view(kind).ravel()


def deltas(a: np.ndarray) -> np.ndarray:
    return np.diff(a, prepend=a.dtype.type(0))


def pack(*arrays: np.ndarray) -> bytes:
    parts = [planes(a) for a in arrays]
    return np.array([len(p) for p in parts], np.uint64).tobytes() + b"".join(parts)


def unpack(b: bytes, *kinds: type) -> list[np.ndarray]:
    out, at = [], 8 * len(kinds)
    for n, kind in zip(np.frombuffer(b, np.uint64, len(kinds)), kinds, strict=True):
        out.append(from_planes(b[at : at + int(n)], kind))
        at += int(n)
    return out


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _hashes(hasher: Hasher, batches) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks and what the hasher finds in them, piece by piece, so that its own arrays stay small."""
    for batch in rolling.chunks(batches, "text", BLOCK):
        begin, done, units, n, hs, ps, firsts = 0, 0, 0, 0, [], [], [np.zeros(1, np.int64)]
        for piece in rolling.chunks([batch], "text", PIECE):
            h, pos, first = hasher(*rolling.texts(piece.column("text")), piece)
            hs.append(h)
            ps.append(pos + units)
            firsts.append(first[1:] + units)
            units, n, done = units + int(first[-1]), n + len(h), done + piece.num_rows
            if n >= WINDOWS or done == batch.num_rows:
                yield batch.slice(begin, done - begin), np.concatenate(hs), np.concatenate(ps), np.concatenate(firsts)
                begin, units, n, hs, ps, firsts = done, 0, 0, [], [], [np.zeros(1, np.int64)]


def _blocks(hasher: Hasher, batches) -> Iterator[tuple[int, bytes, np.ndarray, np.ndarray]]:
    """Of each block with windows: its name, its home row, its distinct hashes and a position of each, by position."""
    for batch, h, pos, first in _hashes(hasher, batches):
        if not len(h):
            continue
        ids = batch.column("doc_id").fill_null(LARGEST).to_numpy()
        k1, k2 = (batch.column(k).to_numpy() for k in ("k1", "k2"))
        name = hashlib.blake2b(k1.tobytes() + k2.tobytes() + ids.tobytes(), digest_size=8).digest()
        order = np.argsort(h)
        new = np.r_[True, h[order[1:]] != h[order[:-1]]]
        again, of = order[~new], order[np.flatnonzero(new)[np.cumsum(new) - 1]][~new]
        known = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
        twice = np.sort(pos[np.unique(np.r_[again, of])]).astype(np.uint32)
        home = pack(ids, known.astype(np.uint8), k1, k2, first.astype(np.int64), deltas(twice))
        own = np.sort(order[new])
        yield int(np.frombuffer(name, np.int64)[0]), home, h[own], pos[own].astype(np.uint32)


def _dealt(h: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Buckets and the hashes that go there."""
    to = (h >> np.uint64(33)) % np.uint64(buckets)
    to = to.astype(np.uint16 if buckets < 1 << 16 else np.int32)
    by = np.argsort(to, kind="stable")  # radix sort of few values
    cut = np.searchsorted(to[by], np.arange(buckets + 1))
    for b in range(buckets):
        if cut[b + 1] > cut[b]:
            yield b, by[cut[b] : cut[b + 1]]


def _send(hasher: Hasher, buckets: int):
    def send(batches):
        for block, home, h, pos in _blocks(hasher, batches):
            rows = [(block % buckets, block, True, home)]
            rows += [(b, block, False, pack(h[x].astype(np.uint32), deltas(pos[x]))) for b, x in _dealt(h, buckets)]
            yield _rows(PACKED, rows)

    return send


def _hash(hasher: Hasher, parts: int):
    """Home rows as share -1, and a row of each block for each share."""

    def hashed(batches):
        for block, home, h, pos in _blocks(hasher, batches):
            rows = [(-1, block, True, home)]
            share = h % np.uint64(parts)
            for part in range(parts):
                mine = share == part
                if mine.any():
                    rows.append((part, block, False, pack(h[mine], deltas(pos[mine]))))
            yield _rows(PACKED, rows)

    return hashed


def _pack(buckets: int):
    """Rows of a share's blocks as one block: hashes by bucket, each with its block's number and its position; the home row names the blocks."""

    def packed(blocks, hs, ps):
        names = np.array(blocks, np.int64)
        of = np.repeat(np.arange(len(blocks), dtype=np.uint32), [len(x) for x in hs])
        h, pos = np.concatenate(hs), np.concatenate(ps)
        whole = int(np.frombuffer(hashlib.blake2b(names.tobytes(), digest_size=8).digest(), np.int64)[0])
        rows = [(whole % buckets, whole, True, names.tobytes())]
        rows += [(b, whole, False, pack(h[x].astype(np.uint32), deltas(of[x]), pos[x])) for b, x in _dealt(h, buckets)]
        return _rows(PACKED, rows)

    def run(batches):
        blocks, hs, ps, n = [], [], [], 0
        for batch in batches:
            for block, body in zip(batch.column("block").to_pylist(), batch.column("body").to_pylist(), strict=True):
                h, p = unpack(body, np.uint64, np.uint32)
                blocks.append(block)
                hs.append(h)
                ps.append(np.cumsum(p, dtype=np.uint32))
                n += len(h)
                if n >= max(PACK, PER_ROW * buckets):
                    yield packed(blocks, hs, ps)
                    blocks, hs, ps, n = [], [], [], 0
        if blocks:
            yield packed(blocks, hs, ps)

    return run


def _answer(kinds: int):
    """Rows of the hashes that several have, without these. kinds: numbers that follow a hash, the first of them as deltas."""

    def answer(batches):
        blocks, hs, rest = [], [], []
        for batch in batches:
            for block, home, body in zip(*(batch.column(c).to_pylist() for c in ("block", "home", "body")), strict=True):
                if home:
                    yield _rows(ANSWER, [(block, True, body)])
                else:
                    h, *more = unpack(body, *[np.uint32] * (kinds + 1))
                    blocks.append(block)
                    hs.append(h)
                    rest.append(more)
        if not blocks:
            return
        h = np.concatenate(hs)
        hs.clear()
        order = np.argsort(h)
        h = h[order]
        same = h[1:] == h[:-1]
        hit = np.zeros(len(h), bool)
        hit[order[1:][same]] = hit[order[:-1][same]] = True
        at = 0
        for block, more in zip(blocks, rest, strict=True):
            some = hit[at : at + len(more[0])]
            at += len(some)
            if some.any():
                yield _rows(ANSWER, [(block, False, pack(deltas(np.cumsum(more[0], dtype=np.uint32)[some]), *(x[some] for x in more[1:])))])

    return answer


def _split(batches):
    """Answers of packed blocks, block by block."""
    for batch in batches:
        for items in batch.column("items"):
            items = items.as_py()
            names = np.frombuffer(next(x["body"] for x in items if x["home"]), np.int64)
            found = [unpack(x["body"], np.uint32, np.uint32) for x in items if not x["home"]]
            if found:
                of, pos = np.concatenate([np.cumsum(o, dtype=np.uint32) for o, _ in found]), np.concatenate([p for _, p in found])
                order = np.lexsort((pos, of))
                of, pos = of[order], pos[order]
                cut = np.searchsorted(of, np.arange(len(names) + 1))
                rows = [(int(names[i]), False, pack(deltas(pos[cut[i] : cut[i + 1]]))) for i in range(len(names)) if cut[i + 1] > cut[i]]
                yield _rows(ANSWER, rows)


def _collect(batches):
    for batch in batches:
        for items in batch.column("items"):
            items = items.as_py()
            # equal rows make equal blocks: one of them speaks for all
            homes = {x["body"] for x in items if x["home"]}
            for home in homes:
                ids, known, k1, k2, first, twice = unpack(home, np.int64, np.uint8, np.int64, np.int64, np.int64, np.uint32)
                mark = np.zeros(int(first[-1]), bool)
                mark[np.cumsum(twice, dtype=np.uint32)] = True
                for x in items:
                    if not x["home"]:
                        mark[np.cumsum(*unpack(x["body"], np.uint32), dtype=np.uint32)] = True
                n = np.add.reduceat(np.r_[mark, False], first[:-1], dtype=np.int64) * (np.diff(first) > 0)
                rows = [(int(ids[i]) if known[i] else None, int(k1[i]), int(k2[i]), np.packbits(mark[first[i] : first[i + 1]]).tobytes(), int(n[i]), int(first[i + 1] - first[i])) for i in np.flatnonzero(n)]
                if rows:
                    yield _rows(SPANS, rows)


def sorted_runs(batches, keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key, of batches that are sorted by it."""
    open_: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy() for k in keys]
        cut = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols])) + 1
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows], strict=True):
            key = tuple(c[a] for c in cols)
            if key != last and open_:
                yield pa.Table.from_batches(open_)
                open_ = []
            last = key
            open_.append(batch.slice(a, b - a))
    if open_:
        yield pa.Table.from_batches(open_)


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *row_key(F.col("text")), "text", *more)


def repeats(docs: DataFrame, hasher: Hasher, name: str, hashes: int, per_bucket: int = PER_BUCKET) -> DataFrame:
    """(doc_id, k1, k2, hits, n, size): the windows of each document that may occur again, as bitmaps over the positions of their starts, how many they are, and how many units the document has.

    docs: doc_id, k1, k2, text and what the hasher reads. hashes: about how many windows there are; it decides on the
    shares. Equal rows have one row each or more."""
    buckets = partitions(docs.sparkSession)
    parts = -(-hashes // (per_bucket * buckets)) or 1
    ddl, items = "block long, home boolean, body binary", F.collect_list(F.struct("home", "body")).alias("items")
    if parts == 1:
        sent = docs.mapInArrow(released(_send(hasher, buckets)), f"bucket int, {ddl}")
        heard = sent.repartitionById(buckets, "bucket").mapInArrow(released(_answer(1)), ddl)
    else:
        hashed = written(docs.mapInArrow(released(_hash(hasher, parts)), f"bucket int, {ddl}").sortWithinPartitions("bucket"), f"{name}-hashes")
        heard = hashed.where("home").select("block", "home", "body")
        for part in range(parts):
            sent = hashed.where(F.col("bucket") == part).mapInArrow(released(_pack(buckets)), f"bucket int, {ddl}")
            answers = sent.repartitionById(buckets, "bucket").mapInArrow(released(_answer(2)), ddl)
            heard = heard.unionByName(written(answers.groupBy("block").agg(items).mapInArrow(released(_split), ddl), f"{name}-answers"))
    return written(heard.groupBy("block").agg(items).mapInArrow(released(_collect), "doc_id long, k1 long, k2 long, hits binary, n long, size long"), name)


def gathered(found: DataFrame) -> DataFrame:
    """The bitmaps of each document in one row."""
    return found.groupBy("doc_id", "k1", "k2").agg(F.array_distinct(F.collect_list("hits")).alias("hits"))


def joined(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """docs with the hits of each, by key; null ids meet null ids."""
    same = docs["doc_id"].eqNullSafe(found["doc_id"]) & (docs["k1"] == found["k1"]) & (docs["k2"] == found["k2"])
    return docs.join(found, same, how).select(*[docs[c] for c in docs.columns], found["hits"])


def positions(hits: list | None) -> np.ndarray:
    """Sorted window starts from a document's bitmaps."""
    if not hits:
        return np.zeros(0, np.int64)
    both = np.frombuffer(hits[0], np.uint8)
    for x in hits[1:]:
        both = both | np.frombuffer(x, np.uint8)
    return np.flatnonzero(np.unpackbits(both))
