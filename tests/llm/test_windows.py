"""Suffix dedup and substring dedup against brute force, and their parts."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tollway.llm import exchange, ranks, rolling, substrings, suffixes, verified


def spans(mark):
    return sum(1 for i, m in enumerate(mark) if m and (i == 0 or not mark[i - 1]))


def brute_bytes(rows, length):
    data = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[i : i + length] for _, b in data for i in range(len(b) - length + 1))
    out = []
    for d, b in data:
        mark = [False] * len(b)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                mark[i : i + length] = [True] * length
        kept = bytes(x for x, m in zip(b, mark, strict=True) if not m)
        out.append((d, len(b), sum(mark), spans(mark), hashlib.sha256(kept).hexdigest(), kept))
    return sorted(out, key=str)


def brute_words(rows, size):
    data = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    least = defaultdict(lambda: exchange.LARGEST)
    for d, w in data:
        for i in range(len(w) - size + 1):
            least[tuple(w[i : i + size])] = min(least[tuple(w[i : i + size])], exchange.LARGEST if d is None else d)
    out = []
    for d, w in data:
        mark = [False] * len(w)
        for i in range(len(w) - size + 1):
            if least[tuple(w[i : i + size])] < (exchange.LARGEST if d is None else d):
                mark[i : i + size] = [True] * size
        kept = " ".join(x for x, m in zip(w, mark, strict=True) if not m)
        out.append((d, len(w), sum(mark), spans(mark), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=str)


def pairs(rows):
    return [(r[0], r[1]) for r in rows]


@pytest.mark.parametrize("per_bucket", [1 << 22, 300])
def test_suffixes(edge_docs, edge_rows, per_bucket):
    got = suffixes.dedup(edge_docs, per_bucket=per_bucket).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in got), key=str) == brute_bytes(pairs(edge_rows), 200)
    bare = suffixes.dedup(edge_docs, texts=False, per_bucket=per_bucket).collect()
    assert Counter((r.doc_id, r.kept_sha256) for r in bare) == Counter((r.doc_id, r.kept_sha256) for r in got) and {r.kept for r in bare} == {None}


def test_suffixes_with_a_small_cover(edge_docs, edge_rows):
    """Seven residues, three of which meet every difference."""
    got = suffixes.dedup(edge_docs, length=20, period=7, cover=(0, 1, 3), texts=True)
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in got.collect()), key=str) == brute_bytes(pairs(edge_rows), 20)


def test_cover_must_cover(edge_docs):
    assert suffixes.is_cover(suffixes.PERIOD, suffixes.COVER)
    with pytest.raises(ValueError, match="cover"):
        suffixes.dedup(edge_docs, period=133, cover=(0, 1, 2))


@pytest.mark.parametrize(("size", "per_bucket"), [(50, 1 << 22), (5, 1 << 22), (5, 1500), (2, 1 << 22)])
def test_substrings(edge_docs, edge_rows, size, per_bucket):
    got = substrings.dedup(edge_docs, window=size, per_bucket=per_bucket).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.n_spans, r.kept_sha256, r.kept) for r in got), key=str) == brute_words(pairs(edge_rows), size)


def test_empty_tables(no_docs):
    assert suffixes.dedup(no_docs).count() == 0 and substrings.dedup(no_docs).count() == 0


def test_one_document_has_no_smaller_one(spark):
    docs = spark.createDataFrame([(1, "a b c d e f " * 40)], "doc_id long, text string")
    assert substrings.dedup(docs, window=5).first().n_removed == 0
    assert suffixes.dedup(docs).first().n_removed == 480


@given(st.lists(st.text(alphabet=" \n\tab1é", max_size=30), max_size=6))
@settings(max_examples=60, deadline=None)
def test_words(texts):
    data, at = rolling.texts(pa.array(texts, pa.string()))
    start, end, first = rolling.words(data, at, ~rolling.IS_BLANK)
    found = [data[a:b].tobytes().decode() for a, b in zip(start, end, strict=True)]
    want = [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts]
    assert found == [w for ws in want for w in ws] and list(np.diff(first)) == [len(w) for w in want]
    h = rolling.word_hashes(data, start, end)
    assert len(set(zip(found, h.tolist(), strict=True))) == len(set(found)) == len(set(h.tolist()))


@given(st.lists(st.integers(0, 60), unique=True), st.integers(1, 9))
@settings(max_examples=60, deadline=None)
def test_runs(at, size):
    a, b = rolling.runs(np.array(sorted(at), np.int64), size)
    covered = {x + i for x in at for i in range(size)}
    assert covered == {x for s, e in zip(a, b, strict=True) for x in range(s, e)} and all(x > y for x, y in zip(a[1:], b, strict=False))


@given(st.lists(st.integers(0, 2**63 - 1)))
@settings(max_examples=40, deadline=None)
def test_packing_round_trip(values):
    a = np.array(values, np.int64)
    b = a.astype(np.uint32)
    x, y = exchange.unpack(exchange.pack(a, exchange.deltas(b)), np.int64, np.uint32)
    assert (x == a).all() and (np.cumsum(y, dtype=np.uint32) == b).all()


def test_hashes_in_pieces():
    data = np.frombuffer(bytes(range(97, 123)) * 40, np.uint8)
    at = np.arange(0, len(data) - 30, 3)
    whole, cut = rolling.byte_hashes(data, at, at + 30), rolling.byte_hashes(data, at, at + 30, most=64)
    assert (whole == cut).all() and len(set(whole.tolist())) == 26


def test_very_long_text(spark):
    text = "".join(f"w{i} " for i in range(400_000))
    docs = spark.createDataFrame([(1, text), (2, text[5000:])], "doc_id long, text string")
    got = {r.doc_id: r for r in substrings.dedup(docs, texts=False).collect()}
    assert got[1].n_removed == 0 and got[2].n_removed == got[2].n_words - (text[4999] != " ")


def test_words_that_hash_alike(spark):
    """The hash of words of 1,024 bytes and more that are a Thue-Morse sequence and its complement is the same; the windows are not."""
    bits = [bin(i).count("1") % 2 for i in range(1024)]
    one, two = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    rest = " ".join(f"w{i}" for i in range(49))
    h = rolling.word_hashes(np.frombuffer((one + two).encode(), np.uint8), np.array([0, 1024]), np.array([1024, 2048]))
    assert h[0] == h[1]
    rows = [(1, f"{one} {rest}"), (2, f"{two} {rest}"), (3, f"{one} {rest}")]
    got = {r.doc_id: r.n_removed for r in substrings.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 0, 3: 50}
    texts = [(i, f"{x}{'x' * 300}{y}") for i, (x, y) in enumerate([(one, "1"), (two, "2"), (one, "3")])]
    got = suffixes.dedup(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in got), key=str) == brute_bytes(texts, 200)


def test_hashes_only_propose(spark, edge_docs, edge_rows, monkeypatch):
    """With hashes of two values the results stay the same."""
    bad = lambda f: lambda *a: (lambda h, *rest: (h % np.uint64(2), *rest))(*f(*a))
    cover, twins, words = suffixes.cover_hasher, suffixes.suffix_hasher, substrings.hasher
    monkeypatch.setattr(suffixes, "cover_hasher", lambda *a: bad(cover(*a)))
    monkeypatch.setattr(suffixes, "suffix_hasher", lambda *a: bad(twins(*a)))
    monkeypatch.setattr(substrings, "hasher", lambda *a: bad(words(*a)))
    rows = [r for r in edge_rows if len(r[1] or "") < 6000]
    docs = spark.createDataFrame([(r[0], r[1]) for r in rows], "doc_id long, text string")
    got = suffixes.dedup(docs).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in got), key=str) == brute_bytes(pairs(rows), 200)
    got = substrings.dedup(docs).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.n_spans, r.kept_sha256, r.kept) for r in got), key=str) == brute_words(pairs(rows), 50)


@given(st.lists(st.text(alphabet="ab", max_size=120), min_size=1, max_size=5), st.integers(8, 40), st.integers(1, 60))
@settings(max_examples=150, deadline=None)
def test_suffix_order(texts, length, most):
    text = "".join(texts).encode()
    at = np.arange(max(0, len(text) - length + 1))
    s = ranks.Suffixes(np.frombuffer(text, np.uint8), length)
    parts = [text[i : i + length] for i in s.sort(at)] if len(at) else []
    assert parts == sorted(parts)
    name = s.classes(at, most) if len(at) else at
    assert len(set(name.tolist())) == len({text[i : i + length] for i in at}) == len({(x, text[i : i + length]) for x, i in zip(name.tolist(), at, strict=True)})


@given(st.lists(st.integers(0, 9), min_size=1, max_size=40), st.integers(1, 40))
@settings(max_examples=60, deadline=None)
def test_least(values, size):
    size = min(size, len(values))
    assert verified.least(np.array(values), size).tolist() == [min(values[i : i + size]) for i in range(len(values) - size + 1)]


def test_blocks_are_hashed_in_small_pieces():
    """The hasher's arrays follow the piece, not the block; a block of many windows ends early; results are those of the whole."""
    texts = [f"{i:04d} " * 200 for i in range(3000)] + ["", "x" * (exchange.PIECE + 9)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(len(texts)))], names=["text", "doc_id"])
    whole = suffixes.cover_hasher(200, suffixes.PERIOD, suffixes.COVER)
    seen = []

    def hasher(data, at, piece):
        seen.append(len(data) if piece.num_rows > 1 else 0)
        return whole(data, at, piece)

    found, rows, h, pos = list(exchange._hashes(hasher, [batch])), [], [], []
    assert 0 < max(seen) <= exchange.PIECE
    begin = 0
    for block, own, at, first in found:
        rows += block.column("doc_id").to_pylist()
        h.append(own)
        pos.append(at + begin)
        begin += int(first[-1])
        assert len(first) == block.num_rows + 1
    expected = whole(*exchange.rolling.texts(batch.column("text")), batch)
    assert rows == list(range(len(texts)))
    assert (np.concatenate(h) == expected[0]).all() and (np.concatenate(pos) == expected[1]).all()
    many = lambda data, at, piece: (np.zeros(exchange.WINDOWS, np.uint64), np.zeros(exchange.WINDOWS, np.int64), at)
    assert all(len(own) == exchange.WINDOWS for _, own, _, _ in exchange._hashes(many, [batch.slice(0, 900)]))
