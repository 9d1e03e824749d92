"""Secret scans: patterns, and password guess costs for values in a credential context.

A value that follows a credential word is cut, by dynamic programming, into the cheapest sequence of dictionary
words, dates, repeats, keyboard walks and brute-force characters; the sum of their costs is the logarithm of the
guesses that an attacker needs. Values above a threshold become spans of kind `guess`; the pattern spans stay. Words
cost by their rank: the words of passwords below first, then those of a public vocabulary (VOCABULARY, a parameter;
some 32,000 in the order of their frequency). Without that file the words below are all, and long words of prose
cost more.

Nulls are empty texts. Texts and values of any length are read whole, in time linear in their length. Offsets are
code points, end exclusive. Equal rows get equal results; extra columns are not read."""

from __future__ import annotations

import hashlib
import json
import math
import re
from functools import cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollway.llm import rolling
from tollway.llm.common import small_batches

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
CONTEXT = re.compile(r"""(?:(?:password|passwd|passphrase|pwd|secret|token|credential|api[_-]?key|access[_-]?key|private[_-]?key|auth)s?["']?(?:\x20*[:=]\x20*|(?P<prose>\x20+is\x20+))|bearer\x20+)(?P<quote>["'])?(?P<value>[!-~]{8,})""", re.IGNORECASE | re.ASCII)
#: What may close a value without being part of it.
CLOSERS = "\"',;.:!?)]}>"
#: One of these stands in every text that ASSIGN or CONTEXT matches.
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
HINTS = (*ASSIGN_HINTS, "passphrase", "pwd", "credential", "key", "auth", "bearer")
KINDS = ("assign", "access", "hex", "guess")
#: log10 of the guesses from which a value is a secret.
LEAST = 10.0

# Words that passwords are made of, most frequent first.
WORDS = (
    "password the and admin welcome love monkey dragon qwerty letmein login master hello freedom whatever trust "
    "football baseball superman batman princess sunshine shadow michael jordan summer winter spring autumn secret "
    "token key user root test guest default changeme example sample dummy placeholder null none true false your "
    "here value string foo bar baz access private public api auth bearer basic server client database house cat dog "
    "star computer internet google apple orange banana cheese coffee money family friend angel ninja hunter killer"
).split()
#: A vocabulary of lower-case pieces by rank, whole words with `</w>` at their end.
VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
#: Letters of the shortest and longest word of the dictionary.
SHORTEST, LONGEST = 3, 20
LEET = str.maketrans("@4301$57!", "aaeoisstl"[:9])
# Rows and columns of a keyboard, and the orders of letters and digits.
ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./", "abcdefghijklmnopqrstuvwxyz", "0123456789", "qazwsxedcrfvtgbyhnujmikolp", "1q2w3e4r5t6y7u8i9o0p", "1qaz2wsx3edc4rfv5tgb6yhn7ujm8ik")
NEXT = {(a, b) for row in ROWS for a, b in (*zip(row, row[1:], strict=False), *zip(row[1:], row, strict=False))}
DATE = re.compile(r"(?:19|20)\d\d([-/.]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([-/.]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d|(?:19|20)\d\d")


@cache
def dictionary(vocabulary: str | None = VOCABULARY) -> dict[str, int]:
    """Rank of each word, from 1."""
    words = dict.fromkeys(WORDS)
    if vocabulary and Path(vocabulary).exists():
        pieces = json.loads(Path(vocabulary).read_text())["model"]["vocab"]
        whole = (k[:-4] for k in sorted(pieces, key=pieces.get) if k.endswith("</w>"))
        words |= dict.fromkeys(w for w in whole if SHORTEST <= len(w) <= LONGEST and w.isascii() and w.isalpha())
    return {w: i + 1 for i, w in enumerate(words)}


def guesses(value: str, ranks: dict[str, int] | None = None) -> float:
    """log10 of the guesses for a value: the cheapest cut into spans. A cut into many spans costs their order, too."""
    ranks = dictionary() if ranks is None else ranks
    low = value.lower()
    plain = low.translate(LEET)
    n = len(value)
    ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]  # of each end: (start, cost)
    walk = run = 0
    for i in range(n):
        if i and (low[i - 1], low[i]) in NEXT:
            if i + 1 == n or (low[i], low[i + 1]) not in NEXT:
                if i - walk >= 2:
                    ends[i + 1].append((walk, math.log10(4 * 47 * (i - walk + 1))))
                walk = i + 1
        else:
            walk = i
        if i and low[i] == low[i - 1]:
            if i - run >= 2 and (i + 1 == n or low[i + 1] != low[i]):
                ends[i + 1].append((run, 1 + math.log10(i - run + 1)))
        else:
            run = i
        for size in range(SHORTEST, min(LONGEST, n - i) + 1):
            rank = ranks.get(low[i : i + size])
            swap = ranks.get(plain[i : i + size]) if rank is None else None
            if rank or swap:
                cost = math.log10((rank or swap) + 1) + (0.6 if swap else 0) + (0 if value[i : i + size].islower() else 0.3)
                ends[i + size].append((i, cost))
    for m in DATE.finditer(value):
        ends[m.end()].append((m.start(), math.log10(365 * 120) if m.end() - m.start() > 4 else 2.1))
    for m in re.finditer(r"(.{2,8}?)\1+", value):  # a block that is repeated costs as much as the block
        ends[m.end()].append((m.start(), len(m[1]) + math.log10((m.end() - m.start()) / len(m[1]))))
    best = [0.0] * (n + 1)
    for j in range(1, n + 1):
        best[j] = min([best[j - 1] + 1, *(best[i] + cost + 0.3 for i, cost in ends[j])])
    return best[n]


def spans(text: str, least: float = LEAST, ranks: dict[str, int] | None = None) -> list[tuple[int, int, int]]:
    """(start, index of the kind, end), sorted."""
    low = text.lower()
    found = [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)] + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if any(x in low for x in ASSIGN_HINTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end() - m.start(2) >= 8]
    if any(x in low for x in HINTS):
        for m in CONTEXT.finditer(text):
            value = m["value"].rstrip(CLOSERS)
            # after `is` and without a quote, letters alone can't be told from a word of prose
            word = m["prose"] and not m["quote"] and value.isalpha()
            if len(value) >= 8 and not word and guesses(value, ranks) >= least:
                found.append((m.start("value"), 3, m.start("value") + len(value)))
    return sorted(found)


def scan(docs: DataFrame, least: float = LEAST, vocabulary: str | None = VOCABULARY) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_guess.

    The vocabulary is read at the driver and sent to the executors: less than 1 MB."""
    ranks = docs.sparkSession.sparkContext.broadcast(dictionary(vocabulary))

    def find(batches):
        for batch in rolling.chunks(batches, "text"):
            counts, base, every = [], [], []
            for text in batch.column("text").to_pylist():
                found = spans(text or "", least, ranks.value)
                said = [f"{KINDS[k]}:{a}:{b}" for a, k, b in found]
                counts.append([sum(x[1] == k for x in found) for k in range(4)])
                base.append(hashlib.sha256(",".join(x for x, (_, k, _) in zip(said, found, strict=True) if k < 3).encode()).hexdigest())
                every.append(",".join(said))
            n = [pa.array([x[k] for x in counts], pa.int64()) for k in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *n[:3], pa.array(base, pa.string()), pa.array(every, pa.string()), n[3]], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_guess"])

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(find, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_guess long")
