"""Suffix sort with a difference cover, one bucket of suffixes at a time.

Suffixes are sorted as far as their first `length` bytes. The sample, all positions whose residue modulo the period
lies in a difference cover, is ranked first, by its first `period` bytes and then, as a sampled position plus a
period is sampled, by pairs of ranks for twice, four times .. as many bytes. The suffixes asked for are taken bucket
by bucket of their first two bytes, and sorted by their first `period` bytes. Two that agree in these are told apart
by rank: for their residues there is a shift below the period that takes both into the sample. So memory holds the
sample's ranks and one bucket's keys, however long the ties."""

from __future__ import annotations

import numpy as np

# A perfect difference set. Every residue modulo 13 but 0 is exactly one difference of two of them.
PERIOD, COVER = 13, (0, 1, 3, 9)
#: Suffixes of a bucket, where the first two bytes allow it.
BUCKET = 1 << 17


def shifts(period: int, cover: tuple[int, ...]) -> np.ndarray:
    """For each pair of residues, the smallest shift that takes both into the cover."""
    inside = np.isin(np.arange(2 * period) % period, cover)
    both = np.array([[[inside[a + d] and inside[b + d] for d in range(period)] for b in range(period)] for a in range(period)])
    if not both.any(2).all():
        raise ValueError("not a difference cover")
    return both.argmax(2)


SHIFTS = shifts(PERIOD, COVER)


def _words(text: np.ndarray, n: int) -> np.ndarray:
    """The eight bytes from each of the first n positions on, as numbers that sort alike."""
    out = np.zeros(n, np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | text[k : k + n]
    return out


def _dense(key: np.ndarray) -> np.ndarray:
    """Rank of each number, from 1, equal for equal ones."""
    return np.unique(key, return_inverse=True)[1].astype(np.int64) + 1


class Suffixes:
    """text: bytes; length: how far suffixes are compared, eight bytes at least."""

    def __init__(self, text: np.ndarray, length: int):
        n = len(text)
        padded = np.concatenate([text, np.zeros(length + 2 * PERIOD + 16, np.uint8)])
        self.length, self.eight = length, _words(padded, n + length + PERIOD)
        self.rank = np.zeros(n + 2 * PERIOD, np.int64)
        at = np.flatnonzero(np.isin(np.arange(n) % PERIOD, COVER))
        if not len(at):
            return
        rank = _dense(_dense(self.eight[at]) * (len(at) + 1) + _dense(self._tail(at)))
        have, slot = PERIOD, np.full(n, -1, np.int64)
        slot[at] = np.arange(len(at))
        while have < length and rank.max() < len(at):
            far = at + have
            next_ = np.where(far < n, rank[slot[np.minimum(far, n - 1)]], 0)
            rank = _dense(rank * (len(at) + 1) + next_)
            have *= 2
        self.rank[at] = rank

    def _tail(self, at: np.ndarray) -> np.ndarray:
        """Bytes 8 to PERIOD."""
        return self.eight[at + 8] >> np.uint64(8 * (16 - PERIOD))

    def sort(self, at: np.ndarray) -> np.ndarray:
        """at, in the order of the suffixes that begin there."""
        group = self._tied(at)
        by = np.argsort(group, kind="stable")
        at, group = at[by], group[by]
        tied = np.zeros(len(at), bool)
        tied[1:] = group[1:] == group[:-1]
        tied[:-1] |= tied[1:]
        some = np.flatnonzero(tied)
        below = self._below(at[some], group[some])
        out = at.copy()
        out[some] = at[some[np.lexsort((below, group[some]))]]
        return out

    def _tied(self, at: np.ndarray) -> np.ndarray:
        """Rank by the first PERIOD bytes."""
        return _dense(_dense(self.eight[at]) * (len(at) + 1) + _dense(self._tail(at)))

    def _below(self, at: np.ndarray, group: np.ndarray) -> np.ndarray:
        """How many of its group sort before each suffix, by the ranks of the sample."""
        below, top = np.zeros(len(at), np.int64), len(self.rank) + 1
        residue = at % PERIOD
        mine = [np.flatnonzero(residue == r) for r in range(PERIOD)]
        for b in range(PERIOD):
            keys: dict[int, np.ndarray] = {}
            for a in range(PERIOD):
                if not len(mine[a]) or not len(mine[b]):
                    continue
                d = int(SHIFTS[a][b])
                if d not in keys:
                    keys[d] = np.sort(group[mine[b]] * top + self.rank[at[mine[b]] + d])
                base = group[mine[a]] * top
                below[mine[a]] += np.searchsorted(keys[d], base + self.rank[at[mine[a]] + d]) - np.searchsorted(keys[d], base)
        return below

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the suffixes agree in their first `length` bytes."""
        same = np.arange(len(a))
        for k in [*range(0, self.length - 8, 8), self.length - 8]:
            same = same[self.eight[a[same] + k] == self.eight[b[same] + k]]
        out = np.zeros(len(a), bool)
        out[same] = True
        return out

    def buckets(self, at: np.ndarray, most: int = BUCKET) -> list[np.ndarray]:
        """at, cut by the first two bytes of its suffixes, in order."""
        lead = (self.eight[at] >> np.uint64(48)).astype(np.int64)
        upto = np.cumsum(np.bincount(lead, minlength=1 << 16))
        out, low = [], 0
        while low < 1 << 16:
            done = int(upto[low - 1]) if low else 0
            high = max(low + 1, int(np.searchsorted(upto, done + most, "right")))
            if (own := at[(lead >= low) & (lead < high)]).size:
                out.append(own)
            low = high
        return out

    def classes(self, at: np.ndarray, most: int = BUCKET) -> np.ndarray:
        """A number for each of the distinct suffixes `at`: equal where their first `length` bytes are."""
        out, so_far = np.zeros(int(at.max()) + 1 if len(at) else 0, np.int64), 0
        for own in self.buckets(at, most):
            own = self.sort(own)
            name = np.cumsum(np.r_[False, ~self.equal(own[1:], own[:-1])]) + so_far
            out[own] = name
            so_far = int(name[-1]) + 1
        return out[at]
