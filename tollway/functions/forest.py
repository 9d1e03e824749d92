"""Isolation forest for one feature, on sorted values.

Trees are grown from random samples of at most 256 values: a node is cut at a uniform point between its smallest and
largest value until one distinct value is left or the depth limit is reached. A value's score is 2^(-mean depth /
c(sample size)); scores above one half are outliers."""

from __future__ import annotations

import hashlib
import math

import numpy as np

SAMPLE = 256
EULER = 0.5772156649015329


def mean_depth(n: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search in a binary tree of n values."""
    n = np.asarray(n, float)
    with np.errstate(divide="ignore", invalid="ignore"):
        many = 2 * (np.log(n - 1) + EULER) - 2 * (n - 1) / n
    return np.where(n > 2, many, np.where(n == 2, 1.0, 0.0))


def _tree(sample: np.ndarray, rng: np.random.Generator, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Cuts in ascending order, and the path length of each of the intervals they make."""
    cuts, depths = [], []
    stack = [(0, len(sample), 0)]
    while stack:
        a, b, depth = stack.pop()
        if depth >= limit or b - a <= 1 or sample[a] == sample[b - 1]:
            depths.append(depth + float(mean_depth(b - a)))
            continue
        cut = rng.uniform(sample[a], sample[b - 1])
        m = a + int(np.searchsorted(sample[a:b], cut, "right"))
        m = min(max(m, a + 1), b - 1)
        # left part first: intervals come out in order
        stack += [(m, b, depth + 1), (a, m, depth + 1)]
        cuts.append((sample[m - 1] + sample[m]) / 2 if not sample[m - 1] <= cut < sample[m] else cut)
    return np.sort(np.array(cuts)), np.array(depths)


def scores(values: np.ndarray, counts: np.ndarray, trees: int, seed: int) -> np.ndarray:
    """Scores of ascending distinct values, of which each stands for as many records as its count."""
    rng = np.random.default_rng(seed)
    upto = np.cumsum(counts)
    size = int(min(SAMPLE, upto[-1]))
    limit = math.ceil(math.log2(max(size, 2)))
    total = np.zeros(len(values))
    for _ in range(trees):
        drawn = np.sort(rng.choice(int(upto[-1]), size, replace=False))
        cuts, depths = _tree(values[np.searchsorted(upto, drawn, "right")], rng, limit)
        total += depths[np.searchsorted(cuts, values, "left")]
    return 2.0 ** (-total / trees / float(mean_depth(size)))


def inlier_mask(values: np.ndarray, counts: np.ndarray, trees: int, seed: int, name: str = "") -> np.ndarray:
    """Which of the ascending distinct values are no outliers; all, if there are two records or fewer or none would be left.

    The seed is joined with a name, so that results depend on neither partitioning nor order."""
    if counts.sum() <= 2:
        return np.ones(len(values), bool)
    own = int.from_bytes(hashlib.blake2b(f"{seed}:{name}".encode(), digest_size=8).digest(), "big")
    kept = scores(values, counts, trees, own) <= 0.5
    return kept if kept.any() else np.ones(len(values), bool)


def inliers(values: np.ndarray, trees: int, seed: int, name: str = "") -> np.ndarray:
    """The records that are no outliers, in ascending order."""
    distinct, counts = np.unique(values, return_counts=True)
    kept = inlier_mask(distinct, counts, trees, seed, name)
    return np.repeat(distinct[kept], counts[kept])


def weighted_median(values: np.ndarray, counts: np.ndarray) -> float:
    """Median of records, from ascending distinct values and their counts."""
    upto = np.cumsum(counts)
    n = int(upto[-1])
    low, high = np.searchsorted(upto, [(n - 1) // 2, n // 2], "right")
    return float(values[low] + values[high]) / 2
