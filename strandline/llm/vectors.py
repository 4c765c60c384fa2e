"""Quantised vectors in shards, and their exact integer inner products.

A component x becomes floor(scale * x), taken as a double, which holds a whole number of
any size; one beyond the largest double counts as that. Products are exact, and an inner
product beyond a long counts as the nearest long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

LARGEST = np.finfo(np.float64).max
LONG = np.iinfo(np.int64)
SHARD_ROWS = 4096
SHARD_BYTES = 8 << 20  # of a shard's vectors, or one vector
#: Rows of vectors, or of shards, that are handed to Python at once.
VECTOR_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}
SHARD_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "8"}


def quantised(column: pa.Array, scale: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions of the usable vectors, and their components as whole numbers in doubles.

    A vector that is null, or holds a null or non-finite component, is not usable.
    """
    at, out = [], []
    for i, value in enumerate(column):
        own = value.values if value.is_valid else None
        if own is None or own.null_count:
            continue
        x = np.asarray(own.to_numpy(zero_copy_only=False), np.float64)
        if np.isfinite(x).all():
            with np.errstate(over="ignore"):
                out.append(np.clip(np.floor(scale * x), -LARGEST, LARGEST))
            at.append(i)
    return np.array(at, np.int64), out


def pieces(vectors: list[np.ndarray]) -> Iterator[tuple[int, int, int]]:
    """(first, last + 1, width) of runs that fit into a shard, filled up to equal width."""
    lo, width = 0, 1
    for i, v in enumerate(vectors):
        wider = max(width, len(v))
        if i > lo and (i - lo == SHARD_ROWS or (i - lo + 1) * wider * 8 > SHARD_BYTES):
            yield lo, i, width
            lo, wider = i, max(1, len(v))
        width = wider
    if vectors:
        yield lo, len(vectors), width


def matrix(vectors: list[np.ndarray], width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    return out


def fitted(blob: bytes, rows: int, width: int) -> np.ndarray:
    """A stored matrix with its columns cut or filled up with zeros to ``width``."""
    full = np.frombuffer(blob, "<f8").reshape(rows, -1)
    out = np.zeros((rows, width))
    out[:, : full.shape[1]] = full[:, :width]
    return out


def largest(a: np.ndarray) -> np.ndarray:
    return np.abs(a).max(axis=1, initial=0)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of ``a`` with all rows of ``b`` as longs.

    Pairs whose sums stay below 2^53 are multiplied as doubles, others as long or unbounded
    integers; the results are the same.
    """
    width = max(a.shape[1], 1)
    plain = np.sqrt(2.0**52 / width)
    small_a, small_b = largest(a) <= plain, largest(b) <= plain
    if small_a.all() and small_b.all():
        return (a @ b.T).astype(np.int64)
    out = np.empty((len(a), len(b)), np.int64)
    out[np.ix_(small_a, small_b)] = a[small_a] @ b[small_b].T
    out[~small_a] = unbounded(a[~small_a], b)
    out[np.ix_(small_a, ~small_b)] = unbounded(a[small_a], b[~small_b])
    return out


def unbounded(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    top = float(largest(a).max()) * a.shape[1]
    if top < 2.0**62 and top * float(largest(b).max()) < 2.0**62 and largest(b).max() < 2.0**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    exact = whole(a) @ whole(b).T
    return np.clip(exact, LONG.min, LONG.max).astype(np.int64)


def pair_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner product of each row of ``a`` with the same row of ``b``, as ``products`` gives it."""
    out = np.empty(len(a), np.int64)
    top_a, top_b = largest(a), largest(b)
    with np.errstate(over="ignore"):
        plain = (top_a < 2.0**62) & (top_b < 2.0**62) & (top_a * top_b * max(a.shape[1], 1) < 2.0**62)
    out[plain] = np.einsum("ij,ij->i", a[plain].astype(np.int64), b[plain].astype(np.int64))
    for i in np.flatnonzero(~plain):
        exact = sum(int(x) * int(y) for x, y in zip(a[i].tolist(), b[i].tolist()))
        out[i] = min(max(exact, int(LONG.min)), int(LONG.max))
    return out


def whole(a: np.ndarray) -> np.ndarray:
    return np.array([[int(x) for x in row] for row in a.tolist()], object).reshape(a.shape)


class Best:
    """The ``k`` highest (score, then smallest id) entries of each of ``groups`` groups."""

    def __init__(self, groups: int, k: int):
        self.k = k
        self.group, self.ids, self.scores = (np.zeros(0, np.int64) for _ in range(3))
        self.floor = np.full(groups, LONG.min)  # scores that k entries reach already
        self.counts = np.zeros(groups, np.int64)

    def add(self, group: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        group = np.concatenate([self.group, group])
        ids, scores = np.concatenate([self.ids, ids]), np.concatenate([self.scores, scores])
        order = np.lexsort((ids, ~scores, group))  # ~s is -s - 1, and never overflows
        first = np.flatnonzero(np.diff(group[order], prepend=-1))
        rank = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
        order = order[rank < self.k]
        self.group, self.ids, self.scores = group[order], ids[order], scores[order]
        self.counts = np.bincount(self.group, minlength=len(self.floor))
        last = np.flatnonzero(np.diff(self.group, append=-1))
        full = last[self.counts[self.group[last]] == self.k]
        self.floor[self.group[full]] = self.scores[full]


def leading(scores: np.ndarray, allowed: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of all allowed scores that may be among their row's ``k`` highest.

    ``floor`` has per row a score that need not be undercut. Ties with the k-th are kept.
    """
    reach = floor
    if scores.shape[1] > k:
        seen = np.where(allowed, scores, LONG.min)
        reach = np.maximum(floor, np.partition(seen, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k])
    return np.nonzero(allowed & (scores >= reach[:, None]))
