"""Exact top-k search by inner product over an impact-ordered index.

Vectors are quantised to integers. A component is a posting (dimension, vector,
impact); a shard keeps its postings in segments of falling impact level, where the
level is the bit length of the absolute impact. A block of queries is scored a
segment level at a time. After each level the part of a vector not yet scored has a
known norm, so by Cauchy-Schwarz its score lies within norm(query) * norm(rest) of
what is accumulated. Once few vectors can still reach the k-th best lower bound, no
further level is processed and exactly these are rescored from their full vectors, in
whole numbers. What is accumulated only bounds the scores; its rounding is allowed for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.vectors import LONG, fitted, matrix, pair_products, quantised
from strandline.session import keep, scratch_path

SHARD = 4096  # vectors of a shard
BLOCK = 4096  # queries sent to all shards at once: their vectors are all that is broadcast
STEP = 256  # queries scored at once in a task
FEW = 8  # rescore once on average fewer than FEW * k vectors per query are possible


def levels(values: np.ndarray) -> np.ndarray:
    """Bit length of the absolute impact; 0 for no posting."""
    return np.frexp(np.abs(values))[1] * (values != 0)


def build_index(df: DataFrame, vec_id: str, vector: str, scale: float) -> DataFrame:
    """Stored shards: ids, row keys, vectors, and postings in segments of falling level."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            for lo in range(0, batch.num_rows, SHARD):
                piece = batch.slice(lo, SHARD)
                at, vectors = quantised(piece.column("vector"), scale)
                if not len(at):
                    continue
                dims = max(map(len, vectors))
                if not dims:
                    dims = 1
                full = matrix(vectors, dims)
                ids = piece.column("vec_id").take(pa.array(at)).to_numpy(zero_copy_only=False).astype("<i8")
                keys = (task << 40) + (made << 16) + np.arange(len(at), dtype="<i8")
                made += 1
                level = levels(full)
                row, dim = np.nonzero(level)
                order = np.argsort(-level[row, dim], kind="stable")
                row, dim = row[order], dim[order]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([dims], pa.int32()), pa.array([len(at)], pa.int32()),
                        *(pa.array([x.tobytes()], pa.binary()) for x in (
                            ids, keys, full, row.astype("<u2"), dim.astype("<u4"), level[row, dim].astype("<u2")
                        )),
                    ],
                    ["dims", "n", "ids", "keys", "vectors", "post_row", "post_dim", "post_level"],
                )

    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    # few batches of one task go into one shard each, whatever the batch size
    return keep(
        rows.where("vec_id IS NOT NULL AND vector IS NOT NULL").mapInArrow(
            shards,
            "dims int, n int, ids binary, keys binary, vectors binary, "
            "post_row binary, post_dim binary, post_level binary",
        ),
        "topk-index",
    )


class Shard:
    def __init__(self, row: dict, dims: int):
        n = row["n"]
        self.ids, self.keys = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["keys"], "<i8")
        # components beyond the shorter of two vectors count as 0
        self.full = fitted(row["vectors"], n, dims)
        post_row, post_dim = np.frombuffer(row["post_row"], "<u2"), np.frombuffer(row["post_dim"], "<u4")
        level = np.frombuffer(row["post_level"], "<u2")
        fits = post_dim < dims
        post_row, post_dim, level = post_row[fits], post_dim[fits], level[fits]
        cuts = np.flatnonzero(np.diff(level.astype(int), prepend=-1))
        self.segments = [
            (post_row[a:b], post_dim[a:b]) for a, b in zip(cuts, [*cuts[1:], len(level)])
        ]
        # norms of what is left after each segment, summed from the smallest impacts upwards
        left = np.zeros(n)
        self.rests = []
        with np.errstate(over="ignore"):
            for post_row, post_dim in reversed(self.segments):
                self.rests.insert(0, np.sqrt(left))
                left = left + np.bincount(post_row, self.full[post_row, post_dim] ** 2, minlength=n)
            self.norms = np.sqrt(left)


def score_block(shard: Shard, queries: np.ndarray, keys: np.ndarray, floor: np.ndarray, k: int):
    """(query, vector, score) of all vectors of the shard that may be among a query's k best.

    ``floor`` are scores that k other vectors already reach. A bound that is too large for a
    double excludes nothing.
    """
    n, width = len(shard.ids), queries.shape[1]
    with np.errstate(over="ignore", invalid="ignore"):
        top = np.abs(queries).max(initial=0) * np.abs(shard.full).max(initial=0) * width
        kind = np.float32 if top < 1 << 24 else np.float64
        asked = queries.astype(kind)
        norms = np.sqrt((queries**2).sum(1))
        # sums below 2^24, or 2^53, are exact in the numbers used for them
        rounding = 0.0 if top < 2.0**53 else norms[:, None] * shard.norms[None, :] * (8 * width * 2.0**-53)
        acc = np.zeros((len(queries), n), kind)
        self_row = keys[:, None] == shard.keys[None, :]
        possible = ~self_row
        typical = shard.norms[: min(n, 256)].mean()
        for number, ((row, dim), rest) in enumerate(zip(shard.segments, shard.rests)):
            plane = np.zeros((n, width), kind)
            plane[row, dim] = shard.full[row, dim]
            acc += asked @ plane.T
            last = number == len(shard.segments) - 1
            if not last and np.median(rest) * 4 > typical:
                continue  # most of the weight is still to come
            slack = rounding if last else norms[:, None] * rest[None, :] * (1 + 1e-6) + 1 + rounding
            lower = np.where(self_row, -np.inf, acc - slack)
            # scores end at the longs
            lower = np.clip(np.nan_to_num(lower, nan=-np.inf, posinf=np.inf, neginf=-np.inf), -np.inf, float(LONG.max))
            reached = floor
            if n > k:
                reached = np.maximum(floor, np.partition(lower, n - k, axis=1)[:, n - k])
            upper = np.maximum(acc + slack, float(LONG.min))
            possible = ~(upper < reached[:, None]) & ~self_row
            if last or possible.sum() <= FEW * k * len(queries):
                break
    q, v = np.nonzero(possible)
    scores = np.empty(len(q), np.int64)
    for lo in range(0, len(q), 100_000):
        a, b = q[lo : lo + 100_000], v[lo : lo + 100_000]
        scores[lo : lo + 100_000] = pair_products(queries[a], shard.full[b])
    return q, v, scores


def best(q: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of each query's k best by falling score, then rising id."""
    order = np.lexsort((ids, ~scores, q))  # ~s is -s - 1, and never overflows
    sorted_q = q[order]
    first = np.flatnonzero(np.diff(sorted_q, prepend=-1))
    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    return order[rank < k]


def search(
    df: DataFrame,
    queries: str,
    k: int = 20,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    scale: float = 64.0,
) -> DataFrame:
    """The ``k`` best other rows for every row that fulfils the SQL condition ``queries``.

    The condition may use ``vec_id``, the row's id. Returns query_id, rank (from 1),
    vec_id, score: the highest inner products of the components floor(scale * x), ties to
    the smaller id. With fewer than ``k`` other rows all are returned.

    A row whose id or vector is null, or whose vector has a null or non-finite component,
    takes no part. A score beyond a long counts as the nearest long, whatever the components.
    A shorter vector counts as filled up with zeros. Rows with equal ids are rows of their own; a row is excluded
    only from its own result. An empty table gives no rows; other columns are not read.

    Queries go to all shards in blocks of ``BLOCK``, one job for each block; a task hands
    on the k best of all its shards.
    """
    index = build_index(df, vec_id, vector, scale)
    dims = index.agg(F.max("dims")).first()[0] or 1
    session = df.sparkSession
    path = scratch_path(session, "topk-result")
    schema = "query_key long, query_id long, vec_id long, score long"

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row, dims)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.keys), pa.array(shard.ids),
                     pa.array([v.tobytes() for v in shard.full.astype("<f8")], pa.binary())],
                    ["query_key", "vec_id", "vector"],
                )

    chosen = keep(
        index.mapInArrow(asked, "query_key long, vec_id long, vector binary").where(queries), "topk-queries"
    )
    number = -1
    for number, block in enumerate(blocks_of(chosen, BLOCK)):
        keys = np.array([r["query_key"] for r in block], np.int64)
        names = np.array([r["vec_id"] for r in block], np.int64)
        wanted = np.frombuffer(b"".join(r["vector"] for r in block), "<f8").reshape(len(block), dims)
        sent = session.sparkContext.broadcast((keys, names, wanted))

        def answer(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            keys, names, wanted = sent.value
            q = np.zeros(0, np.int64)
            ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
            floor = np.full(len(keys), -np.inf)
            for batch in batches:
                for row in batch.to_pylist():
                    shard = Shard(row, dims)
                    parts = [(q, ids, scores)]
                    for lo in range(0, len(keys), STEP):
                        hi = lo + STEP
                        a, b, s = score_block(shard, wanted[lo:hi], keys[lo:hi], floor[lo:hi], k)
                        parts.append((a + lo, shard.ids[b], s))
                    q, ids, scores = (np.concatenate(x) for x in zip(*parts))
                    top = best(q, ids, scores, k)
                    q, ids, scores = q[top], ids[top], scores[top]
                    ends = np.flatnonzero(np.diff(q, append=-1))
                    counts = np.bincount(q, minlength=len(keys))
                    full = ends[counts[q[ends]] == k] if len(q) else ends[:0]
                    # rounded down: a larger floor could cut off a score that reaches it
                    floor[q[full]] = np.nextafter(scores[full].astype(np.float64), -np.inf)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[q]), pa.array(names[q]), pa.array(ids), pa.array(scores)],
                ["query_key", "query_id", "vec_id", "score"],
            )

        index.mapInArrow(answer, schema).write.mode("append").parquet(path)
    if number < 0:
        found = session.createDataFrame([], schema)
    else:
        found = session.read.schema(schema).parquet(path)
    order = Window.partitionBy("query_key").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def blocks_of(df: DataFrame, size: int) -> Iterator[list]:
    """Rows of a stored frame in lists of ``size``; no more than that is held."""
    held = []
    for row in df.toLocalIterator():
        held.append(row)
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held
