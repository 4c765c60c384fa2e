"""Hard negatives: for each anchor and positive, the best rows of other labels in a score window.

A positive of score s asks for scores from low * s to high * s. The upper ends of an
anchor's positives cut the scores into disjoint slots. Tasks and their combination keep
the k best rows of other labels per slot, whatever number of windows overlaps there.
From the lowest slot upwards the slots are merged; what is merged down from a positive's
upper end holds its k best, of which those above its lower end are the answer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.topk import blocks_of
from strandline.llm.vectors import (
    LONG,
    SHARD_BATCHES,
    VECTOR_BATCHES,
    Best,
    fitted,
    leading,
    matrix,
    pieces,
    products,
    quantised,
)
from strandline.session import keep, scratch_path, settings

BLOCK_BYTES = 32 << 20  # of the anchors' vectors that are broadcast at once, or one anchor
STEP = 256  # anchors scored at once in a task


def store_shards(df: DataFrame, vec_id: str, vector: str, label: str, scale: float) -> DataFrame:
    """Stored shards (n, width, keys, ids, labels, vectors) of the rows that take part."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            at, vectors = quantised(batch.column("vector"), scale)
            ids, labels = (batch.column(c).take(pa.array(at)).to_numpy().astype("<i8") for c in ("vec_id", "label"))
            for lo, hi, width in pieces(vectors):
                keys = (task << 40) + made + np.arange(hi - lo, dtype="<i8")
                made += hi - lo
                blobs = (keys, ids[lo:hi], labels[lo:hi], matrix(vectors[lo:hi], width))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([hi - lo], pa.int32()), pa.array([width], pa.int32())]
                    + [pa.array([x.tobytes()], pa.binary()) for x in blobs],
                    ["n", "width", "keys", "ids", "labels", "vectors"],
                )

    rows = df.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"), F.col(label).cast("long").alias("label")
    ).dropna()
    with settings(df.sparkSession, VECTOR_BATCHES):
        stored = rows.mapInArrow(shards, "n int, width int, keys binary, ids binary, labels binary, vectors binary")
        return keep(stored, "negatives-index")


class Shard:
    def __init__(self, row: dict, width: int):
        self.keys, self.ids, self.labels = (np.frombuffer(row[c], "<i8") for c in ("keys", "ids", "labels"))
        self.vectors = fitted(row["vectors"], row["n"], width)


class Anchors:
    """A block of anchors as arrays, as it is sent to the tasks."""

    def __init__(self, rows: list, width: int):
        self.keys = np.array([r["anchor_key"] for r in rows], np.int64)
        self.labels = np.array([r["label"] for r in rows], np.int64)
        self.vectors = fitted(b"".join(r["vector"] for r in rows), len(rows), width)
        if "upper" in rows[0]:
            self.upper, self.lower = (np.array([r[c] for r in rows], np.int64) for c in ("upper", "lower"))


def percent_of(score: np.ndarray, percent: int, up: bool) -> np.ndarray:
    """percent * score / 100 rounded down, or up, without leaving the longs."""
    if up:
        hundreds, rest = -(score // -100), score - 100 * -(score // -100)
        return percent * hundreds - (-percent * rest) // 100
    hundreds, rest = score // 100, score % 100
    return percent * hundreds + (percent * rest) // 100


def nearest(anchors: Anchors, shards: Iterator[Shard], k: int) -> Best:
    """Each anchor's ``k`` best other rows of its own label; groups are anchors."""
    best = Best(len(anchors.keys), k)
    for shard in shards:
        for label in np.intersect1d(anchors.labels, shard.labels):
            own = np.flatnonzero(shard.labels == label)
            asking = np.flatnonzero(anchors.labels == label)
            for lo in range(0, len(asking), STEP):
                some = asking[lo : lo + STEP]
                scores = products(anchors.vectors[some], shard.vectors[own])
                others = anchors.keys[some][:, None] != shard.keys[own][None, :]
                row, column = leading(scores, others, best.floor[some], k)
                best.add(some[row], shard.ids[own[column]], scores[row, column])
    return best


def slots(anchors: Anchors, shards: Iterator[Shard], k: int) -> Best:
    """The ``k`` best rows of other labels per slot; groups are anchor * slots + slot.

    Slot i lies below the upper end of positive i and above that of positive i + 1. What
    lies below the lower end of positive i is in none of the windows that reach slot i.
    """
    n = anchors.upper.shape[1]
    best = Best(len(anchors.keys) * n, k)
    bottom = np.concatenate([anchors.upper[:, 1:], np.full((len(anchors.keys), 1), LONG.min)], axis=1)
    for shard in shards:
        for lo in range(0, len(anchors.keys), STEP):
            some = np.arange(lo, min(lo + STEP, len(anchors.keys)))
            scores = products(anchors.vectors[some], shard.vectors)
            other = anchors.labels[some][:, None] != shard.labels[None, :]
            for i in range(n):
                inside = other & (scores <= anchors.upper[some, i, None]) & (scores > bottom[some, i, None])
                floor = np.maximum(best.floor[some * n + i], anchors.lower[some, i])
                row, column = leading(scores, inside, floor, k)
                best.add(some[row] * n + i, shard.ids[column], scores[row, column])
    return best


def run_blocks(
    stored: DataFrame, index: DataFrame, width: int, work: Callable[[Anchors, Iterator[Shard], int], Best], k: int, groups: int
) -> DataFrame:
    """Send the stored anchors to all shards in blocks; rows (anchor_key, slot, score, vec_id)."""
    spark, schema = index.sparkSession, "anchor_key long, slot int, score long, vec_id long"
    path = scratch_path(spark, "negatives-found")
    spark.createDataFrame([], schema).write.parquet(path)
    with settings(spark, SHARD_BATCHES):
        for block in blocks_of(stored, max(1, BLOCK_BYTES // (8 * width))):
            sent = spark.sparkContext.broadcast(Anchors(block, width))

            def answer(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
                shards = (Shard(row, width) for batch in batches for row in batch.to_pylist())
                best = work(sent.value, shards, k)
                columns = [
                    sent.value.keys[best.group // groups], (best.group % groups).astype(np.int32), best.scores, best.ids
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor_key", "slot", "score", "vec_id"])

            index.mapInArrow(answer, schema).write.mode("append").parquet(path)
            sent.destroy()
    return spark.read.schema(schema).parquet(path)


def mine(
    df: DataFrame,
    anchors: str,
    k: int = 3,
    positives: int = 5,
    low_percent: int = 50,
    high_percent: int = 95,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: float = 256.0,
) -> DataFrame:
    """Hard negatives of every row that fulfils the SQL condition ``anchors``.

    The condition may use ``vec_id`` and ``label``. A score is the inner product of the
    components floor(scale * x); higher ones come first, ties by smaller id. An anchor's
    positives are its first ``positives`` other rows of its label. For each, the first ``k``
    rows of other labels count whose score is from low_percent to high_percent of the
    positive's (both ends included; percentages up to 100).

    Returns anchor_id, positive_id, rank (from 1), negative_id, positive_score,
    negative_score. A positive whose window holds no row has none.

    A row whose id, label or vector is null, or whose vector holds a null or non-finite
    component, takes no part. A shorter vector counts as filled up with zeros; an empty one
    has score 0 with all. Scores beyond a long count as the nearest long. Rows of equal id
    are rows of their own, and a row is kept out of its own positives only. A positive of
    score 0 asks for scores of 0, one below 0 for none. An empty table gives no rows. Other
    columns are not read; ``label`` must be a whole number.

    Anchors go to all shards in blocks of bounded size, two jobs a block. A task hands on
    ``k`` rows per anchor and slot at most, so nothing depends on how rows or labels repeat.
    """
    spark = df.sparkSession
    index = store_shards(df, vec_id, vector, label, scale)
    width = index.agg(F.max("width")).first()[0] or 1

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row, width)
                vectors = pa.array([v.tobytes() for v in shard.vectors], pa.binary())
                columns = [pa.array(x) for x in (shard.keys, shard.ids, shard.labels)]
                yield pa.RecordBatch.from_arrays([*columns, vectors], ["anchor_key", "vec_id", "label", "vector"])

    with settings(spark, SHARD_BATCHES):
        rows = index.mapInArrow(unpacked, "anchor_key long, vec_id long, label long, vector binary")
        asking = keep(rows.where(anchors).withColumnRenamed("vec_id", "anchor_id"), "negatives-anchors")

    near = run_blocks(asking, index, width, nearest, positives, 1)
    order = Window.partitionBy("anchor_key").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("at", F.row_number().over(order)).where(F.col("at") <= positives)
    # at most ``positives`` rows of an anchor
    own = ranked.groupBy("anchor_key").agg(F.array_sort(F.collect_list(F.struct("at", "vec_id", "score"))).alias("own"))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            upper, lower = [], []
            for row in batch.column("own").to_pylist():
                scores = np.array([p["score"] for p in row], np.int64)
                missing = positives - len(scores)
                # a positive that is not there has an empty slot and window
                upper.append(percent_of(scores, high_percent, False).tolist() + [LONG.min] * missing)
                lower.append(percent_of(scores, low_percent, True).tolist() + [LONG.max] * missing)
            columns = [batch.column(c) for c in ("anchor_key", "anchor_id", "label", "vector", "own")]
            ends = [pa.array(x, pa.list_(pa.int64())) for x in (upper, lower)]
            yield pa.RecordBatch.from_arrays([*columns, *ends], names)

    names = ["anchor_key", "anchor_id", "label", "vector", "own", "upper", "lower"]
    joined = asking.join(own, "anchor_key").select(*names[:-2])
    kind = ", ".join(f"{c} {t}" for c, t in joined.dtypes)
    with settings(spark, VECTOR_BATCHES):
        asking = keep(joined.mapInArrow(windows, f"{kind}, upper array<long>, lower array<long>"), "negatives-windows")

    found = run_blocks(asking, index, width, slots, k, positives)
    order = Window.partitionBy("anchor_key", "slot").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k)
    # at most ``k`` rows of each slot
    per_anchor = ranked.groupBy("anchor_key").agg(
        F.array_sort(F.collect_list(F.struct("slot", "at", "vec_id", "score"))).alias("found")
    )

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                by_slot: list[list[dict]] = [[] for _ in range(positives)]
                for x in row["found"]:
                    by_slot[x["slot"]].append(x)
                best: list[dict] = []
                for i in reversed(range(len(row["own"]))):
                    best = (by_slot[i] + best)[:k]
                    positive = row["own"][i]
                    inside = [x for x in best if x["score"] >= row["lower"][i]]
                    out += [
                        (row["anchor_id"], positive["vec_id"], rank, x["vec_id"], positive["score"], x["score"])
                        for rank, x in enumerate(inside, 1)
                    ]
            if out:
                kinds = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 3]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], results)

    results = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    ends = asking.select("anchor_key", "anchor_id", "own", "lower")
    return per_anchor.join(ends, "anchor_key").mapInArrow(
        merged,
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long",
    )
