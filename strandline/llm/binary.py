"""Token ids in binary shards with Elias-Fano document boundaries.

A shard holds the ids of consecutive documents one after another, each document
closed by an end id. The boundaries and the document ids are non-decreasing, so
both are kept as Elias-Fano sequences: per value the low bits as they are, and the
high bits as a bit vector with one set bit per value, about 2 + log2(range / count)
bits a value. Counts of set bits per block let ``select`` find any boundary without
a table of 64-bit offsets.

File layout, little-endian: ``magic, id width, documents without a doc_id, ids`` as
unsigned 64-bit numbers, shard key (two numbers), two sequences (boundaries, doc
ids), the ids; then one line feed from the text writer that commits the file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.llm.text import SMALL_BATCHES
from strandline.llm.tokens import default_tokenizer, encoder
from strandline.session import keep, settings

MAGIC = 0x31304644494C5345
BLOCK = 512  # bits of the high part per count of set bits
SHARD_IDS = 4_000_000  # ids after which a shard is closed
OFFSET = 1 << 63  # doc ids are stored above the smallest 64-bit number


class EliasFano:
    """A non-decreasing sequence of unsigned 64-bit numbers in near-minimal space."""

    def __init__(self, n: int, low_bits: int, first: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.low_bits, self.first = n, low_bits, first
        self.low, self.high, self.ones = low, high, ones

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        first = int(values[0]) if n else 0
        above = values - np.uint64(first)
        span = int(above[-1]) if n else 0
        low_bits = max(0, (span // n).bit_length() - 1) if n else 0
        high = (above >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros((span >> low_bits) + n + 1, np.uint8)
        bits[high] = 1
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = ((above[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
        blocks = np.add.reduceat(bits, np.arange(0, len(bits), BLOCK), dtype=np.int64)
        ones = (np.cumsum(blocks) - blocks).astype(np.uint32)
        return cls(
            n, low_bits, first,
            np.packbits(low.ravel(), bitorder="little"), np.packbits(bits, bitorder="little"), ones,
        )

    def select(self, at: np.ndarray) -> np.ndarray:
        """The values at these positions, found through the block counts."""
        at = np.asarray(at, np.int64)
        block = np.searchsorted(self.ones, at, "right") - 1
        bits = np.unpackbits(self.high, bitorder="little")
        pad = -len(bits) % BLOCK
        rows = np.concatenate([bits, np.zeros(pad, np.uint8)]).reshape(-1, BLOCK)
        out = np.empty(len(at), np.uint64)
        step = 4096
        for lo in range(0, len(at), step):
            part, own = at[lo : lo + step], block[lo : lo + step]
            inside = np.cumsum(rows[own], axis=1, dtype=np.int32)
            nth = (part - self.ones[own] + 1).astype(np.int32)
            place = own * BLOCK + (inside < nth[:, None]).sum(1)
            out[lo : lo + step] = (place - part).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            low = np.unpackbits(self.low, bitorder="little", count=self.n * self.low_bits)
            shifts = np.arange(self.low_bits, dtype=np.uint64)
            chosen = low.reshape(self.n, self.low_bits)[at].astype(np.uint64)
            out |= (chosen << shifts).sum(1, dtype=np.uint64)
        return out + np.uint64(self.first)

    def tobytes(self) -> bytes:
        head = np.array(
            [self.n, self.low_bits, self.first, len(self.low), len(self.high), len(self.ones)], "<u8"
        )
        return b"".join(
            [head.tobytes(), self.low.tobytes(), self.high.tobytes(), self.ones.astype("<u4").tobytes()]
        )

    @classmethod
    def read(cls, blob: memoryview, at: int) -> tuple[EliasFano, int]:
        n, low_bits, first, *sizes = (int(x) for x in np.frombuffer(blob, "<u8", 6, at))
        at += 48
        low = np.frombuffer(blob, np.uint8, sizes[0], at)
        high = np.frombuffer(blob, np.uint8, sizes[1], at + sizes[0])
        ones = np.frombuffer(blob, "<u4", sizes[2], at + sizes[0] + sizes[1])
        return cls(n, low_bits, first, low, high, ones), at + sizes[0] + sizes[1] + 4 * sizes[2]


def shard_bytes(key: tuple[int, int], doc_ids: list, ids: np.ndarray, counts: np.ndarray, width: int) -> bytes:
    """One shard; documents without a doc_id must come first."""
    nulls = sum(d is None for d in doc_ids)
    known = np.array([d + OFFSET for d in doc_ids[nulls:]], np.uint64)
    bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.uint64)
    head = np.array([MAGIC, width, nulls, len(ids), *key], "<u8")
    return b"".join(
        [
            head.tobytes(),
            EliasFano.of(bounds).tobytes(),
            EliasFano.of(known).tobytes(),
            ids.astype("<u2" if width == 2 else "<u4").tobytes(),
        ]
    )


def read_shard(blob: bytes) -> tuple[tuple[int, int], list, np.ndarray, np.ndarray]:
    """(key, doc ids, boundaries, ids) of a shard."""
    magic, width, nulls, n, *key = (int(x) for x in np.frombuffer(blob, "<u8", 6))
    if magic != MAGIC:
        raise ValueError("not a token shard")
    bounds, at = EliasFano.read(blob, 48)
    known, at = EliasFano.read(blob, at)
    ids = np.frombuffer(blob, "<u2" if width == 2 else "<u4", n, at)
    doc_ids = [None] * nulls + [int(d) - OFFSET for d in known.select(np.arange(known.n))]
    return (key[0], key[1]), doc_ids, bounds.select(np.arange(bounds.n)).astype(np.int64), ids


def write_shards(
    df: DataFrame,
    path: str,
    text: str = "text",
    doc_id: str = "doc_id",
    tokenizer: str | None = None,
    end_id: int = 2,
    shard_ids: int = SHARD_IDS,
) -> None:
    """Write the ids of all texts into shard files below ``path``, in ascending doc_id order.

    A null text is empty and gives the end id alone. Null doc ids come first,
    repeated ones next to each other (their order is that of their texts). An empty
    table gives no shard. Other columns are not read. The rows are dealt by ranges
    of doc_id, so a source or group that dominates does not matter; each task closes
    a shard after ``shard_ids`` ids, which bounds its memory. Spark's writer commits
    the files, so a lost task leaves none.
    """
    path_to_tokenizer = tokenizer or default_tokenizer()

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(path_to_tokenizer)
        task, made = TaskContext.get().partitionId(), 0
        doc_ids, parts, counts, held = [], [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal doc_ids, parts, counts, held, made
            blob = shard_bytes((task, made), doc_ids, np.concatenate(parts), np.concatenate(counts), code.width)
            doc_ids, parts, counts, held, made = [], [], [], 0, made + 1
            return pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], ["blob"])

        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                piece = batch.slice(lo, 256)
                ids, lengths = code.encode(piece.column("text").to_pylist())
                ends = np.cumsum(lengths)
                parts.append(np.insert(ids, ends, end_id))
                counts.append(lengths + 1)
                doc_ids += piece.column("doc_id").to_pylist()
                held += len(parts[-1])
                if held >= shard_ids:
                    yield close()
        if doc_ids:
            yield close()

    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    blobs = ordered.mapInArrow(shards, "blob binary")
    with settings(df.sparkSession, SMALL_BATCHES):
        blobs.select(F.col("blob").cast("string")).write.option("maxRecordsPerFile", 1).text(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the shard files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it in all shards.
    """

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column("content"):
                (task, made), doc_ids, bounds, ids = read_shard(blob.as_buffer())
                wide = ids.astype("<u4")
                crcs = [zlib.crc32(wide[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                n = len(doc_ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, task)), pa.array(np.full(n, made)), pa.array(np.full(n, len(ids))),
                        pa.array(doc_ids, pa.int64()), pa.array(bounds[:-1]), pa.array(np.diff(bounds)),
                        pa.array(crcs, pa.int64()),
                    ],
                    ["task", "made", "shard_ids", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )

    files = spark.read.format("binaryFile").load(path).select("content")
    found = keep(
        files.mapInArrow(
            documents,
            "task long, made long, shard_ids long, doc_id long, inside long, n_tokens long, ids_crc32 long",
        ),
        "shard-rows",
    )
    per_task = found.groupBy("task", "made").agg(F.first("shard_ids").alias("shard_ids"))
    before = Window.orderBy("task", "made").rowsBetween(Window.unboundedPreceding, -1)
    # one row per shard, that is per some million ids
    starts = per_task.select(
        "task", "made", F.coalesce(F.sum("shard_ids").over(before), F.lit(0)).alias("before")
    )
    return found.join(starts, ["task", "made"]).select(
        "doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )
