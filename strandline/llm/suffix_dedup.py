"""Removal of byte strings that occur elsewhere, by prefix-free parsing.

Rolling-hash triggers cut the corpus into phrases (``repeats``). Neighbouring phrases overlap
by the window length less one, so every string of that length lies in one phrase. The
dictionary holds each different phrase once, the parse says where phrases occur and how often.
The dictionary's suffixes are sorted by prefix doubling, to the depth of the window; how many
corpus suffixes stand at one place of that order is the sum of the parse's occurrences of the
phrases there, which is all that the parse's own order adds at this depth. Neighbours in this
corpus order that agree to the full depth are the repeated strings. On highly repetitive text
the dictionary is far smaller than the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm import repeats

LENGTH = 400
GRAM = 128
FIRST = 8  # bytes ranked at once at the start


def ranks_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rank in sorted order, how many share it) of every key."""
    _, rank, many = np.unique(keys, return_inverse=True, return_counts=True)
    return rank, many[rank]


def sorted_suffixes(data: np.ndarray, left: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the suffixes that agree with another to ``depth`` bytes, and their ranks.

    ``left`` are the bytes from each start to the end of its phrase. Ranks of 8 bytes are
    doubled up to the depth. A start whose rank is its own is in place and is dropped.
    """
    if depth < FIRST:
        raise ValueError(f"depth must be at least {FIRST}")
    at = np.flatnonzero(left >= FIRST)
    keys = np.zeros(len(at), np.uint64)
    for k in range(FIRST):  # big-endian, so numbers sort as bytes do
        keys = (keys << np.uint64(8)) | data[at + k]
    size = FIRST
    while True:
        rank, many = ranks_of(keys)
        shared = many > 1
        at, rank = at[shared], rank[shared]
        if size == depth or not len(at):
            return at, rank
        step = min(size, depth - size)
        size += step
        place = np.full(len(data) + 1, -1, np.int64)
        place[at] = rank
        on = left[at] >= size
        at, rank = at[on], rank[on]
        behind = place[at + step]
        on = behind >= 0
        at = at[on]
        keys = rank[on] * np.int64(len(data) + 1) + behind[on]


def repeated_starts(length: int) -> repeats.Compare:
    def compare(contents: list[bytes], first: list[int]) -> list[np.ndarray]:
        data = np.frombuffer(b"".join(contents), np.uint8)
        sizes = np.array([len(c) for c in contents])
        ends = np.cumsum(sizes)
        left = np.repeat(ends, sizes) - np.arange(len(data))
        starts, _ = sorted_suffixes(data, left, length)
        found = np.zeros(len(data), bool)
        found[starts] = True
        return [found[e - n : e - length + 1] for e, n in zip(ends.tolist(), sizes.tolist())]

    return compare


def remove_repeats(
    df: DataFrame, length: int = LENGTH, gram: int = GRAM, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) per row of ``df``.

    A byte of a text goes if it lies in a string of ``length`` bytes that also starts anywhere
    else in the table, overlaps and the same text included; that is judged on the texts as
    given. ``kept`` are the other bytes, ``n_spans`` the runs that were removed.

    Null and empty texts have no bytes. Equal rows are documents of their own, and as each holds
    what the other holds, both lose it. Rows with null or equal ids are told apart by their
    texts. An empty table gives no rows; other columns are not read. A text must fit into a
    task's memory some fifty times over while it is parsed.
    """
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    units = repeats.Units(False, length, gram)
    docs, spans = repeats.repeated_spans(rows, units, repeated_starts(length))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                out: list[tuple] = []
                for z, own in zip(piece.column("z").to_pylist(), piece.column("spans").to_pylist()):
                    raw = tool.decompress(z)
                    if not own:
                        out.append((len(raw), 0, 0, raw))
                        continue
                    mask = repeats.covered(own, len(raw))
                    kept = np.frombuffer(raw, np.uint8)[~mask].tobytes()
                    out.append((len(raw), len(raw) - len(kept), len(repeats.runs(mask)[0]), kept))
                columns = list(zip(*out)) or [()] * 4
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:3]),
                     pa.array(columns[3], pa.binary())],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    return docs.join(spans, ["doc", "tag"], "left").select("doc_id", "z", "spans").mapInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )
