"""Strings of a fixed length that start at two or more places of a corpus.

Both substring operators stand on this. A text (bytes or words) is cut into phrases
by triggers: the trigger of a window of ``window`` items is its ``gram`` items with the
smallest hash, and a phrase is what neighbouring windows with the same trigger cover.
So a phrase holds whole windows, every window lies in exactly one phrase, and equal
windows have equal triggers at equal places. Work then falls with what repeats:

- a phrase whose trigger is met once in the corpus holds no repeated window;
- a phrase that is met as a whole twice or more consists of repeated windows;
- different phrases with the same trigger are compared, each once however often it is
  met. Up to ``MOST_PHRASES`` of them are some megabytes, which one task compares; a trigger
  with more is split by window, each window being counted under its own 128-bit hash.

Documents are known by their id and a hash of their text, so null and repeated ids are
told apart. Nothing is collected; hot triggers meet in counts that are merged on the map
side and in joins that Spark may split.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm import text as tx
from strandline.session import keep, settings

MOST_PHRASES = 2048
GROUP_BYTES = 1_000_000  # phrases compared at once in a task; sorting takes some sixty times that
NULL_MARK = 0x5DEECE66D
LAST = (1 << 63) - 1  # document number of rows without an id


@dataclass(frozen=True)
class Units:
    """What the windows are made of: bytes, or words by their hash."""

    words: bool
    window: int
    gram: int

    def items(self, data: np.ndarray, bounds: np.ndarray):
        """(items, row boundaries in them, start and end byte of each item)."""
        if not self.words:
            return data, bounds, None, None
        starts, ends, rows, hashes = tx.word_hashes(data, bounds)
        return hashes, rows, starts, ends


def tags(data: np.ndarray, bounds: np.ndarray, doc_ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(document number, tag) that tell rows apart unless they are equal."""
    prefix = tx.prefix_hash(data)
    tag = tx.range_hash(prefix, bounds[:-1], bounds[1:])
    null = doc_ids.is_null().to_numpy(zero_copy_only=False)
    tag[null] ^= np.uint64(NULL_MARK)
    return doc_ids.fill_null(LAST).to_numpy(zero_copy_only=False), tag.view(np.int64)


def pack_place(lo: np.ndarray, windows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """First item, number of windows and the trigger's distance, in one number."""
    return (lo << 24) | (windows << 12) | anchor


def unpack_place(place):
    return place >> 24, (place >> 12) & 0xFFF, place & 0xFFF


def phrases(units: Units, data: np.ndarray, bounds: np.ndarray):
    """Per phrase of the rows: row, trigger, hash of the phrase, packed place."""
    items, rows, _, _ = units.items(data, bounds)
    n = len(items) - units.window + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 4
    prefix = tx.prefix_hash(items)
    grams = len(items) - units.gram + 1
    at = np.arange(grams)
    gram = tx.range_hash(prefix, at, at + units.gram)
    mins = tx.minimizers(gram, units.window - units.gram + 1)
    valid = np.flatnonzero(tx.within(rows, units.window, n))
    if not len(valid):
        return (np.zeros(0, np.int64),) * 4
    mins = mins[valid]
    new = np.ones(len(valid), bool)
    new[1:] = (np.diff(valid) != 1) | (np.diff(mins) != 0)
    first = np.flatnonzero(new)
    lo, anchor = valid[first], mins[first]
    windows = np.diff(np.append(first, len(valid)))
    row = np.searchsorted(rows, lo, "right") - 1
    whole = tx.range_hash(prefix, lo, lo + windows - 1 + units.window)
    whole = tx.mix(whole + (anchor - lo).astype(np.uint64))
    return row, gram[anchor].view(np.int64), whole.view(np.int64), pack_place(lo - rows[row], windows, anchor - lo)


def places(df: DataFrame, units: Units) -> DataFrame:
    """(trigger, phrase, doc, tag, place) of every phrase of (doc_id, text)."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, bounds in tx.texts(batch.column("text")):
                doc, tag = tags(data, bounds, batch.column("doc_id").slice(lo, hi - lo))
                row, trigger, phrase, place = phrases(units, data, bounds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (trigger, phrase, doc[row], tag[row], place)],
                    ["trigger", "phrase", "doc", "tag", "place"],
                )

    return df.mapInArrow(parse, "trigger long, phrase long, doc long, tag long, place long")


def packed(df: DataFrame) -> DataFrame:
    """(doc, tag, doc_id, z): the texts compressed, to be shuffled once more."""

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for lo, hi, data, bounds in tx.texts(batch.column("text")):
                ids = batch.column("doc_id").slice(lo, hi - lo)
                doc, tag = tags(data, bounds, ids)
                raw = data.tobytes()
                blobs = [tool.compress(raw[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc), pa.array(tag), ids, pa.array(blobs, pa.binary())],
                    ["doc", "tag", "doc_id", "z"],
                )

    return df.mapInArrow(shrink, "doc long, tag long, doc_id long, z binary")


def contents(docs: DataFrame, wanted: DataFrame, units: Units) -> DataFrame:
    """Add the phrase's bytes to rows of ``wanted``; words are joined by one blank."""
    per_doc = wanted.groupBy("doc", "tag").agg(
        F.collect_list(F.struct("trigger", "phrase", "met", "kinds", "place")).alias("rows")
    )

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                out: list[tuple] = []
                for row in batch.slice(at, 64).to_pylist():
                    text = tool.decompress(row["z"])
                    items = text.split() if units.words else text
                    for x in row["rows"]:
                        lo, windows, _ = unpack_place(x["place"])
                        part = items[lo : lo + windows - 1 + units.window]
                        out.append(
                            (x["trigger"], x["phrase"], x["met"], x["kinds"], row["doc"], row["tag"],
                             x["place"], b" ".join(part) if units.words else part)
                        )
                columns = list(zip(*out)) or [()] * 8
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, pa.int64()) for c in columns[:7]), pa.array(columns[7], pa.binary())],
                    ["trigger", "phrase", "met", "kinds", "doc", "tag", "place", "content"],
                )

    return docs.join(per_doc, ["doc", "tag"]).select("doc", "tag", "z", "rows").mapInArrow(
        fetch,
        "trigger long, phrase long, met long, kinds long, doc long, tag long, place long, content binary",
    )


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return edges[::2], edges[1::2]


#: Gets the contents of phrases and where each trigger's phrases begin; gives per phrase
#: which windows also start in another phrase of its trigger.
Compare = Callable[[list[bytes], list[int]], list[np.ndarray]]


def compared(rows: DataFrame, units: Units, compare: Compare) -> DataFrame:
    """Spans (doc, tag, lo, hi) of repeated windows in phrases that are met once."""

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size, last = 0, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["trigger"] != last and size >= GROUP_BYTES:
                    yield spans(held)
                    held, size = [], 0
                held.append(row)
                size += len(row["content"])
                last = row["trigger"]
        if held:
            yield spans(held)

    def spans(held: list[dict]) -> pa.RecordBatch:
        triggers = np.array([r["trigger"] for r in held])
        first = np.flatnonzero(np.diff(triggers, prepend=triggers[0] + 1)).tolist()
        masks = compare([r["content"] for r in held], first)
        out: list[list[int]] = [[], [], [], []]
        for row, mask in zip(held, masks):
            if row["met"] == 1:
                lo, _, _ = unpack_place(row["place"])
                for a, b in zip(*(x.tolist() for x in runs(mask))):
                    for column, value in zip(out, (row["doc"], row["tag"], lo + a, lo + b - 1 + units.window)):
                        column.append(value)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["doc", "tag", "lo", "hi"])

    few = rows.where(F.col("kinds") <= MOST_PHRASES).repartition("trigger").sortWithinPartitions("trigger")
    return few.mapInArrow(groups, "doc long, tag long, lo long, hi long")


def counted(rows: DataFrame, units: Units) -> DataFrame:
    """The same spans for triggers with very many phrases, window by window."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, bounds in tx.texts(batch.column("content")):
                items, own, _, _ = units.items(data, bounds)
                valid = np.flatnonzero(tx.within(own, units.window, max(0, len(items) - units.window + 1)))
                hashes = [
                    tx.range_hash(tx.prefix_hash(items, base), valid, valid + units.window, base).view(np.int64)
                    for base in (tx.BASE, tx.SECOND_BASE)
                ]
                row = np.searchsorted(own, valid, "right") - 1
                part = batch.slice(lo, hi - lo)
                start, _, _ = unpack_place(part.column("place").to_numpy())
                columns = [part.column(c).to_numpy()[row] for c in ("doc", "tag", "met")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (*hashes, *columns, start[row] + valid - own[row])],
                    ["h1", "h2", "doc", "tag", "met", "lo"],
                )

    many = rows.where(F.col("kinds") > MOST_PHRASES).mapInArrow(
        windows, "h1 long, h2 long, doc long, tag long, met long, lo long"
    )
    repeated = keep(
        many.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "windows"
    )
    found = many.where("met = 1").join(repeated, ["h1", "h2"], "left_semi")
    return found.select("doc", "tag", "lo", (F.col("lo") + units.window).alias("hi"))


def repeated_spans(df: DataFrame, units: Units, compare: Compare) -> tuple[DataFrame, DataFrame]:
    """(documents, spans) of (doc_id, text): per document of ``packed`` the item ranges covered
    by windows that start at another place too, as (doc, tag, spans: array of (lo, hi))."""
    with settings(df.sparkSession, tx.SMALL_BATCHES):
        every = places(df, units)
        # stored, so that the join has two plain sides and Spark may split a hot trigger
        often = keep(
            every.groupBy("trigger").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "triggers"
        )
        found = keep(every.join(often, "trigger", "left_semi"), "places")
        classes = keep(
            found.groupBy("trigger", "phrase").agg(
                F.count(F.lit(1)).alias("met"), F.min(F.struct("doc", "tag", "place")).alias("one")
            ),
            "phrases",
        )
        kinds = classes.groupBy("trigger").agg(
            F.count(F.lit(1)).alias("kinds"), F.min("met").alias("least")
        ).where("kinds > 1 AND least = 1").drop("least")
        kinds = keep(kinds, "kinds")
        wanted = classes.join(kinds, "trigger").select("trigger", "phrase", "met", "kinds", "one.*")
        docs = packed(df)
        rows = keep(contents(docs, wanted, units), "phrase-contents")
    place = F.col("place")
    lo = F.shiftright(place, 24)
    windows = F.shiftright(place, 12).bitwiseAND(F.lit(0xFFF))
    whole = found.join(classes.where("met > 1").select("trigger", "phrase"), ["trigger", "phrase"], "left_semi")
    spans = (
        whole.select("doc", "tag", lo.alias("lo"), (lo + windows - 1 + units.window).alias("hi"))
        .unionByName(compared(rows, units, compare))
        .unionByName(counted(rows, units))
        .groupBy("doc", "tag")
        .agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    )
    return docs, spans


def covered(spans: list[dict] | None, n: int) -> np.ndarray:
    """Mask of the items that the spans cover."""
    if not spans:
        return np.zeros(n, bool)
    steps = np.zeros(n + 1, np.int32)
    np.add.at(steps, [s["lo"] for s in spans], 1)
    np.add.at(steps, [s["hi"] for s in spans], -1)
    return np.cumsum(steps[:-1]) > 0
