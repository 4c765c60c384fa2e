"""Removal of lines that nearly equal an earlier line, by deletion neighbourhoods.

Lines are compared as sequences of units. For lines of ``MIN_WORDS`` words or more these are
the words, for shorter ones the characters of the words joined by one blank. The edit bound
is one unit inserted, deleted or replaced; a line of fewer than ``MIN_WORDS`` words and
``MIN_CHARS`` characters must be equal. Equal lines are merged first. The variants of a line
are the line with one unit left out: two lines differ by an inserted unit if one equals a
variant of the other, and by a replaced unit if variants with the same place left out are
equal. All variants are hashed keys, lines with equal keys meet, and the edit distance of a
line to the earliest other line of its key is verified on the units.

Not every line needs its variants. Within the bound, two lines share the first or the second
half of the shorter one. So halves are joined first, and a line emits the variants of that
half only which may differ. Keys are joined to their earliest line only, so a key that many
lines share costs one row for each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm import text as tx
from strandline.session import discard, keep, release

MIN_WORDS = 8
MIN_CHARS = 12
LAST = (1 << 63) - 1  # place of rows without a doc_id: behind all others
#: Which half is shared, and whether the line is the longer one of the pair.
HEAD, TAIL, LONG_HEAD, LONG_TAIL = 1, 2, 4, 8


def halves(n: int, shared: int) -> range:
    """Places of the units that may differ in a line of ``n`` units that shares this half."""
    if shared == HEAD:
        return range(n // 2, n)
    if shared == TAIL:
        return range(n // 2)
    head = (n - 1) // 2
    return range(head, n) if shared == LONG_HEAD else range(head + 1)


def identified(df: DataFrame, text: str, doc_id: str) -> DataFrame:
    """Add doc and tag: the row's place, and what tells rows of one id apart."""
    return df.withColumns(
        {
            "doc__": F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)),
            "tag__": F.xxhash64(F.col(doc_id).isNull(), F.col(text).cast("string")),
        }
    )


def characters(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of lines, whose words are joined by a blank, and the lines' boundaries in them.

    ``last`` marks the words that end a line.
    """
    lengths = ends - starts + ~last
    source = tx.ragged(starts, lengths)
    out = data[np.minimum(source, len(data) - 1)]
    edges = np.cumsum(lengths)
    out[edges[~last] - 1] = 32
    begins = np.concatenate([[0], np.cumsum((out & 0xC0) != 0x80)])
    points = np.frombuffer(out.tobytes().decode().encode("utf-32-le"), "<u4")
    return points, begins[np.concatenate([[0], edges[last]])]


def half_hashes(units: np.ndarray, first: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Keys of the halves of sequences of units: as they are, and as lines with one unit more."""
    prefix, n = tx.prefix_hash(units), end - first

    def key(a: np.ndarray, b: np.ndarray, shorter: np.ndarray, side: int) -> np.ndarray:
        mark = (shorter * 2 + side).astype(np.uint64) * tx.MIX_2
        return tx.mix(tx.range_hash(prefix, a, b) + mark)

    less = np.maximum(n - 1, 1)
    return [
        key(first, first + n // 2, n, 0),
        key(first + n // 2, end, n, 1),
        key(first, first + less // 2, less, 0),
        key(end - (less - less // 2), end, less, 1),
    ]


def lines(df: DataFrame, min_words: int) -> DataFrame:
    """(h1, h2, n, chars, doc, tag, line, head, tail, long_head, long_tail) of each line with a word.

    ``n`` counts the units, which are characters if ``chars``.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, bounds in tx.texts(batch.column("text")):
                starts, ends, rows, words = tx.word_hashes(data, bounds)
                breaks = np.flatnonzero(data == 10)
                line = np.searchsorted(breaks, starts)
                row = np.repeat(np.arange(hi - lo), np.diff(rows))
                new = np.ones(len(starts), bool)
                new[1:] = (np.diff(line) != 0) | (np.diff(row) != 0)
                first = np.flatnonzero(new)
                end = np.append(first[1:], len(starts))[: len(first)]
                prefix, second = tx.prefix_hash(words), tx.prefix_hash(words, tx.SECOND_BASE)
                n = end - first
                own = row[first]
                keys = half_hashes(words, first, end)
                short = n < min_words
                if short.any():
                    inside = np.repeat(short, n)
                    last = np.zeros(len(starts), bool)
                    last[end - 1] = True
                    points, edges = characters(data, starts[inside], ends[inside], last[inside])
                    for mine, other in zip(keys, half_hashes(points, edges[:-1], edges[1:])):
                        mine[short] = other
                units = n.copy()
                if short.any():
                    units[short] = np.diff(edges)
                columns = [
                    tx.range_hash(prefix, first, end),
                    tx.range_hash(second, first, end, tx.SECOND_BASE),
                    units,
                    short.astype(np.int64),
                    batch.column("doc").to_numpy()[lo:hi][own],
                    batch.column("tag").to_numpy()[lo:hi][own],
                    line[first] - np.searchsorted(breaks, bounds[:-1])[own],
                    *keys,
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for c in columns], names
                )

    names = ["h1", "h2", "n", "chars", "doc", "tag", "line", "head", "tail", "long_head", "long_tail"]
    return df.mapInArrow(parse, ", ".join(f"{c} long" for c in names))


def half_keys(different: DataFrame, min_words: int, min_chars: int) -> DataFrame:
    """(h1, h2, shared): the halves that a line shares with another one."""
    least = F.when(F.col("chars") == 1, min_chars).otherwise(min_words)
    kinds = (("head", HEAD, 0), ("tail", TAIL, 0), ("long_head", LONG_HEAD, 1), ("long_tail", LONG_TAIL, 1))

    def entry(name: str, kind: int, more: int) -> Column:
        return F.when(
            F.col("n") >= least + more, F.struct(F.col(name).alias("key"), F.lit(kind).alias("shared"))
        )

    every = F.filter(F.array(*[entry(*k) for k in kinds]), lambda x: x.isNotNull())
    keyed = different.where(F.col("n") >= least).select("h1", "h2", F.inline(every))
    # stored, so that the join is one of two plain tables, in which Spark may split a hot key
    often = keep(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("key"), "often")
    return keyed.join(often, "key", "left_semi").groupBy("h1", "h2").agg(F.bit_or("shared").alias("shared"))


def variants(words: DataFrame) -> DataFrame:
    """(key, kind, h1, h2): hashed variants; kind 0 the line itself, 1 a unit left out, 2 a unit
    left out at a stated place."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, bounds in tx.texts(batch.column("words")):
                _, _, rows, hashes = tx.word_hashes(data, bounds)
                h1, h2 = (batch.column(c).to_numpy()[lo:hi] for c in ("h1", "h2"))
                shared = batch.column("shared").to_numpy()[lo:hi]
                out: list[tuple[np.ndarray, int, int]] = []
                chars = batch.column("chars").to_numpy()[lo:hi]
                for i, (a, b) in enumerate(zip(rows[:-1].tolist(), rows[1:].tolist())):
                    units = hashes[a:b]
                    if chars[i]:
                        points = joined_words(batch.column("words")[lo + i].as_py())
                        units = np.frombuffer(points.encode("utf-32-le"), "<u4").astype(np.uint64)
                    out += [(key, kind, i) for key, kind in variant_keys(units, int(shared[i]))]
                keys = np.concatenate([o[0] for o in out]) if out else np.zeros(0, np.uint64)
                sizes = [len(o[0]) for o in out]
                row = np.repeat(np.array([o[2] for o in out], np.int64), sizes)
                kind = np.repeat(np.array([o[1] for o in out], np.int64), sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(kind), pa.array(h1[row]), pa.array(h2[row])],
                    ["key", "kind", "h1", "h2"],
                )

    return words.mapInArrow(emit, "key long, kind long, h1 long, h2 long")


def joined_words(line: str) -> str:
    return b" ".join(line.encode().split()).decode()


def variant_keys(words: np.ndarray, shared: int) -> Iterator[tuple[np.ndarray, int]]:
    n = len(words)
    powers = tx.powers(tx.BASE, n)
    ahead = np.concatenate([[np.uint64(0)], np.cumsum((words + np.uint64(1)) * powers)])
    # behind the unit left out everything moves up by one place
    inverse = np.uint64(pow(tx.BASE, -1, 1 << 64))
    places = np.arange(n)
    left_out = ahead[:-1] + (ahead[-1] - ahead[1:]) * inverse
    left_out = tx.mix(left_out + np.uint64((n - 1) * int(tx.MIX_1) % (1 << 64)))
    if shared & (HEAD | TAIL):
        yield tx.mix(ahead[-1:] + np.uint64(n * int(tx.MIX_1) % (1 << 64))), 0
    masked = np.zeros(n, bool)
    cut = np.zeros(n, bool)
    for half in (HEAD, TAIL):
        if shared & half:
            masked[halves(n, half)] = True
    for half in (LONG_HEAD, LONG_TAIL):
        if shared & half:
            cut[halves(n, half)] = True
    yield tx.mix(left_out[masked] + (places[masked] + 1).astype(np.uint64) * tx.MIX_2), 2
    yield np.unique(left_out[cut]), 1


def within_one(a: list[bytes] | str, b: list[bytes] | str) -> bool:
    """Whether the edit distance of two sequences of words, or of characters, is at most one."""
    if abs(len(a) - len(b)) > 1:
        return False
    short, long = sorted((a, b), key=len)
    same = 0
    while same < len(short) and short[same] == long[same]:
        same += 1
    skip = same + 1
    return short[same:] == long[skip:] if len(short) < len(long) else short[skip:] == long[skip:]


def verified(pairs: DataFrame) -> DataFrame:
    """(h1, h2) of the pairs whose lines (w, v) are within the bound, in characters if ``chars``."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fine = [
                within_one(joined_words(a), joined_words(b)) if chars else within_one(a.encode().split(), b.encode().split())
                for a, b, chars in zip(*(batch.column(c).to_pylist() for c in ("w", "v", "chars")))
            ]
            yield batch.select(["h1", "h2"]).filter(pa.array(fine, pa.bool_()))

    return pairs.select("h1", "h2", "w", "v", "chars").mapInArrow(check, "h1 long, h2 long")


def near_lines(different: DataFrame, rows: DataFrame, min_words: int, min_chars: int) -> tuple[DataFrame, list[DataFrame]]:
    """(h1, h2) of the lines that are within the bound of an earlier different line, and what was
    stored for that and can go once they are stored."""
    shared = keep(half_keys(different, min_words, min_chars), "half-keys")
    wanted = shared.join(different.select("h1", "h2", "one", "chars"), ["h1", "h2"])
    per_doc = wanted.groupBy(F.col("one.doc").alias("doc"), F.col("one.tag").alias("tag")).agg(
        F.collect_list(F.struct("h1", "h2", "shared", "one", "chars")).alias("found")
    )
    found = rows.join(per_doc, ["doc", "tag"]).select(
        F.split(F.coalesce("text", F.lit("")), "\n").alias("all"), F.explode("found").alias("x")
    )
    words = keep(
        # rows that agree in id and text give the same line
        found.select("x.*", F.get("all", F.col("x.one.line").cast("int")).alias("words")).dropDuplicates(["h1", "h2"]),
        "line-words",
    )
    release(rows.sparkSession)
    keyed = keep(variants(words).join(words.select("h1", "h2", "one", "chars"), ["h1", "h2"]), "variants")

    def earliest(kind: int) -> Column:
        return F.min(F.when(F.col("kind") == kind, F.struct("one", "h1", "h2")))

    firsts = keyed.groupBy("key", "chars").agg(
        *[earliest(k).alias(f"first{k}") for k in (0, 1, 2)], F.count(F.lit(1)).alias("k")
    ).where("k > 1")
    firsts = keep(firsts, "firsts")
    partner = (
        F.when(F.col("kind") == 0, F.col("first1"))
        .when(F.col("kind") == 1, F.col("first0"))
        .otherwise(F.col("first2"))
    )
    pairs = (
        keyed.join(firsts, ["key", "chars"])
        .select("h1", "h2", "one", partner.alias("p"))
        .where("p.one < one")
        .select("h1", "h2", F.col("p.h1").alias("p1"), F.col("p.h2").alias("p2"))
        .distinct()
    )
    first = words.select("h1", "h2", "chars", F.col("words").alias("w"))
    second = words.select(F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("words").alias("v"))
    near = verified(pairs.join(first, ["h1", "h2"]).join(second, ["p1", "p2"])).distinct()
    return near, [shared, words, keyed, firsts]


def dropped_lines(rows: DataFrame, min_words: int, min_chars: int) -> DataFrame:
    """(doc, tag, dropped): line numbers from 0 to be removed of each row (doc, tag, text)."""
    # parsed twice: once more is less than storing the lines with all their keys
    every = lines(rows, min_words)
    place = F.struct("doc", "tag", "line")
    different = keep(
        every.groupBy("h1", "h2").agg(
            F.min(F.struct(place.alias("one"), "n", "chars", "head", "tail", "long_head", "long_tail")).alias("x"),
            F.count(F.lit(1)).alias("met"),
        ).select("h1", "h2", "met", "x.*"),
        "different-lines",
    )
    release(rows.sparkSession)
    near, stored = near_lines(different, rows, min_words, min_chars)
    judged = keep(
        different.join(near.withColumn("near", F.lit(True)), ["h1", "h2"], "left").where("near OR met > 1").select(
            "h1", "h2", "one", F.coalesce("near", F.lit(False)).alias("near")
        ),
        "judged-lines",
    )
    discard(different, *stored)
    release(rows.sparkSession)
    gone = every.select("h1", "h2", "doc", "tag", "line").join(judged, ["h1", "h2"]).where(
        F.col("near") | (F.struct("doc", "tag", "line") > F.col("one"))
    )
    return keep(
        gone.groupBy("doc", "tag").agg(F.collect_set(F.col("line").cast("int")).alias("dropped")), "dropped"
    )


def dedup_lines(
    df: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    min_words: int = MIN_WORDS,
    min_chars: int = MIN_CHARS,
) -> DataFrame:
    """``df`` without the lines that are within the bound of an earlier line of the table.

    Lines end at ``\\n``. Earlier is what has the smaller doc_id, or in one document the smaller
    line number; rows without a doc_id come last, rows that share one in the order of a hash of
    their texts. Each line is judged on the lines as given, also on those that are removed
    themselves. Added are ``n_lines`` (of the given text) and ``n_removed``; columns of ``df`` with
    these names are replaced, all others stay as they are.

    Lines without a word stay. A null text stays null and has 0 lines, an empty text has one.
    Rows that agree in doc_id and text are one document: they keep the same lines. An empty table
    stays empty.
    """
    marked = identified(df, text, doc_id)
    rows = marked.select(
        F.col("doc__").alias("doc"), F.col("tag__").alias("tag"), F.col(text).cast("string").alias("text")
    )
    gone = dropped_lines(rows, min_words, min_chars).select(
        F.col("doc").alias("doc__"), F.col("tag").alias("tag__"), F.col("dropped").alias("dropped__")
    )
    release(df.sparkSession)
    own = F.split(F.col(text).cast("string"), "\n")
    left = F.filter(own, lambda line, i: ~F.array_contains(F.col("dropped__"), i))
    joined = marked.join(gone, ["doc__", "tag__"], "left")
    n_lines = F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.size(own)).cast("long")
    return joined.withColumns(
        {
            "n_lines": n_lines,
            "n_removed": F.coalesce(F.size("dropped__"), F.lit(0)).cast("long"),
            text: F.when(F.col("dropped__").isNull(), F.col(text)).otherwise(F.array_join(left, "\n")),
        }
    ).select(*[F.col(f"`{c}`") for c in df.columns if c not in ("n_lines", "n_removed")], "n_lines", "n_removed")
