"""Near-duplicate groups by a forest of sorted MinHash signatures.

Each of ``TREES`` trees orders all texts by its own ``DEPTH`` MinHash values. Texts that stand
in a run of this order with a common prefix are candidates of each other. The prefix has
``DEPTH - 1`` values; where a region of the order is crowded, it is one value longer.
Signatures of a region's texts are compared, and the closest that connect it are confirmed on
the full shingle sets. Later only texts of a region that are still unconnected are compared,
so that a large group costs links in proportion to its size, not to the square of it.

A region still crowded at full depth is dealt in blocks. All its texts are first linked with
its most central one; then those that are not in its main group are sent to all its blocks,
so every pair of unconnected texts of a region meets.

With 32 trees a pair of similarity 0.75 shares no region with probability 2e-8 in regions
of three values and 5e-6 where all of them are crowded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm import text as tx
from strandline.llm.components import components
from strandline.session import keep, settings

SHINGLE = 5
TREES, DEPTH = 32, 4
VALUES = TREES * DEPTH
CROWDED = 64
# of 128 values, at similarity 0.75, fewer agree once in 10^8 pairs
LEAST_AGREEING = 68


def _multipliers() -> np.ndarray:
    seeds = tx.mix(np.arange(1, VALUES + 1, dtype=np.uint64) * np.uint64(tx.BASE))
    return (seeds >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


MULTIPLIERS = _multipliers()


def shingle_hashes(data: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` lower-cased words (or the whole of a shorter text), and
    the row boundaries in them."""
    _, _, rows, words = tx.word_hashes(data, bounds, lower=True)
    prefix = tx.prefix_hash(words)
    n = np.diff(rows)
    many = np.where(n == 0, 0, np.maximum(n - size + 1, 1))
    starts = tx.ragged(rows[:-1], many)
    ends = np.minimum(starts + size, np.repeat(rows[1:], many))
    return tx.range_hash(prefix, starts, ends), np.concatenate([[0], np.cumsum(many)])


def distinct_sets(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct hashes of each row, and the row boundaries in them."""
    sets = [np.unique(hashes[a:b]) for a, b in zip(rows[:-1].tolist(), rows[1:].tolist())]
    sizes = np.array([len(s) for s in sets], np.int64)
    return np.concatenate(sets) if sets else hashes, np.concatenate([[0], np.cumsum(sizes)])


def sketches(df: DataFrame, size: int) -> DataFrame:
    """(doc_id, n, set1, set2, sig) of (doc_id, text)."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, bounds in tx.texts(batch.column("text")):
                hashes, rows = distinct_sets(*shingle_hashes(data, bounds, size))
                n = np.diff(rows)
                full = np.flatnonzero(n)
                sig = np.zeros((hi - lo, VALUES), np.uint32)
                sums = np.zeros((2, hi - lo), np.uint64)
                if len(full):
                    starts = rows[:-1][full]
                    short = (hashes >> np.uint64(32)).astype(np.uint32)
                    for k, a in enumerate(MULTIPLIERS):
                        sig[full, k] = np.minimum.reduceat(short * a, starts)
                    sums[0, full] = np.add.reduceat(hashes, starts)
                    sums[1, full] = np.add.reduceat(tx.mix(hashes), starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(lo, hi - lo), pa.array(n),
                        pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)),
                        pa.array([s.tobytes() for s in sig], pa.binary()),
                    ],
                    ["doc_id", "n", "set1", "set2", "sig"],
                )

    return df.mapInArrow(sketch, "doc_id long, n long, set1 long, set2 long, sig binary")


def tree_rows(classes: DataFrame) -> DataFrame:
    """(node, near, deep) per class and tree: the tree's prefixes of DEPTH - 1 and DEPTH values."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                piece = batch.slice(at, 2000)
                n = piece.num_rows
                sig = np.frombuffer(b"".join(piece.column("sig").to_pylist()), np.uint32)
                values = sig.reshape(n, TREES, DEPTH).astype(np.uint64)
                key = np.tile(tx.mix(np.arange(1, TREES + 1, dtype=np.uint64)), (n, 1))
                keys = []
                for d in range(DEPTH):
                    key = tx.mix(key * np.uint64(tx.BASE) + values[:, :, d])
                    keys.append(key.ravel().view(np.int64))
                node = np.repeat(piece.column("node").to_numpy(), TREES)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node), pa.array(keys[-2]), pa.array(keys[-1])], ["node", "near", "deep"]
                )

    return classes.select("node", "sig").mapInArrow(spread, "node long, near long, deep long")


def regions(classes: DataFrame) -> DataFrame:
    """Stored (region, size, node) of all regions with two texts or more."""
    rows = tree_rows(classes)
    # stored like other aggregates that are joined back: Spark can split a hot key of plain tables only
    sizes = keep(rows.groupBy("near").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "sizes")
    found = keep(rows.join(sizes, "near"), "tree-rows")
    crowded = found.where(F.col("size") > CROWDED)
    deep = keep(crowded.groupBy("deep").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "sizes")
    return keep(
        found.where(F.col("size") <= CROWDED).select(F.col("near").alias("region"), "size", "node").unionByName(
            crowded.drop("size").join(deep, "deep").select(F.col("deep").alias("region"), "size", "node")
        ),
        "regions",
    )


def tree_order(sig: np.ndarray) -> np.ndarray:
    """Positions in the order of the signatures, values compared from the first on."""
    return np.lexsort(sig.T[::-1])


def agreeing(sig: np.ndarray, group: np.ndarray, own: np.ndarray) -> np.ndarray:
    """(own, all) matrix of how many values agree, 0 below LEAST_AGREEING and inside a group."""
    mine = np.flatnonzero(own)
    agree = np.zeros((len(mine), len(sig)), np.int16)
    for lo in range(0, len(mine), 16):
        part = mine[lo : lo + 16]
        agree[lo : lo + 16] = (sig[part, None, :] == sig[None, :, :]).sum(2)
    agree[(group[mine][:, None] == group[None, :]) | (agree < LEAST_AGREEING)] = 0
    return agree


def joining_pairs(sig: np.ndarray) -> list[tuple[int, int]]:
    """Closest pairs that agree in LEAST_AGREEING values and connect all that such pairs connect."""
    order = tree_order(sig)
    n = len(sig)
    agree = agreeing(sig[order], np.arange(n), np.ones(n, bool))
    pairs, out = [], np.ones(n, bool)
    while out.any():  # one tree after another, from its first text in the order
        at = int(np.flatnonzero(out)[0])
        out[at] = False
        closest, parent = agree[at].copy(), np.full(n, at)
        while True:
            closest[~out] = 0
            to = int(closest.argmax())
            if not closest[to]:
                break
            pairs.append((int(order[parent[to]]), int(order[to])))
            out[to] = False
            better = agree[to] > closest
            closest[better], parent[better] = agree[to][better], to
    return pairs


def blocks(rows: DataFrame, columns: list[str], work, schema: str) -> DataFrame:
    """Run ``work`` on the rows of each (region, block), given as one tuple of lists, one for each
    of ``columns``; it returns rows. Blocks have some ten to some hundred rows."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        last = None
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(batch.column(c).to_pylist() for c in ("region", "block", *columns))):
                if row[:2] != last:
                    if len(held) > 1:
                        out += work(*last, *zip(*held))
                    held, last = [], row[:2]
                held.append(row[2:])
            yield table_of(out)
        yield table_of(work(*last, *zip(*held)) if len(held) > 1 else [])

    def table_of(out: list[tuple]) -> pa.RecordBatch:
        found = np.array(sorted(set(out)), np.int64).reshape(-1, len(names))
        return pa.RecordBatch.from_arrays([pa.array(found[:, i]) for i in range(len(names))], names)

    ordered = rows.repartition("region", "block").sortWithinPartitions("region", "block", "node")
    return ordered.select("region", "block", *columns).mapInArrow(run, schema)


def signatures(sigs: tuple) -> np.ndarray:
    return np.frombuffer(b"".join(sigs), np.uint32).reshape(len(sigs), VALUES)


def first_pairs(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Distinct pairs (a, b), a < b, that connect the texts of a block."""

    def work(region: int, block: int, nodes: tuple, sigs: tuple) -> list[tuple]:
        pairs = joining_pairs(signatures(sigs))
        return [(min(nodes[i], nodes[j]), max(nodes[i], nodes[j])) for i, j in pairs]

    rows = members.join(classes.select("node", "sig"), "node")
    return blocks(rows, ["node", "sig"], work, "a long, b long").distinct()


def still_apart(meeting: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of ``meeting`` (region, block, node, component, own) whose signature is near that of
    another component in the block; one of such two texts is at home there (own)."""

    def work(region: int, block: int, nodes: tuple, groups: tuple, own: tuple, sigs: tuple) -> list[tuple]:
        group, mine = np.array(groups), np.array(own, bool)
        if not mine.any() or not (group != group[0]).any():
            return []
        agree = agreeing(signatures(sigs), group, mine)
        rows, columns = np.nonzero(agree)
        near = set(np.flatnonzero(mine)[np.unique(rows)].tolist()) | set(np.unique(columns).tolist())
        return [(region, block, nodes[i], groups[i], own[i]) for i in near]

    rows = meeting.join(classes.select("node", "sig"), "node")
    return blocks(
        rows, ["node", "component", "own", "sig"], work, "region long, block long, node long, component long, own long"
    )


def shared_counts(sets: list[np.ndarray], own: np.ndarray) -> np.ndarray:
    """(own, all) matrix of the sizes of the intersections."""
    every, column, many = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    use = many[column] > 1
    row, column = row[use], column[use]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    mine = np.flatnonzero(own)
    out = np.zeros((len(mine), len(sets)), np.float32)
    wide = 4096
    edges = np.searchsorted(column, np.arange(0, len(every) + wide, wide))
    for number, (lo, hi) in enumerate(zip(edges, edges[1:])):
        if hi > lo:
            part = np.zeros((len(sets), wide), np.float32)
            part[row[lo:hi], column[lo:hi] - number * wide] = 1
            out += part[mine] @ part.T
    return out.astype(np.int64)


def confirmed_in_blocks(near: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) on full shingle sets that connect components of a block; no more than connect them."""

    def work(region: int, block: int, nodes: tuple, groups: tuple, own: tuple, zs: tuple) -> list[tuple]:
        mine = np.array(own, bool)
        if not mine.any():
            return []
        tool = zstandard.ZstdDecompressor()
        sets = [shingles_of(tool.decompress(z), size) for z in zs]
        sizes = np.array([len(s) for s in sets])
        at = np.flatnonzero(mine)
        both = shared_counts(sets, mine)
        linked = (both > 0) & (100 * both >= percent * (sizes[at][:, None] + sizes[None, :] - both))
        root = {g: g for g in groups}

        def find(x: int) -> int:
            while root[x] != x:
                x = root[x]
            return x

        out = []
        for i, j in zip(*(x.tolist() for x in np.nonzero(linked))):
            a, b = find(groups[at[i]]), find(groups[j])
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((min(nodes[at[i]], nodes[j]), max(nodes[at[i]], nodes[j])))
        return out

    rows = near.join(texts.withColumnRenamed("doc_id", "node"), "node")
    return blocks(rows, ["node", "component", "own", "z"], work, "a long, b long").distinct()


def shingles_of(text: bytes, size: int) -> np.ndarray:
    data = np.frombuffer(text, np.uint8)
    return np.unique(shingle_hashes(data, np.array([0, len(data)]), size)[0])


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the similarity."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdDecompressor()
        known: tuple[int, bytes, np.ndarray] | None = None

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                out = []
                columns = (batch.slice(at, 64).column(c).to_pylist() for c in ("a", "b", "za", "zb"))
                for a, b, za, zb in zip(*columns):
                    if known is None or known[0] != a or known[1] != za:
                        known = (a, za, shingles_of(tool.decompress(za), size))
                    first, second = known[2], shingles_of(tool.decompress(zb), size)
                    both = len(np.intersect1d(first, second, assume_unique=True))
                    if 100 * both >= percent * (len(first) + len(second) - both):
                        out.append((a, b))
                found = np.array(out, np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

    first = texts.select(F.col("doc_id").alias("a"), F.col("z").alias("za"))
    second = texts.select(F.col("doc_id").alias("b"), F.col("z").alias("zb"))
    joined = pairs.join(second, "b").join(first, "a").select("a", "b", "za", "zb")
    return joined.mapInArrow(compare, "a long, b long").distinct()


def small_texts(df: DataFrame) -> DataFrame:
    """(doc_id, z): the texts compressed, to be shuffled."""

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                piece = batch.slice(at, 500)
                blobs = [tool.compress((t or "").encode()) for t in piece.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(blobs, pa.binary())], ["doc_id", "z"]
                )

    return df.mapInArrow(shrink, "doc_id long, z binary")


def with_component(members: DataFrame, roots: DataFrame) -> DataFrame:
    return members.join(roots, "node", "left").withColumn("component", F.coalesce("root", "node")).drop("root")


def near_duplicates(
    df: DataFrame, percent: int = 75, size: int = SHINGLE, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``df``.

    Two rows are linked if their sets of ``size``-word shingles, lower-cased in A-Z, share at least
    ``percent`` hundredths of their union; a text of fewer words is one shingle. ``component_id``
    is the smallest doc_id that links lead to, and the row that has it as its own is kept.

    Equal sets are one text from the start. A null, empty or blank text has no shingles and is
    linked with nothing. Rows with the same doc_id belong to the same component. A row without a
    doc_id is linked with nothing: its component_id is null and it is kept. An empty table
    gives no rows; other columns are not read.
    """
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    with settings(df.sparkSession, tx.SMALL_BATCHES):
        every = keep(sketches(rows, size), "sketches")
    usable = every.where("n > 0 AND doc_id IS NOT NULL")
    classes = keep(
        usable.groupBy("set1", "set2").agg(F.min(F.struct("doc_id", "sig")).alias("one")).select(
            "set1", "set2", F.col("one.doc_id").alias("node"), F.col("one.sig").alias("sig")
        ),
        "classes",
    )
    found = regions(classes)
    block = F.pmod(F.xxhash64("node", "region"), F.ceil(F.col("size") / CROWDED))
    members = found.withColumn("block", block)

    # the most central text of a crowded region stands in most regions with others
    crowded = found.where(F.col("size") > CROWDED)
    central = found.groupBy("node").agg(F.sum("size").alias("weight"))
    leaders = crowded.join(central, "node").groupBy("region").agg(
        F.max(F.struct("weight", "node")).alias("lead")
    ).select("region", F.col("lead.node").alias("lead"))
    leaders = keep(leaders, "leaders")
    stars = crowded.join(leaders, "region").where("node <> lead").select(
        F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b")
    )
    first = keep(
        first_pairs(members, classes).unionByName(stars).distinct(),
        "pairs",
    )
    nodes = found.select(F.col("node").alias("doc_id")).distinct()
    # what stands in no region needs no text
    with settings(df.sparkSession, tx.SMALL_BATCHES):
        texts = keep(small_texts(rows).join(nodes, "doc_id", "left_semi"), "texts")
    links = keep(confirmed(first, texts, size, percent), "links")
    roots = keep(components(links), "roots")

    # second look: texts of one region that are still apart
    grouped = keep(with_component(members, roots), "members")
    apart = grouped.groupBy("region").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    ).where("low < high").select("region")
    apart = keep(apart, "apart")
    open_ = keep(grouped.join(apart, "region", "left_semi"), "open")
    large = open_.where(F.col("size") > CROWDED).groupBy("region", "component").agg(F.count(F.lit(1)).alias("k"))
    main = large.groupBy("region").agg(F.max(F.struct("k", "component")).alias("m")).select(
        "region", F.col("m.component").alias("main")
    )
    outside = open_.where(F.col("size") > CROWDED).join(main, "region").where("component <> main")
    to_all = outside.withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("size") / CROWDED) - 1))
    )
    meeting = (
        open_.select("region", "block", "node", "component", F.lit(1).cast("long").alias("own"))
        .unionByName(to_all.select("region", "block", "node", "component", F.lit(0).cast("long").alias("own")))
        .groupBy("region", "block", "node", "component")
        .agg(F.max("own").alias("own"))
    )
    near = keep(still_apart(meeting, classes), "near")
    more = confirmed_in_blocks(near, texts, size, percent)
    roots = keep(components(links.unionByName(more)), "roots")

    of_class = classes.select("set1", "set2", "node")
    labelled = (
        every.select("doc_id", "n", "set1", "set2")
        .join(of_class, ["set1", "set2"], "left")
        .join(roots, "node", "left")
    )
    linked = F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.coalesce("root", "node"))
    component = F.coalesce(linked, F.col("doc_id"))
    return labelled.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(df: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = 75) -> DataFrame:
    """The rows of ``df`` that ``near_duplicates`` keeps, unchanged; rows without a doc_id stay."""
    gone = near_duplicates(df, percent, text=text, doc_id=doc_id).where("NOT kept").select(
        F.col("doc_id").alias("gone__")
    ).distinct()
    return df.join(gone, F.col(doc_id) == F.col("gone__"), "left_anti")
