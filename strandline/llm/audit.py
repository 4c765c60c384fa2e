"""How filters interact: what each removes in every order in which they may be applied.

A document has a failure mask, one bit per filter. Per part (a source, say) the masks are
counted, and the counts become a decision diagram: a level per filter, a pass and a fail
child per node, a node's weight being the documents that reach it. Swapping two adjacent
levels turns the diagram of one order into that of the next, and a sequence of such swaps
visits all orders. The path on which everything passes holds the steps of an order: what
goes to a fail child there is removed by that filter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.text import SMALL_BATCHES
from strandline.session import keep, settings

UPPER = bytes(range(65, 91))
SYMBOLS = b"#$%&*|"


class View:
    """A text with what several filters look at: its bytes and its words."""

    __slots__ = ("text", "raw", "words")

    def __init__(self, text: str):
        self.text = text
        self.raw = text.encode()
        self.words = self.raw.split()  # bytes are parted at \x20 and \x09-\x0D


def few_words(view: View) -> bool:
    return len(view.words) < 50


def repetitive(view: View) -> bool:
    return 100 * len(set(view.words)) < 65 * len(view.words)


def shouting(view: View) -> bool:
    capitals = len(view.raw) - len(view.raw.translate(None, UPPER))
    return 100 * capitals > 5 * len(view.text)


def symbols(view: View) -> bool:
    return len(view.raw) != len(view.raw.translate(None, SYMBOLS))


#: Filters by letter; each tells whether a text fails it.
FILTERS: dict[str, Callable[[View], bool]] = {"A": few_words, "B": repetitive, "C": shouting, "D": symbols}

Weight = tuple[int, ...]


class Node:
    __slots__ = ("passed", "failed", "weight")

    def __init__(self, passed: Node | None, failed: Node | None, weight: Weight):
        self.passed, self.failed, self.weight = passed, failed, weight


class Diagram:
    """Counts by failure mask. Every path tests all filters; equal nodes of a level are one."""

    def __init__(self, order: Sequence[int], counts: Mapping[int, Weight], zero: Weight):
        self.order = list(order)
        leaves: dict[Weight, Node] = {}
        self.levels: list[dict[tuple[int, int], Node]] = [{} for _ in self.order]

        def below(level: int, mask: int) -> Node:
            if level == len(self.order):
                weight = counts.get(mask, zero)
                return leaves.setdefault(weight, Node(None, None, weight))
            passed = below(level + 1, mask)
            failed = below(level + 1, mask | 1 << self.order[level])
            return joined(self.levels[level], passed, failed)

        self.root = below(0, 0)

    def swap(self, level: int) -> None:
        """Exchange the filters of a level and the next.

        Nodes of the upper level stay the ones their parents know; they stand for the same
        counts as before. The lower level is made anew.
        """
        upper, lower = self.order[level], self.order[level + 1]
        self.order[level], self.order[level + 1] = lower, upper
        made: dict[tuple[int, int], Node] = {}
        nodes = list(self.levels[level].values())
        for node in nodes:
            a, b = node.passed, node.failed
            node.passed = joined(made, a.passed, b.passed)
            node.failed = joined(made, a.failed, b.failed)
        self.levels[level] = {(id(n.passed), id(n.failed)): n for n in nodes}
        self.levels[level + 1] = made

    def steps(self) -> list[tuple[Weight, Weight]]:
        """(kept, removed) of every step, along the path on which all filters pass."""
        out, node = [], self.root
        for _ in self.order:
            out.append((node.passed.weight, node.failed.weight))
            node = node.passed
        return out


def joined(level: dict[tuple[int, int], Node], passed: Node, failed: Node) -> Node:
    key = (id(passed), id(failed))
    if key not in level:
        weight = tuple(a + b for a, b in zip(passed.weight, failed.weight))
        level[key] = Node(passed, failed, weight)
    return level[key]


def adjacent_swaps(n: int) -> Iterator[int]:
    """Positions whose swaps with the next visit all orders of ``n`` items from the first on."""
    if n < 2:
        return
    # the last item walks through each order of the others, to and fro
    down = True
    inner = adjacent_swaps(n - 1)
    while True:
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        at = next(inner, None)
        if at is None:
            return
        yield at + 1 if down else at
        down = not down


def all_steps(counts: Mapping[int, Weight], letters: str, zero: Weight) -> list[tuple]:
    """(order, step, kept, removed, redundant, only this one, marked.., shapley) for all orders."""
    n = len(letters)
    diagram = Diagram(range(n), counts, zero)
    orders = [("".join(letters[i] for i in diagram.order), tuple(diagram.order), diagram.steps())]
    for level in adjacent_swaps(n):
        diagram.swap(level)
        orders.append(("".join(letters[i] for i in diagram.order), tuple(diagram.order), diagram.steps()))
    fails, alone, whole = [0] * n, [0] * n, [0] * n
    for _, order, steps in orders:
        for i, (_, removed) in zip(order, steps):
            whole[i] += removed[0]
        fails[order[0]] = steps[0][1][0]
        alone[order[-1]] = steps[-1][1][0]
    return [
        (name, step, kept[0], removed[0], fails[i] - removed[0], alone[i], *removed[1:], whole[i])
        for name, order, steps in orders
        for step, (i, (kept, removed)) in enumerate(zip(order, steps), 1)
    ]


def masks(
    df: DataFrame, filters: Mapping[str, Callable[[View], bool]], text: str, doc_id: str, part: str
) -> DataFrame:
    """Stored rows (doc_id, digest, part, mask, n): rows alike in all of these are counted together.

    ``digest`` stands for the text (SHA-256, 16 bytes of it).
    """
    tests = list(filters.values())

    def flagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, found = [], []
            for value in batch.column("text"):
                view = View(value.as_py() or "")
                digests.append(hashlib.sha256(view.raw).digest()[:16])
                found.append(sum(fails(view) << i for i, fails in enumerate(tests)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), pa.array(digests, pa.binary()), pa.array(found, pa.int64())],
                ["doc_id", "part", "digest", "mask"],
            )

    rows = df.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.col(text).cast("string").alias("text"),
    )
    found = rows.mapInArrow(flagged, "doc_id long, part string, digest binary, mask long")
    with settings(df.sparkSession, SMALL_BATCHES):
        return keep(found.groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n")), "masks")


def interactions(
    df: DataFrame,
    labels: DataFrame | None = None,
    marks: Mapping[str, str] | None = None,
    filters: Mapping[str, Callable[[View], bool]] | None = None,
    repeat: str = "E",
    text: str = "text",
    doc_id: str = "doc_id",
    part: str = "source",
) -> DataFrame:
    """One row per part, order of the filters, and step in it.

    ``filters`` maps letters to tests of a text; the letter ``repeat`` is one more filter,
    which a document fails whose text equals that of a smaller id anywhere in the table.
    ``marks`` maps output columns to SQL conditions on ``labels``, which has ``doc_id``; a
    document has a mark if any of its label rows fulfils the condition.

    Returns part, filter_order, step (from 1), then counts within the part: kept after the
    step, removed in it, redundant (failing this filter, removed earlier), unique_fails
    (failing no other), a column per mark (removed here and marked), and shapley (what the
    filter removes, summed over all orders). All orders of n filters are n! * n rows a part.

    A null text is empty, a null part the empty string. A null id is no smaller id and has
    no marks; rows without one never fail ``repeat``. Rows of equal id and text do not
    repeat each other. An empty table gives no rows. Other columns are not read.

    Masks merge on the map side, so a part, text or id that dominates costs a row per task.
    """
    filters, marks = FILTERS if filters is None else filters, dict(marks or {})
    letters, repeated = "".join(filters) + repeat, 1 << len(filters)
    rows = masks(df, filters, text, doc_id, part)
    known = rows.where("doc_id IS NOT NULL")
    # the join is on text and id, of which no pair is frequent
    firsts = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("__first", F.lit(True))
    mask = F.when(F.col("__first"), F.col("mask")).otherwise(F.col("mask") + repeated)
    known = known.join(firsts, ["digest", "doc_id"], "left").withColumn("mask", mask).drop("__first")
    if marks and labels is not None:
        marked = labels.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).cast("long").alias("doc_id")).agg(
            *[F.max(F.expr(c).cast("int")).alias(name) for name, c in marks.items()]
        )
        known = known.join(marked, "doc_id", "left")
    else:
        known = known.withColumns({name: F.lit(0) for name in marks})
    unknown = rows.where("doc_id IS NULL").withColumns({name: F.lit(0) for name in marks})
    counted = known.unionByName(unknown).groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        *[F.sum(F.col("n") * F.coalesce(F.col(name), F.lit(0))).alias(name) for name in marks],
    )
    # a part has at most one row per mask
    per_part = counted.groupBy("part").agg(F.collect_list(F.array("mask", "n", *marks)).alias("counts"))
    names = ["filter_order", "step", "kept", "removed", "redundant", "unique_fails", *marks, "shapley"]
    zero = (0,) * (1 + len(marks))

    def expanded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int32(), *[pa.int64()] * (len(names) - 2)]
        for batch in batches:
            for own, counts in zip(batch.column("part"), batch.column("counts").to_pylist()):
                steps = all_steps({c[0]: tuple(c[1:]) for c in counts}, letters, zero)
                columns = [pa.array(c, kind) for c, kind in zip(zip(*steps), kinds)]
                part_column = pa.array([own.as_py()] * len(steps), pa.string())
                yield pa.RecordBatch.from_arrays([part_column, *columns], ["part", *names])

    counts = ", ".join(f"`{c}` long" for c in names[2:])
    return per_part.mapInArrow(expanded, f"part string, filter_order string, step int, {counts}")
