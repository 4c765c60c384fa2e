"""Mixture-controlled packing of token ids into sequences of fixed length.

Every source is a queue of ids, its documents in a fixed order. A deficit
round-robin serves the queues: each round adds a source's share of a sequence to
its deficit, and the whole ids of the deficit are sent, the fraction is carried on.
The rounds' ids in order, cut every ``length`` ids, are the sequences. When a queue
runs dry, the others share its part from then on.

How many ids a source has sent after k rounds is therefore a closed formula. Each
task can place its own documents without seeing others, once it knows how many ids
lie before them in their queue: deficits carry over windows and partitions alike.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from fractions import Fraction
from itertools import accumulate, islice
from math import gcd, lcm

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.text import SMALL_BATCHES, buffer_of
from strandline.llm.tokens import default_tokenizer, encoder, release
from strandline.session import keep, settings

LENGTH = 4096
SHARE_BITS = 4  # significant bits of a source's total that its default weight keeps
SHARE_RANGE = 20  # a source below the longest's 2^-20 weighs that much
NO_SOURCE = "\x00none"  # queue of rows without a source


@dataclass
class Phase:
    """Rounds during which the same queues are served; numbers per class of equal weight."""

    start: int  # ids sent before it, by all
    rounds: int
    before: list[int]  # ids that each live queue has sent before it
    share: list[int]  # numerator of the ids that a round adds to each
    den: int
    dry: list[int]  # queues of the class that are dry before it, the shortest ones
    live: list[int]
    dry_after: list[int]

    def sent(self, kind: int, rounds: np.ndarray) -> np.ndarray:
        """Ids that one queue of a class sends in this many rounds of the phase."""
        return rounds * self.share[kind] // self.den

    def sent_by_all(self, rounds: np.ndarray, below: int | None = None) -> np.ndarray:
        """Ids that all queues (or those of the classes before ``below``) send in this many rounds."""
        return sum((self.sent(c, rounds) * self.live[c] for c in range(below if below is not None else len(self.live))),
                   np.zeros_like(rounds))


@dataclass
class Plan:
    """Queues of one weight are alike until they run dry, the shortest first. So a phase takes a few
    numbers per weight, not per queue, and a round serves the queues by weight and length."""

    kind: list[int]  # per queue: its class
    rank: list[int]  # and its place in it
    ahead: list[list[int]]  # per class: sums of the totals up to each rank
    phases: list[Phase]

    def rest(self, phase: Phase, kind: int, rank: int) -> int:
        """Ids that the queues of a class below ``rank`` send behind the last round, as they run dry."""
        first, last = phase.dry[kind], max(phase.dry[kind], min(rank, phase.dry_after[kind]))
        each = phase.before[kind] + int(phase.sent(kind, np.array(phase.rounds, object)))
        return self.ahead[kind][last] - self.ahead[kind][first] - (last - first) * each


def share_weights(totals: list[int]) -> list[Fraction]:
    """Each queue's share of all ids, in few classes: its total to ``SHARE_BITS`` significant bits.

    So a queue lasts for about as many rounds as any other.
    """
    most, out = max(totals, default=0), []
    for n in totals:
        n = max(n, most >> SHARE_RANGE, 1)
        drop = max(0, n.bit_length() - SHARE_BITS)
        out.append(Fraction(((n >> drop) + (n >> drop - 1 & 1 if drop else 0)) << drop))
    return out


def plan(totals: list[int], weights: list[Fraction], length: int = LENGTH) -> Plan:
    """The phases that send all ids; at least one queue runs dry in each."""
    scale = lcm(*(w.denominator for w in weights))
    distinct = sorted(set(weights))
    number = {w: c for c, w in enumerate(distinct)}
    whole = [int(w * scale) for w in distinct]
    members: list[list[int]] = [[] for _ in distinct]
    for s in sorted(range(len(totals)), key=lambda s: (totals[s], s)):
        members[number[weights[s]]].append(s)
    rank = [0] * len(totals)
    for own in members:
        for r, s in enumerate(own):
            rank[s] = r
    sizes = [[totals[s] for s in own] for own in members]
    out = Plan([number[w] for w in weights], rank, [list(accumulate(x, initial=0)) for x in sizes], [])
    dry, sent, start = [bisect_left(x, 1) for x in sizes], [0] * len(distinct), 0
    while any(d < len(x) for d, x in zip(dry, sizes)):
        live = [len(x) - d for d, x in zip(dry, sizes)]
        den = sum(n * w for n, w in zip(live, whole))
        common = gcd(den, *(w * length for w, n in zip(whole, live) if n))
        num = [w * length // common if n else 0 for w, n in zip(whole, live)]
        den //= common
        # the most rounds that no live queue is too short for
        rounds = min(((sizes[c][dry[c]] - sent[c] + 1) * den - 1) // num[c] for c in range(len(whole)) if live[c])
        own = [rounds * x // den for x in num]
        more = [max((rounds + 1) * x // den, n + 1) for x, n in zip(num, own)]
        after = [bisect_left(x, n + m, d) for x, n, m, d in zip(sizes, sent, more, dry)]
        phase = Phase(start, rounds, list(sent), num, den, dry, live, after)
        out.phases.append(phase)
        start += sum(n * x for n, x in zip(live, own))
        start += sum(out.rest(phase, c, after[c]) for c in range(len(whole)))
        sent = [n + x for n, x in zip(sent, own)]
        dry = after
    return out


def place(planned: Plan, source: int, lo: int, hi: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of the ids [lo, hi) of a queue: their starts in the queue and in the sequences."""
    starts, places = [], []
    kind, rank = planned.kind[source], planned.rank[source]
    at_phase = max(0, bisect_right(planned.phases, lo, key=lambda p: p.before[kind]) - 1)
    # phases without a round of their own share their start with the next
    while at_phase and planned.phases[at_phase - 1].dry_after[kind] > rank:
        at_phase -= 1
    for p in islice(planned.phases, at_phase, None):
        if p.dry[kind] > rank or p.before[kind] >= hi:
            break
        first = p.before[kind]
        last = first + int(p.sent(kind, np.array(p.rounds, object)))
        a, b = max(lo, first), min(hi, last)
        if a < b:
            num = p.share[kind]
            k0, k1 = ((a - first) * p.den) // num, ((b - first) * p.den) // num + 1
            most = max(max(p.share), p.den, sum(n * x for n, x in zip(p.live, p.share)))
            small = (k1 + 1) * most < 1 << 62
            rounds = np.arange(max(0, k0 - 1), min(k1, p.rounds) + 1).astype(np.int64 if small else object)
            cut = first + p.sent(kind, rounds)
            at = p.start + p.sent_by_all(rounds)
            at = at + (p.sent_by_all(rounds + 1, kind) - p.sent_by_all(rounds, kind))
            end = first + p.sent(kind, rounds + 1)
            at = at + (rank - p.dry[kind]) * (end - cut)
            # the round behind the last one sends nothing here
            use = (end > a) & (cut < b) & (end > cut)
            cut, at = cut[use].astype(np.int64), at[use].astype(np.int64)
            if len(cut) and cut[0] < a:
                at[0] += a - cut[0]
                cut[0] = a
            starts.append(cut)
            places.append(at)
        if rank < p.dry_after[kind]:
            a, b = max(lo, last), hi
            if a < b:
                at = p.start + int(p.sent_by_all(np.array(p.rounds, object)))
                at += sum(planned.rest(p, c, p.dry_after[c]) for c in range(kind)) + planned.rest(p, kind, rank)
                starts.append(np.array([a]))
                places.append(np.array([at + a - last]))
            break
    cut, at = np.concatenate(starts), np.concatenate(places)
    # cut where a piece crosses into the next sequence
    size = np.diff(np.append(cut, hi))
    extra = (at + size - 1) // length - at // length
    many = np.repeat(np.arange(len(cut)), extra + 1)
    nth = np.arange(len(many)) - np.repeat(np.cumsum(extra + 1) - extra - 1, extra + 1)
    ahead = np.where(nth > 0, (at[many] // length + nth) * length - at[many], 0)
    return cut[many] + ahead, at[many] + ahead


def tokenized(df: DataFrame, text: str, doc_id: str, source: str, tokenizer: str, end_id: int) -> DataFrame:
    """Stored rows (task, queue, doc_id, inside, n, ids): the queues in the order of tasks and rows."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(tokenizer)
        task = TaskContext.get().partitionId()
        held: dict[str, int] = {}
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                piece = batch.slice(lo, 256)
                ids, lengths = code.encode(piece.column("text").to_pylist())
                ids = np.insert(ids, np.cumsum(lengths), end_id)
                ids = ids.astype("<u2" if code.width == 2 else "<u4")
                lengths = lengths + 1
                bounds = np.concatenate([[0], np.cumsum(lengths)]) * code.width
                queues, inside = piece.column("queue").to_pylist(), []
                for q, n in zip(queues, lengths.tolist()):
                    inside.append(held.get(q, 0))
                    held[q] = inside[-1] + n
                blob = pa.Array.from_buffers(
                    pa.binary(), len(lengths), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(ids)]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(lengths), task)), piece.column("queue"), piece.column("doc_id"),
                        pa.array(inside, pa.int64()), pa.array(lengths), blob,
                    ],
                    ["task", "queue", "doc_id", "inside", "n", "ids"],
                )
            pa.default_memory_pool().release_unused()

    chosen = df.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        F.coalesce(F.col(source).cast("string"), F.lit(NO_SOURCE)).alias("queue"),
    )
    coded = chosen.mapInArrow(rows, "task long, queue string, doc_id long, inside long, n long, ids binary")
    with settings(df.sparkSession, SMALL_BATCHES):
        return keep(coded, "packing-ids")


def pack(
    df: DataFrame,
    weights: Mapping[str, float] | None = None,
    length: int = LENGTH,
    text: str = "text",
    doc_id: str = "doc_id",
    source: str = "source",
    tokenizer: str | None = None,
    end_id: int = 2,
    with_ids: bool = True,
) -> DataFrame:
    """Cut all documents into pieces and place them in sequences of ``length`` ids.

    ``weights`` are the token shares that every sequence should have of each source;
    a source without one gets the smallest of them. Without any each source's share of all ids
    is its target (``share_weights``), so the mixture lasts almost to the last sequence.
    Returns doc_id, source, start, length, doc_tokens, sequence_id, offset, ids_crc32
    and, unless ``with_ids`` is false, ids: the piece's as little-endian numbers of 2 or 4 bytes.

    Only the last sequence is not full. A null or empty text is the end id alone. Rows
    without a source are a queue of their own. Rows with a null or repeated doc_id are
    documents like others. An empty table gives no rows; other columns are not read.

    No row is shuffled: ids are stored where they were made, the counts per task and
    source give each row's place in its queue. One row per source reaches the driver. Any
    number of sources is planned; the plan's size is at most that number times the different weights.
    """
    path = tokenizer or default_tokenizer()
    rows = tokenized(df, text, doc_id, source, path, end_id)
    width = encoder(path).width
    sums = rows.groupBy("queue", "task").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("queue").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    # one row per task and source
    starts = keep(sums.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "packing-starts")
    totals = starts.groupBy("queue").agg(F.sum("n").alias("n")).collect()
    found = sorted((r["queue"], int(r["n"])) for r in totals)
    given = {k: Fraction(v) for k, v in (weights or {}).items() if v > 0}
    least = min(given.values(), default=Fraction(1))
    queues = [q for q, _ in found]
    sizes = [n for _, n in found]
    planned = plan(sizes, [given.get(q, least) for q in queues] if given else share_weights(sizes), length)
    number = {q: i for i, q in enumerate(queues)}

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release(path)  # the ids are stored, no text is encoded any more
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                yield cut(batch.slice(at, 1000))

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        first, sizes = (batch.column(c).to_numpy() for c in ("place", "n"))
        runs: dict[tuple, list[int]] = {}
        for i, key in enumerate(zip(batch.column("queue").to_pylist(), batch.column("task").to_pylist())):
            runs.setdefault(key, []).append(i)
        parts = []
        for (queue, _), members in runs.items():
            # documents of one task stand next to each other in their queue
            own = np.array(members)[np.argsort(first[members], kind="stable")]
            lo = int(first[own[0]])
            hi = int(first[own[-1]] + sizes[own[-1]])
            starts, places = place(planned, number[queue], lo, hi, length)
            bounds = first[own]
            new = bounds[~np.isin(bounds, starts)]
            before = np.searchsorted(starts, new, "right") - 1
            starts, places = (
                np.concatenate([starts, new]), np.concatenate([places, places[before] + new - starts[before]])
            )
            order = np.argsort(starts, kind="stable")
            starts, places = starts[order], places[order]
            ends = np.append(starts[1:], hi)
            which = np.searchsorted(bounds, starts, "right") - 1
            # rows between two of the run may be in another batch
            inside = starts < bounds[which] + sizes[own[which]]
            ends = np.minimum(ends, bounds[which] + sizes[own[which]])
            parts.append([x[inside] for x in (own[which], starts - bounds[which], ends - starts, places)])
        row, start, size, at = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((start, row))
        row, start, size, at = row[order], start[order], size[order], at[order]
        data, _ = buffer_of(batch.column("ids"))
        wide = memoryview(data.view("<u2" if width == 2 else "<u4").astype("<u4").tobytes())
        edges = np.concatenate([[0], np.cumsum(size)])
        bytes_at = (4 * edges).tolist()
        crcs = [zlib.crc32(wide[a:b]) for a, b in zip(bytes_at, bytes_at[1:])]
        columns = [
            batch.column("doc_id").take(pa.array(row)), batch.column("source").take(pa.array(row)),
            *(pa.array(x) for x in (start, size, sizes[row], at // length, at % length)),
            pa.array(crcs, pa.int64()),
        ]
        names = ["doc_id", "source", "start", "length", "doc_tokens", "sequence_id", "offset", "ids_crc32"]
        if with_ids:
            offsets = pa.py_buffer((width * edges).astype(np.int32))
            names.append("ids")
            columns.append(
                pa.Array.from_buffers(pa.binary(), len(row), [None, offsets, pa.py_buffer(data.tobytes())])
            )
        return pa.RecordBatch.from_arrays(columns, names)

    placed = rows.join(starts.select("queue", "task", "before"), ["queue", "task"]).select(
        "queue", "task", "doc_id", (F.col("before") + F.col("inside")).alias("place"), "n", "ids",
        F.when(F.col("queue") != NO_SOURCE, F.col("queue")).alias("source"),
    )
    schema = (
        "doc_id long, source string, start long, length long, doc_tokens long, sequence_id long, "
        "offset long, ids_crc32 long"
    )
    return placed.mapInArrow(pieces, schema + ", ids binary" if with_ids else schema)
