"""Removal of word sequences that occur elsewhere, by suffix automata of reference shards.

The reference is the corpus itself. Only phrases that share a trigger with others can hold
a repeated sequence (``repeats``), and all such phrases of one trigger meet in one task: they
are a reference shard. The task builds the suffix automaton of the shard with the number of
phrases behind each state, and streams the phrases through it for matching statistics, the
longest suffix at each word that another phrase holds as well. Where that reaches the window
length, the window is a repeated one; overlapping windows form the maximal spans.

The automata go to the task that holds the shard and are not sent to all tasks: a broadcast
of every shard to every task would grow with the square of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm import repeats

WINDOW = 35
GRAM = 12


class SuffixAutomaton:
    """Of several sequences; ``counts`` tells how many end positions a state stands for."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.counts = [-1], [0], [0]

    def _state(self, length: int, link: int, moves: dict, count: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        self.counts.append(count)
        return len(self.length) - 1

    def add(self, sequence: list) -> None:
        last = 0
        for symbol in sequence:
            last = self._extend(last, symbol)

    def _extend(self, last: int, symbol) -> int:
        nxt, link, length = self.next, self.link, self.length
        if symbol in nxt[last]:
            known = nxt[last][symbol]
            if length[known] != length[last] + 1:
                known = self._split(last, known, symbol)
            self.counts[known] += 1
            return known
        made = self._state(length[last] + 1, 0, {}, 1)
        p = last
        while p >= 0 and symbol not in nxt[p]:
            nxt[p][symbol] = made
            p = link[p]
        if p >= 0:
            known = nxt[p][symbol]
            if length[known] != length[p] + 1:
                known = self._split(p, known, symbol)
            link[made] = known
        return made

    def _split(self, p: int, known: int, symbol) -> int:
        """The state of the shorter strings of ``known`` becomes one of its own."""
        nxt, link = self.next, self.link
        copy = self._state(self.length[p] + 1, link[known], dict(nxt[known]), 0)
        link[known] = copy
        while p >= 0 and nxt[p].get(symbol) == known:
            nxt[p][symbol] = copy
            p = link[p]
        return copy

    def finish(self) -> None:
        """Pass the counts on to the shorter suffixes."""
        order = sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True)
        for state in order:
            if self.link[state] > 0:
                self.counts[self.link[state]] += self.counts[state]

    def shared(self, sequence: list) -> Iterator[int]:
        """At each symbol the length of the longest suffix that ends at two places or more."""
        state, size = 0, 0
        nxt, link, length, counts = self.next, self.link, self.length, self.counts
        for symbol in sequence:
            while True:
                to = nxt[state].get(symbol)
                if to is not None and counts[to] > 1:
                    state, size = to, size + 1
                    break
                if not state:
                    size = 0
                    break
                state = link[state]
                size = length[state]
            yield size


def shared_windows(window: int) -> repeats.Compare:
    def compare(contents: list[bytes], first: list[int]) -> list[np.ndarray]:
        out = []
        for a, b in zip(first, [*first[1:], len(contents)]):
            shard = [c.split(b" ") for c in contents[a:b]]
            automaton = SuffixAutomaton()
            for words in shard:
                automaton.add(words)
            automaton.finish()
            for words in shard:
                sizes = np.fromiter(automaton.shared(words), np.int64, len(words))
                out.append(sizes[window - 1 :] >= window)
        return out

    return compare


def remove_repeats(
    df: DataFrame, window: int = WINDOW, gram: int = GRAM, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) per row of ``df``.

    Words are runs of bytes other than ``\\x20`` and ``\\x09-\\x0D``. A word goes if it lies in a
    run of ``window`` words that also starts anywhere else in the table, in the same text or
    another; that is judged on the texts as given. ``kept`` are the other words joined by a blank.

    Null and empty texts have no words. Equal rows are documents of their own, and as each holds
    what the other holds, both lose it. Rows with null or equal ids are told apart by their
    texts. An empty table gives no rows; other columns are not read. A text must fit into a
    task's memory some fifty times over while it is parsed.
    """
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    units = repeats.Units(True, window, gram)
    docs, spans = repeats.repeated_spans(rows, units, shared_windows(window))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                total, gone, kept = [], [], []
                for z, own in zip(piece.column("z").to_pylist(), piece.column("spans").to_pylist()):
                    words = tool.decompress(z).split()
                    total.append(len(words))
                    if own:
                        mask = repeats.covered(own, len(words))
                        words = [words[i] for i in np.flatnonzero(~mask).tolist()]
                    gone.append(total[-1] - len(words))
                    kept.append(b" ".join(words).decode())
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                     pa.array(kept, pa.string())],
                    ["doc_id", "n_words", "n_removed", "kept"],
                )

    return docs.join(spans, ["doc", "tag"], "left").select("doc_id", "z", "spans").mapInArrow(
        cut, "doc_id long, n_words long, n_removed long, kept string"
    )
