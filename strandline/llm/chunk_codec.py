"""BPE encoding and decoding with content-defined chunks that documents share.

A rolling hash over the text's bytes cuts it wherever the hash has a given remainder, so
the same passage is cut in the same places in every document. A worker encodes each chunk
once and puts every further document that holds it together from what it has.

Encoded on its own, a chunk may have other ids at its ends than inside the text, for a cut
may part a word. The tokenizer drops white space and no id comes from both sides of a blank
or a line break. So a join is encoded anew from the last such place before the cut to the
first behind it, and further while a chunk holds none. The ids next to that stretch must be
those the chunks have, which is checked for every chunk when it is encoded.

No text leaves its task. Sending every chunk to one place where it is encoded once for the
whole corpus moves the text, and then its ids back, through the network.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strandline.llm.text import SMALL_BATCHES, prefix_hash, range_hash, texts
from strandline.llm.tokens import default_tokenizer, encoder
from strandline.session import keep, settings

WINDOW = 24  # bytes that decide about a cut
MEAN_BYTES = 2048  # of a chunk
MOST_BYTES = 16 * MEAN_BYTES  # a chunk is cut after so many, without a trigger
KEPT_IDS = 8_000_000  # ids of chunks that a worker remembers at least, if it has seen as many; and twice as many at most
KEPT_JOINS = 200_000  # encoded joins that a worker remembers,
SHORT_JOIN = 200  # of so many characters at most
ROWS = 256  # texts handled at once
BREAKS = " \n"  # no id comes from both sides of these


def cuts(data: np.ndarray, bounds: np.ndarray, mean: int = MEAN_BYTES) -> np.ndarray:
    """Byte positions at which a chunk begins, those of ``bounds`` included, in rising order.

    Positions lie on the first byte of a character.
    """
    n = len(data)
    chosen = np.zeros(0, np.int64)
    if n > WINDOW:
        at = np.arange(n - WINDOW + 1)
        hashes = range_hash(prefix_hash(data), at, at + WINDOW)
        chosen = at[hashes % np.uint64(mean) == 0] + WINDOW
        # a window that reaches over the border of two texts decides nothing
        text = np.searchsorted(bounds, chosen, "right")
        chosen = chosen[chosen - WINDOW >= bounds[text - 1]]
    edges = np.unique(np.concatenate([bounds, chosen]))
    lengths = np.diff(edges)
    far = np.flatnonzero(lengths > MOST_BYTES)
    more = [np.arange(edges[i] + MOST_BYTES, edges[i + 1], MOST_BYTES) for i in far]
    edges = np.unique(np.concatenate([edges, *more])).astype(np.int64)
    for _ in range(3):  # out of the middle of a character
        inner = edges < n
        inside = np.zeros(len(edges), bool)
        inside[inner] = (data[edges[inner]] & 0xC0) == 0x80
        edges = edges + inside
    return np.unique(edges)


def chunk_name(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


def chunked(column: pa.Array, mean: int) -> Iterator[tuple[int, list[bytes]]]:
    """(row, chunks) of every text of a column; a null or empty text has none."""
    for lo, hi, data, bounds in texts(column):
        edges = cuts(data, bounds, mean)
        rows = np.searchsorted(edges, bounds)
        raw = data.tobytes()
        edges = edges.tolist()
        for i in range(hi - lo):
            own = edges[rows[i] : rows[i + 1] + 1]
            yield lo + i, [raw[a:b] for a, b in zip(own, own[1:])]


class Codec:
    """A worker's tokenizer, with the chunks and joins it has encoded and the texts of the ids."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        if not parted_by_breaks(tokenizer):
            raise ValueError("ids at a break depend on what stands behind it")
        self.encoder = encoder(path)
        size = tokenizer.get_vocab_size()
        self.names = [tokenizer.id_to_token(i) or "" for i in range(size)]
        self.numbers = [str(i) for i in range(size)]
        self.joins: dict[str, list[int]] = {}
        # chunks met lately and before; the older ones are forgotten all at once
        self.recent: dict[bytes, Chunk] = {}
        self.older: dict[bytes, Chunk] = {}
        self.held = 0
        self.encoded = 0  # chunks so far

    def encode(self, pieces: list[str]) -> list[np.ndarray]:
        ids, counts = self.encoder.encode(pieces)
        return np.split(ids, np.cumsum(counts)[:-1]) if pieces else []

    def encode_joins(self, pieces: list[str]) -> list[list[int]]:
        new = list({p for p in pieces if p not in self.joins})
        self.joins.update(zip(new, [ids.tolist() for ids in self.encode(new)]))
        out = [self.joins[p] for p in pieces]
        for p in new:
            if len(p) > SHORT_JOIN:
                del self.joins[p]
        if len(self.joins) > KEPT_JOINS:
            self.joins = {}
        return out

    def chunks(self, by_name: dict[bytes, bytes]) -> dict[bytes, Chunk]:
        """All wanted chunks by name; those not remembered are encoded now."""
        out = {}
        for name in by_name:
            found = self.recent.get(name) or self.older.get(name)
            if found:
                out[name] = found
        missing = [name for name in by_name if name not in out]
        out.update(zip(missing, encoded([by_name[n].decode() for n in missing], self)))
        self.encoded += len(missing)
        for name, chunk in out.items():
            if name not in self.recent:
                self.recent[name] = chunk
                self.held += len(chunk.middle) if chunk.middle is not None else len(chunk.head)
        if self.held > KEPT_IDS:
            self.older, self.recent, self.held = self.recent, {}, 0
        return out


_codecs: dict[str, Codec] = {}


def codec_of(path: str) -> Codec:
    """The worker's codec for a tokenizer file, with what it has kept so far."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


@dataclass(frozen=True, slots=True)
class Chunk:
    """Ids between the first and the last break, and what stands before and behind these.

    A chunk without a break is all head; it has no middle.
    """

    middle: np.ndarray | None
    head: str
    tail: str


def parted_by_breaks(tokenizer: Tokenizer) -> bool:
    """Whether every entry of the vocabulary has its own ids between breaks, whatever its neighbours."""
    special = {str(t.content) for t in tokenizer.get_added_tokens_decoder().values()}
    entries = [e.replace("</w>", "") for e in tokenizer.get_vocab() if e not in special]
    alone = [i for e in tokenizer.encode_batch_fast(entries, add_special_tokens=False) for i in e.ids]
    return all(tokenizer.encode(mark.join(entries), add_special_tokens=False).ids == alone for mark in BREAKS)


def head_and_tail(chunk: str) -> tuple[int, int]:
    """End of what stands before the first break, start of what stands behind the last; -1 without a break."""
    first = min((p for p in map(chunk.find, BREAKS) if p >= 0), default=-1)
    return first, max(map(chunk.rfind, BREAKS)) + 1 if first >= 0 else -1


def encoded(chunks: list[str], codec: Codec) -> list[Chunk]:
    """The ids of a whole chunk must begin with those of its head and end with those of its tail."""
    parts = [head_and_tail(c) for c in chunks]
    heads = [c if a < 0 else c[:a] for c, (a, _) in zip(chunks, parts)]
    tails = ["" if a < 0 else c[b:] for c, (a, b) in zip(chunks, parts)]
    ids, head_ids, tail_ids = codec.encode(chunks), codec.encode_joins(heads), codec.encode_joins(tails)
    out = []
    for whole, head, tail, h, t, (a, _) in zip(ids, heads, tails, head_ids, tail_ids, parts):
        middle = None
        if a >= 0:
            end = len(whole) - len(t)
            if len(h) > end or whole[: len(h)].tolist() != h or whole[end:].tolist() != t:
                raise ValueError("ids at a break depend on what stands behind it")
            middle = whole[len(h) : end].copy()
        out.append(Chunk(middle, head, tail))
    return out


def put_together(chunks: list[Chunk]) -> tuple[list[str], list[np.ndarray]]:
    """The stretches to encode anew and the middles of a document, which alternate; stretches are first and last."""
    joins, middles, open_parts = [], [], []
    for chunk in chunks:
        open_parts.append(chunk.head)
        if chunk.middle is not None:
            joins.append("".join(open_parts))
            middles.append(chunk.middle)
            open_parts = [chunk.tail]
    return [*joins, "".join(open_parts)], middles


def encode_documents(
    df: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    tokenizer: str | None = None,
    mean_bytes: int = MEAN_BYTES,
    digests: bool = False,
) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every text, as the tokenizer file has them for whole texts.

    ``ids`` are little-endian unsigned 32-bit numbers; no special ids are added, and the
    file's truncation and padding are not used. ``decoded`` is what the ids stand for, with
    special tokens. With ``digests`` the last two columns are instead ids_sha256, of the
    decimal ids joined by one space, and decoded_sha256, of the UTF-8 text.

    The file's tokenizer must drop blanks and line breaks and not decode by rules of its
    own; where ids depend on what stands behind a break the job fails. A null text is
    empty: it has no ids. Rows of equal id, null ids included, keep a result each. An empty
    table gives no rows. Other columns are not read.

    Nothing is shuffled. A worker keeps the ids of the chunks it met last (``KEPT_IDS``) for
    all its tasks, so a chunk that many documents share is encoded once by each worker.
    Chunks are told apart by 128-bit hashes.
    """
    path = tokenizer or default_tokenizer()
    if Tokenizer.from_file(path).decoder is not None:
        raise ValueError("the tokenizer decodes by rules of its own")
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    last = "ids_sha256 string, decoded_sha256 string" if digests else "ids binary, decoded string"

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                piece = batch.slice(lo, ROWS)
                named = [[(chunk_name(c), c) for c in chunks] for _, chunks in chunked(piece.column("text"), mean_bytes)]
                known = codec.chunks(dict(pair for own in named for pair in own))
                documents = [put_together([known[name] for name, _ in own]) for own in named]
                joins = iter(codec.encode_joins([j for stretches, _ in documents for j in stretches]))
                counts, results = [], []
                for _, middles in documents:
                    ids = list(next(joins))
                    for middle in middles:
                        ids += middle.tolist()
                        ids += next(joins)
                    decoded = " ".join(map(codec.names.__getitem__, ids))
                    counts.append(len(ids))
                    if digests:
                        decimal = " ".join(map(codec.numbers.__getitem__, ids))
                        results.append([hashlib.sha256(x.encode()).hexdigest() for x in (decimal, decoded)])
                    else:
                        results.append((np.array(ids, "<u4").tobytes(), decoded))
                kinds = [pa.string(), pa.string()] if digests else [pa.binary(), pa.string()]
                columns = [pa.array(c, k) for c, k in zip(zip(*results), kinds)]
                names = ["doc_id", "n_tokens", *[x.split()[0] for x in last.split(", ")]]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(counts, pa.int64()), *columns], names)

    with settings(df.sparkSession, SMALL_BATCHES):
        return keep(rows.mapInArrow(code, f"doc_id long, n_tokens long, {last}"), "encoded")
