"""Token ids of whole texts, by a public tokenizer file.

The tokenizer drops white space and never joins what stands on both sides of a
blank or a line break. So a text's ids are those of its pieces between blanks and
line breaks, and frequent pieces need encoding once per worker only. It lower-cases,
so Latin-1 texts, where that is the same in every library, are lower-cased first. It
parts letters from the comma or full stop behind them, so those are kept apart too.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from strandline.llm.text import ragged

MOST_PIECES = 700_000  # kept per worker; beyond, the less used half is forgotten
LONG_PIECE = 64  # characters; longer pieces are kept up to ...
MOST_LONG = 4_000_000  # ... so many characters in all

_encoders: dict[str, PieceEncoder] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder for a tokenizer file, with what it has kept so far."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def release(path: str) -> None:
    """Let go of the worker's encoder and of the buffers that Arrow holds ready.

    A worker that waits for its next task keeps both otherwise, some 130 MB once the encoder has
    met many pieces, while the stages after it need the memory.
    """
    _encoders.pop(path, None)
    pa.default_memory_pool().release_unused()


def lowered(text: str) -> str:
    """The text in lower case if it is Latin-1 without special tokens, else as it is."""
    if not text.isascii():
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
    return text if "<|" in text else text.lower()


def plain_letters(piece: str) -> bool:
    """Whether all are letters below U+02B0, which lower-casing keeps letters."""
    return piece.isalpha() and max(piece) < "\u02b0" and "\u0130" not in piece


class PieceEncoder:
    def __init__(self, path: str, most: int = MOST_PIECES):
        self.tokenizer = Tokenizer.from_file(path)
        self.most = most
        added = self.tokenizer.get_added_tokens_decoder()
        # a special token between two pieces keeps them apart in one call
        self.mark_id, self.mark = max((i, str(t.content)) for i, t in added.items())
        self.special = tuple(str(t.content) for t in added.values())
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        vocabulary = self.tokenizer.get_vocab()
        self.word_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.word_end[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._reset()

    def _reset(self) -> None:
        self.codes: dict[str, int] = {"": 0}
        self.starts, self.lengths = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.pool = np.zeros(0, np.uint32)
        self.uses = np.zeros(1, np.int64)
        self.long = 0

    def _encode_new(self, pieces: list[str]) -> None:
        """Add pieces; one of letters and a final mark is put together from both."""
        tails = [p for p in pieces if len(p) > 1 and p[-1] in ",." and plain_letters(p[:-1])]
        stems = {p[:-1] for p in tails} | {p[-1] for p in tails}
        plain = set(pieces).difference(tails) | {p for p in stems if p not in self.codes}
        odd = [p for p in plain if "<|" in p and any(s in p for s in self.special)]
        plain.difference_update(odd)
        # a piece of letters is one word to the tokenizer and ends with the only word-end id
        letters = [p for p in plain if plain_letters(p)]
        others = list(plain.difference(letters))
        plain = letters + others
        parts, lengths = [], []
        for ids in self._encode_joined(letters, " "):
            ends = np.flatnonzero(self.word_end[ids])
            parts.append(ids)
            lengths.append(np.diff(ends, prepend=-1))
        for ids in self._encode_joined(others, self.mark):
            edges = np.concatenate([[-1], np.flatnonzero(ids == self.mark_id), [len(ids)]])
            parts.append(ids[ids != self.mark_id])
            lengths.append(np.diff(edges) - 1)
        if sum(map(len, lengths)) != len(plain):
            raise ValueError("the tokenizer joins or parts pieces")
        for p in odd:
            ids = np.array(self.tokenizer.encode(p, add_special_tokens=False).ids, np.uint32)
            parts.append(ids)
            lengths.append(np.array([len(ids)]))
        self._append(plain + odd, parts, lengths)
        if tails:
            both = np.array([[self.codes[p[:-1]], self.codes[p[-1]]] for p in tails]).ravel()
            own = self.lengths[both]
            ids = self.pool[ragged(self.starts[both], own)]
            self._append(tails, [ids], [own.reshape(-1, 2).sum(1)])

    def _encode_joined(self, pieces: list[str], mark: str) -> Iterator[np.ndarray]:
        for at in range(0, len(pieces), 1024):
            joined = mark.join(pieces[at : at + 1024])
            (coded,) = self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)
            yield np.array(coded.ids, np.uint32)

    def _append(self, pieces: list[str], parts: list, lengths: list) -> None:
        if not pieces:
            return
        first = len(self.lengths)
        self.codes.update(zip(pieces, range(first, first + len(pieces))))
        added = np.concatenate(lengths).astype(np.int64)
        self.starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(added) - added])
        self.lengths = np.concatenate([self.lengths, added])
        self.pool = np.concatenate([self.pool, *parts])
        self.uses = np.concatenate([self.uses, np.zeros(len(pieces), np.int64)])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one text after another, and the number of ids of each text.

        A null text is empty.
        """
        pieces: list[str] = []
        counts = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            if text:
                own = lowered(text).replace("\n", " ").split(" ")
                counts[i] = len(own)
                pieces += own
        codes = self._codes(pieces)
        missing = np.flatnonzero(codes < 0)
        if len(missing):
            absent = [pieces[i] for i in missing.tolist()]
            new = list(set(absent))
            self._encode_new(new)
            self.long += sum(len(p) for p in new if len(p) > LONG_PIECE)
            codes[missing] = self._codes(absent)
        lengths = self.lengths[codes]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        edges = np.concatenate([[0], np.cumsum(counts)])
        ids = self.pool[ragged(self.starts[codes], lengths)]
        self.uses += np.bincount(codes, minlength=len(self.uses))
        if len(self.codes) > self.most or self.long > MOST_LONG:
            self._forget()
        return ids, np.diff(ends[edges])

    def _codes(self, pieces: list[str]) -> np.ndarray:
        return np.fromiter(map(self.codes.get, pieces, repeat(-1)), np.int32, len(pieces))

    def _forget(self) -> None:
        """Drop long pieces, and if there are too many, the less used half."""
        self.long = 0
        names = np.array(list(self.codes), object)
        good = np.fromiter((len(p) <= LONG_PIECE for p in names), bool, len(names))
        if len(names) > self.most:
            often = np.argpartition(self.uses, len(names) // 2)[len(names) // 2 :]
            used = np.zeros(len(names), bool)
            used[often] = True
            good &= used
        good[0] = True
        chosen = np.flatnonzero(good)
        lengths = self.lengths[chosen]
        self.pool = self.pool[ragged(self.starts[chosen], lengths)]
        self.starts, self.lengths = np.cumsum(lengths) - lengths, lengths
        self.uses = self.uses[chosen] // 2
        self.codes = dict(zip(names[chosen], range(len(chosen))))
