"""Words, shingles and minimizers of many texts at once, as numpy arrays.

All hashes are 64-bit and depend on content alone, so equal text gets equal
hashes in every task and on every run. Words are runs of bytes other than
``\\x20`` and ``\\x09-\\x0D``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 500_000  # text handled at once; a longer single text is handled alone

#: Rows of whole texts that are handed to Python at once; as many again wait meanwhile.
SMALL_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}

# An odd multiplier and its inverse modulo 2^64, and mixing constants.
BASE = 0x9E3779B97F4A7C15
SECOND_BASE = 0xD1342543DE82EF95
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        factors = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
        factors[0] = 1
        known = np.cumprod(factors)
        if len(known) <= 4 * CHUNK_BYTES:
            _powers[base] = known
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * MIX_1
    x ^= x >> np.uint64(27)
    x *= MIX_2
    x ^= x >> np.uint64(31)
    return x


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column and the row boundaries in them; null counts as empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    bounds = bounds[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
    return data, bounds - bounds[0]


def chunks(bounds: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [lo, hi) of at most ``size`` bytes, or one row."""
    lo, rows = 0, len(bounds) - 1
    while lo < rows:
        hi = int(np.searchsorted(bounds, bounds[lo] + size, "right")) - 1
        hi = min(max(hi, lo + 1), rows)
        yield lo, hi
        lo = hi


def texts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, boundaries from 0) for each chunk of a column."""
    data, bounds = buffer_of(column)
    for lo, hi in chunks(bounds):
        yield lo, hi, data[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo]


def prefix_hash(values: np.ndarray, base: int = BASE) -> np.ndarray:
    """Sums of (value + 1) * base^position, from which any range's hash follows."""
    out = np.zeros(len(values) + 1, np.uint64)
    terms = values.astype(np.uint64)
    terms += np.uint64(1)
    terms *= powers(base, len(values))
    np.cumsum(terms, out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = BASE) -> np.ndarray:
    """Hash of values[start:end]; equal for equal content, at any position."""
    shift = powers(pow(base, -1, 1 << 64), len(prefix))[start]
    length = (end - start).astype(np.uint64) * MIX_1
    return mix((prefix[end] - prefix[start]) * shift + length)


def word_bounds(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and per row the boundaries in these arrays."""
    inside = ~SPACE[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    before[inner] = False
    after[inner - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def word_hashes(
    data: np.ndarray, bounds: np.ndarray, lower: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, row boundaries and hashes of all words."""
    starts, ends, rows = word_bounds(data, bounds)
    prefix = prefix_hash(LOWER[data] if lower else data)
    return starts, ends, rows, range_hash(prefix, starts, ends)


def gram_hashes(items: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` items, by start; runs may cross row boundaries."""
    n = len(items) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * np.uint64(BASE) + items[k : k + n]
    return mix(out)


def within(rows: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of the first ``n`` starts have ``size`` items in their own row."""
    left = np.repeat(rows[1:], np.diff(rows))[:n] - np.arange(n)
    return left >= size


def minimizers(hashes: np.ndarray, window: int) -> np.ndarray:
    """For every window of ``window`` hashes the position of its smallest one, by start.

    The upper 32 bits decide, and then the leftmost position. So the place inside
    a window depends on the window's own content only.
    """
    n = len(hashes)
    if n < window:
        return np.zeros(0, np.int64)
    key = (hashes >> np.uint64(32) << np.uint64(32)) | np.arange(n, dtype=np.uint64)
    width = 1
    while 2 * width <= window:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    rest = window - width
    if rest:
        key = np.minimum(key[:-rest], key[rest:])
    return (key & np.uint64(0xFFFFFFFF)).astype(np.int64)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes start, start + 1, .. of every range, one range after another."""
    total = int(lengths.sum())
    kind = np.int32 if total < 1 << 31 and int(starts.max(initial=0)) < 1 << 30 else np.int64
    skip = np.repeat((starts - (np.cumsum(lengths) - lengths)).astype(kind), lengths)
    skip += np.arange(total, dtype=kind)
    return skip
