"""Vectorised text kernels: chunking of Arrow batches, words, and hashes of spans.

Hashes of spans come from prefix sums of a polynomial modulo 2**64 over random
values, so the hash of any span costs two look-ups, whatever its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}

#: Bytes of text that one chunk holds, unless a single document is longer: what fits the tables of powers of 2**19.
CHUNK_BYTES = 500_000


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (new array)."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for name, base in (("up", BASE), ("down", _INVERSE)):
            table = np.full(size, base, dtype=U)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"][:n], _powers["down"][:n]


BYTE_VALUE = mix(np.arange(1, 257, dtype=U) * U(0x632BE59BD9B4E019))
LOWER_VALUE = BYTE_VALUE.copy()
LOWER_VALUE[65:91] = BYTE_VALUE[97:123]
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def prefix_sums(values: np.ndarray) -> np.ndarray:
    up, _ = _power_tables(len(values) + 1)
    out = np.zeros(len(values) + 1, dtype=U)
    np.cumsum(values * up[: len(values)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the spans [start, end) of the values behind `sums`."""
    _, down = _power_tables(len(sums))
    return mix((sums[end] - sums[start]) * down[start])


def gram_hash(sums: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all spans of length k, by start."""
    n = len(sums) - k
    if n <= 0:
        return np.empty(0, dtype=U)
    _, down = _power_tables(len(sums))
    return mix((sums[k:] - sums[:n]) * down[:n])


def slide_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values."""
    if len(x) < w:
        return x[:0]
    step = 1
    while step * 2 <= w:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    if rest := w - step:
        x = np.minimum(x[:-rest], x[rest:])
    return x


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; nulls count as empty."""
    kind = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    column = column.cast(kind)
    if column.null_count:
        column = pc.fill_null(column, b"" if kind == pa.large_binary() else "")
    _, offsets, data = column.buffers()
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw, off


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets from 0) over rows of about `limit` bytes together."""
    raw, off = buffers(column)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, side="right")) - 1)
        hi = min(hi, n, lo + 65536)
        yield lo, hi, raw[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
        lo = hi
    # workers are used again, and would keep the room of their largest batch
    pa.default_memory_pool().release_unused()


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words `[^\\x20\\x09-\\x0D]+`, and each document's range of words."""
    gap = SPACE[data]
    before = np.empty(len(data) + 1, dtype=bool)
    before[0] = before[-1] = True
    before[1:] = gap
    edges = off[(off > 0) & (off < len(data))]
    before[edges] = True
    first = np.flatnonzero(~gap & before[:-1])
    after = np.ones(len(data), dtype=bool)
    after[:-1] = gap[1:]
    after[edges - 1] = True
    last = np.flatnonzero(~gap & after) + 1
    return first, last, np.searchsorted(first, off)


def word_hash(data: np.ndarray, first: np.ndarray, last: np.ndarray, *, lower: bool = False) -> np.ndarray:
    return span_hash(prefix_sums((LOWER_VALUE if lower else BYTE_VALUE)[data]), first, last)


def owner(off: np.ndarray) -> np.ndarray:
    """For each item, the number of the document that holds it."""
    return np.repeat(np.arange(len(off) - 1), np.diff(off))
