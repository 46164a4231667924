"""Byte-level helpers used inside tasks: Arrow text columns as numpy arrays,
words, and position-independent 64-bit hashes of substrings.

A substring hash is a polynomial over Z/2^64 taken from prefix sums, so the
hash of any [start, end) of a buffer costs two look-ups.  Work space is bounded:
buffers are handled in segments of about ``SEGMENT`` bytes cut at separators.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SEGMENT = 1 << 20

U64 = np.uint64
_MIX1, _MIX2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)

# White space of the text contracts: \x20 and \x09-\x0D.
SPACE_BYTES = b" \t\n\x0b\x0c\r"


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit values (splitmix64)."""
    x = (x ^ (x >> U64(30))) * _MIX1
    x = (x ^ (x >> U64(27))) * _MIX2
    return x ^ (x >> U64(31))


def byte_table(seed: int) -> np.ndarray:
    """A random 64-bit value for each byte."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))


def fold_table() -> np.ndarray:
    """Byte -> byte with A-Z lower-cased."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def space_word_table() -> np.ndarray:
    """True for the bytes of words between white space."""
    t = np.ones(256, dtype=bool)
    t[list(SPACE_BYTES)] = False
    return t


def alnum_word_table() -> np.ndarray:
    """True for 0-9, A-Z, a-z and every byte of a non-ASCII code point."""
    t = np.zeros(256, dtype=bool)
    t[48:58] = t[65:91] = t[97:123] = t[128:] = True
    return t


class Powers:
    """Powers of an odd base modulo 2^64 and of its inverse, grown on demand."""

    def __init__(self, base: int = 0x9E3779B97F4A7C15 | 1):
        self.base = base % 2**64
        self.inverse = pow(self.base, -1, 2**64)
        self.up = self.down = np.ones(1, dtype=U64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, SEGMENT + 1)
            for name, step in (("up", self.base), ("down", self.inverse)):
                a = np.full(size, U64(step), dtype=U64)
                a[0] = 1
                setattr(self, name, np.cumprod(a, dtype=U64))
        return self.up, self.down


POWERS = Powers()


def value_sums(values: np.ndarray) -> np.ndarray:
    """H with H[i] = sum of values[j] * base^j for j < i (n + 1 values)."""
    up, _ = POWERS.to(len(values) + 1)
    out = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum(values * up[: len(values)], out=out[1:])
    return out


def prefix_sums(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    return value_sums(table[data])


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the spans [start, end), whatever their place in the buffer."""
    _, down = POWERS.to(len(prefix))
    h = (prefix[end] - prefix[start]) * down[start]
    return mix(h + (end - start).astype(U64) * _MIX2)


def column_bytes(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all values, n + 1 offsets) of an Arrow string / binary array,
    without a copy; a null value has no bytes."""
    import pyarrow as pa

    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type)
                            else b"")
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[col.offset: col.offset + len(col) + 1]
    off = off.astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[off[0]: off[-1]], off - off[0]


def row_chunks(offsets: np.ndarray, limit: int = SEGMENT) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``limit`` bytes (one row at least)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


class Words:
    """Finds and hashes the words of buffers of concatenated documents; with
    ``fold``, words that differ in the case of A-Z only hash alike."""

    def __init__(self, word_bytes: np.ndarray, seed: int = 1, fold: bool = True):
        self.is_word = word_bytes
        self.table = byte_table(seed)[fold_table()] if fold else byte_table(seed)

    def _segment(self, data: np.ndarray, cuts: np.ndarray):
        w = self.is_word[data]
        first, last = w.copy(), w.copy()
        first[1:] &= ~w[:-1]
        last[:-1] &= ~w[1:]
        cuts = cuts[(cuts > 0) & (cuts < len(data))]
        first[cuts] = w[cuts]
        last[cuts - 1] = w[cuts - 1]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        return start, end, span_hash(prefix_sums(data, self.table), start, end)

    def find(self, data: np.ndarray, offsets: np.ndarray):
        """(start, end, hash) of every word; no word crosses an offset."""
        if len(data) <= 2 * SEGMENT:
            return self._segment(data, offsets)
        parts, at = [], 0
        while at < len(data):
            to, size = len(data), SEGMENT
            while at + size < len(data):  # cut behind a separator; a longer word grows the segment
                seps = np.flatnonzero(~self.is_word[data[at: at + size]])
                if len(seps):
                    to = at + int(seps[-1]) + 1
                    break
                size *= 2
            cuts = offsets[(offsets > at) & (offsets < to)] - at
            s, e, h = self._segment(data[at:to], cuts)
            parts.append((s + at, e + at, h))
            at = to
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def owners(offsets: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Index of the row that holds each byte position."""
    return np.searchsorted(offsets, positions, side="right") - 1
