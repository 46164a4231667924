"""Column-wise construction of the Burrows-Wheeler transform and the common
prefixes of a collection of strings.

Round j inserts one symbol of each string, the j-th from its end, and so the
suffixes of length j into the sorted rows of all suffixes up to now.  A row's
transform symbol is the one in front of its suffix; the new suffix belongs behind
as many rows as there are smaller transform symbols, and equal ones above the row
it extends.  Its common prefix with a neighbour that begins with the same symbol
is one more than the least common prefix between the rows they extend.  The
arrays of a round are read and written front to back; above ``MEMORY_ROWS`` rows
they are unlinked scratch files of the task.
"""

from __future__ import annotations

import tempfile

import numpy as np

MEMORY_ROWS = 8 << 20
END = 0xFF              # no byte of UTF-8 text


def _array(n: int, dtype) -> np.ndarray:
    if n <= MEMORY_ROWS:
        return np.empty(n, dtype)
    with tempfile.TemporaryFile() as f:     # the mapping keeps the unlinked file
        return np.memmap(f, dtype, "w+", shape=(n,))


class RangeMinimum:
    """Least value of ranges of an array of small numbers."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        size = 1
        while size * 2 <= len(values):
            above = self.levels[-1]
            self.levels.append(np.minimum(above[:-size], above[size:]))
            size *= 2

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minima of values[lo .. hi], both included."""
        level = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
        out = np.empty(len(lo), np.int64)
        for k in np.flatnonzero(np.bincount(level)).tolist():
            of = np.flatnonzero(level == k)
            out[of] = np.minimum(self.levels[k][lo[of]], self.levels[k][hi[of] - (1 << k) + 1])
        return out


def _inserted(old: np.ndarray, keep: np.ndarray, at: np.ndarray, new: np.ndarray) -> np.ndarray:
    """``old`` with ``new`` put at the rows ``at``; ``keep`` marks the other rows."""
    out = _array(len(keep), old.dtype)
    out[keep] = old
    out[at] = new
    return out


def suffixes(data: np.ndarray, offsets: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """(places in ``data``, common prefix with the one before, at most ``cap``) of
    all suffixes of the strings, in sorted order."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    # Strings with an end mark in front of each, so that a first symbol is told.
    flat = np.full(len(data) + n + 1, END, np.uint8)
    flat[np.arange(len(data)) + np.repeat(np.arange(n), sizes) + 1] = data
    at = offsets[1:] + np.arange(n) + 1             # the empty suffixes
    common, symbol = np.zeros(n, np.uint8), flat[at - 1]
    grown = np.flatnonzero(symbol != END)           # rows that the next round extends
    while len(grown):
        order = np.argsort(symbol, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        dealt = place[grown]                        # rank among the transform symbols
        first, last = symbol[grown], len(order) - 1
        before, behind = order[np.maximum(dealt - 1, 0)], order[np.minimum(dealt + 1, last)]
        least = RangeMinimum(common)
        share, follow = np.zeros(len(grown), np.int64), np.zeros(len(grown), np.int64)
        some = np.flatnonzero((dealt > 0) & (symbol[before] == first))
        share[some] = least.of(before[some] + 1, grown[some]) + 1
        next_ = (dealt < last) & (symbol[behind] == first)
        some = np.flatnonzero(next_)
        follow[some] = least.of(grown[some] + 1, behind[some]) + 1
        to = n + dealt
        keep = np.ones(len(at) + len(grown), bool)
        keep[to] = False
        new_at = at[grown] - 1
        new_symbol = flat[new_at - 1]
        at, symbol = _inserted(at, keep, to, new_at), _inserted(symbol, keep, to, new_symbol)
        common = _inserted(common, keep, to, np.minimum(share, cap))
        common[to[next_] + 1] = np.minimum(follow[next_], cap)
        grown = np.sort(to[new_symbol != END])
    string = np.searchsorted(offsets[1:] + np.arange(n) + 1, at, side="left")
    return at - string - 1, common


def equal_windows(data: np.ndarray, offsets: np.ndarray, length: int, doc: np.ndarray,
                  start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(string, place in it) of the windows of ``length`` bytes that an earlier
    window equals; earlier by (``doc`` of the string, ``start`` + place)."""
    at, common = suffixes(data, offsets, length)
    string = np.searchsorted(offsets, at, side="right") - 1
    full = offsets[np.minimum(string + 1, len(offsets) - 1)] - at >= length
    group = np.cumsum(common < length)
    # Suffixes shorter than a window share less than a window with any other.
    at, string, group = at[full], string[full], group[full]
    inner = at - offsets[string]
    order = np.lexsort((start[string] + inner, doc[string], group))
    group, string, inner = group[order], string[order], inner[order]
    place = start[string] + inner
    # A window that two strings hold is one window: its repeat there is no copy.
    later = np.zeros(len(group), bool)
    first = np.ones(len(group), bool)
    first[1:] = group[1:] != group[:-1]
    lead = np.maximum.accumulate(np.where(first, np.arange(len(group)), 0))
    later = (doc[string] != doc[string[lead]]) | (place != place[lead])
    return string[later], inner[later]
