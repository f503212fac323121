"""Sorted suffixes of a collection of strings, built column by column.

All strings are read from their ends at once. Round j inserts the suffix of length j of every string that has one into
the sorted list of all shorter suffixes. The list is kept as three sequential columns: the symbol before each suffix
(the Burrows-Wheeler transform of the collection), the symbols it has in common with the suffix above it, and
which suffix it is. A suffix's place follows from the rank of its first symbol in the transform, its common prefix from
the least common prefix between it and the suffix above it one round before. A round reads the columns once and
writes them once, with what is new merged in.
"""

from __future__ import annotations

import numpy as np

#: Stands before a suffix that is a whole string; no byte of UTF-8 text has this value.
END = 255
_LENGTH_BITS = 8


def _least_between(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Least of ``values[first..last]`` for pairs of places. Ranges go from the last to the first, so that what lies
    between two of them is not read."""
    order = np.argsort(-first, kind="stable")
    bounds = np.stack([first[order], last[order] + 1], axis=1).reshape(-1)
    out = np.empty(len(first), values.dtype)
    padded = np.append(values, values.dtype.type(0))
    out[order] = np.minimum.reduceat(padded, bounds)[::2]
    return out


def sorted_suffixes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, least: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All non-empty suffixes of ``data[start : start + size]`` in order: string, length, bytes in common with the one above.

    Strings have 1 to 255 bytes; ends of strings are below all bytes and differ from each other. Of suffixes shorter than
    ``least`` it is not kept which they are: they have length 0.
    """
    m = len(sizes)
    if not m:
        return (np.zeros(0, np.int64),) * 3
    if sizes.max() >> _LENGTH_BITS or sizes.min() < 1:
        raise ValueError("strings must have 1 to 255 bytes")
    string = np.arange(m)
    # round 0: the empty suffixes
    before = data[starts + sizes - 1]
    common = np.zeros(m, np.uint8)
    kind = np.uint32 if m < 1 << (32 - _LENGTH_BITS) else np.uint64
    which = None  # from the round of the least length on
    at, own = string, string  # place of every growing string's last suffix, and the strings
    for length in range(1, int(sizes.max()) + 1):
        growing = sizes[own] >= length
        at, own = at[growing], own[growing]
        # where the suffix of each place goes when its symbol is put before it
        order = np.argsort(before, kind="stable")
        order = order[: len(order) - int(np.count_nonzero(before == END))]
        rank = np.empty(len(before), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        ranks = rank[at].astype(np.int64)
        place = m + ranks
        symbol = before[at]
        above = order[np.maximum(ranks - 1, 0)]
        has_above = (ranks > 0) & (before[above] == symbol)
        shared = np.zeros(len(at), np.uint8)
        shared[has_above] = _least_between(common, above[has_above] + 1, at[has_above]) + 1
        below = order[np.minimum(ranks + 1, len(order) - 1)]
        has_below = (ranks + 1 < len(order)) & (before[below] == symbol)
        shared_below = _least_between(common, at[has_below] + 1, below[has_below]) + 1
        # merge
        new = np.argsort(place)
        next_symbol = np.where(sizes[own] > length, data[np.maximum(starts[own] + sizes[own] - 1 - length, 0)], END).astype(np.uint8)
        fresh = np.zeros(len(before) + len(at), bool)
        fresh[place] = True
        old = ~fresh
        columns = [(before, next_symbol), (common, shared)]
        if length >= least:
            columns.append((np.zeros(len(before), kind) if which is None else which, (own.astype(kind) << kind(_LENGTH_BITS)) | kind(length)))
        merged = []
        for column, added in columns:
            out = np.empty(len(fresh), column.dtype)
            out[fresh] = added[new]
            out[old] = column
            merged.append(out)
        before, common, *rest = merged
        which = rest[0] if rest else None
        common[place[has_below] + 1] = shared_below
        at = place
    if which is None:
        which = np.zeros(len(before), kind)
    # the first places are the empty suffixes
    return (which[m:] >> kind(_LENGTH_BITS)).astype(np.int64), (which[m:] & kind(255)).astype(np.int64), common[m:].astype(np.int64)
