"""Words, shingles and their 64-bit hashes for a batch of texts, as numpy arrays.

A word is a run of characters other than space and 0x09 to 0x0D. Hashing works on UTF-8 bytes of many texts
at once, so its cost follows the bytes and not the number of texts.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text that are hashed at once; a longer single text is taken whole.
SLICE_BYTES = 1 << 21
SHINGLE = 5

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64's last steps)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd_numbers(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _BASE + np.uint64(seed)) | np.uint64(1)


_BYTE = odd_numbers(256, 1)
_PLACE = odd_numbers(SHINGLE, 2)


class Words(NamedTuple):
    """Words of some texts in order: hash, first byte in its own text, bytes; text i has bounds[i]:bounds[i+1]."""

    hash: np.ndarray
    start: np.ndarray
    size: np.ndarray
    bounds: np.ndarray


def encoded(texts) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts]


def slices(sizes: list[int], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours that have ``limit`` bytes together at most, or one text."""
    first = total = 0
    for i, size in enumerate(sizes):
        if i > first and total + size > limit:
            yield first, i
            first, total = i, 0
        total += size
    if first < len(sizes):
        yield first, len(sizes)


def give_back() -> None:
    """Memory that was freed goes back to the system: a worker keeps it else, also while it waits for its next task."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of glibc
        trim(0)


def sparing(batches: Iterator) -> Iterator:
    """The batches; what the work on one has freed is given back before the next, and at the end."""
    for batch in batches:
        yield batch
        del batch
        give_back()


def words_of(texts: list[bytes], lower: bool = True) -> Words:
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    inside = ~_SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    bounds = np.searchsorted(start, begins)
    if not len(start):
        none = np.zeros(0, np.int64)
        return Words(none.astype(np.uint64), none, none, bounds)
    size = end - start
    shift = np.arange(start[0], len(data)) - np.repeat(start, np.diff(np.append(start, len(data))))
    powers = np.multiply.accumulate(np.full(int(shift.max()) + 1, _BASE))
    value = _BYTE[_LOWER[data[start[0]:]] if lower else data[start[0]:]] * powers[shift]
    value[~inside[start[0]:]] = 0
    total = np.add.reduceat(value, start - start[0])
    own = start - np.repeat(begins[:-1], np.diff(bounds))
    return Words(mix(total + size.astype(np.uint64) * _BASE), own, size, bounds)


def words_of_many(texts: list[bytes]) -> Words:
    """As words_of, slice by slice: what it holds beside the result does not grow with the texts."""
    parts = [words_of(texts[a:b]) for a, b in slices([len(t) for t in texts])] or [words_of([])]
    shifts = np.cumsum([0, *[len(p.hash) for p in parts]])
    bounds = [np.zeros(1, np.int64), *[p.bounds[1:] + n for p, n in zip(parts, shifts)]]
    return Words(*[np.concatenate([p[i] for p in parts]) for i in range(3)], np.concatenate(bounds))


def windows(words: Words, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``k`` words from each place, and which places have as many in their own text."""
    h, n = words.hash, len(words.hash)
    place = _PLACE if k == SHINGLE else odd_numbers(k, 2)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out[: max(n - j, 0)] += h[j:] * place[j]
    last = np.repeat(words.bounds[1:], np.diff(words.bounds))
    return mix(out), np.arange(n) + k <= last


def shingle_sets(words: Words) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes; a text of fewer words has one, of the whole sequence."""
    all_, full = windows(words)
    out = []
    for a, b in zip(words.bounds[:-1], words.bounds[1:]):
        n = b - a
        if n >= SHINGLE:
            out.append(np.unique(all_[a : b - SHINGLE + 1]))
        elif n:
            whole = (words.hash[a:b] * _PLACE[:n]).sum(dtype=np.uint64, keepdims=True)
            out.append(mix(whole + np.full(1, n, np.uint64) * _BASE))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
