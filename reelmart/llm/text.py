"""Words and hashes of whole Arrow text columns, computed with numpy over their byte buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Space, tab, line feed, vertical tab, form feed, carriage return: what separates words.
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True

_U = np.uint64
_BASE, _BASE_INVERSE = 0x9E3779B97F4A7C15 | 1, pow(0x9E3779B97F4A7C15 | 1, -1, 1 << 64)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and its n + 1 offsets; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), ends


def slices(offsets: np.ndarray, most: int = 2 << 20, rows: int = 1 << 62) -> Iterator[tuple[int, int]]:
    """Runs of at most ``rows`` rows and about ``most`` bytes; a longer text is a run of its own."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = min(max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1), row + rows)
        yield row, end
        row = end


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text the index of its first word (n + 1 numbers)."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    inside = ~SEPARATOR[data[lo:hi]]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edges = offsets[1:-1] - lo
    edges = edges[(edges > 0) & (edges < hi - lo)]  # a text's first word starts there, whatever stands before
    starts[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    at = np.flatnonzero(starts)
    return at + lo, np.flatnonzero(ends) + 1 + lo, np.searchsorted(at, offsets - lo)


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit numbers (a bijection, so equal results mean equal numbers)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & ((1 << 64) - 1), np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Powers:
    """Powers of the base and its inverse modulo 2**64, kept for the longest run so far up to a bound."""

    KEPT = 1 << 22

    def __init__(self):
        self.up, self.down = _powers(_BASE, 1 << 12), _powers(_BASE_INVERSE, 1 << 12)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            up, down = _powers(_BASE, n), _powers(_BASE_INVERSE, n)
            if n > self.KEPT:
                return up, down
            self.up, self.down = up, down
        return self.up[:n], self.down[:n]


POWERS = Powers()


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """Karp-Rabin hashes of the spans [start, end) of a sequence of numbers, by differences of prefix sums."""
    up, down = POWERS(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + _U(seed + 1)) * up[:-1], out=sums[1:])
    length = (ends - starts).astype(np.uint64) if isinstance(ends, np.ndarray) else _U(ends)
    return mix((sums[ends] - sums[starts]) * down[starts] + length * _U(0xD6E8FEB86659FD93))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word."""
    out, first = np.zeros(len(starts), np.uint64), 0
    while first < len(starts):  # hashes don't depend on where a run begins, so memory is that of a run
        lo = int(starts[first])
        last = max(first + 1, int(np.searchsorted(ends, lo + (2 << 20), "right")))
        out[first:last] = span_hashes(data[lo : int(ends[last - 1])], starts[first:last] - lo, ends[first:last] - lo)
        first = last
    return out


def word_digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """XXH64 of every word: slower than ``word_hashes``, but no words of a certain form collide."""
    view, out, step = memoryview(data), np.zeros(len(starts), np.uint64), 1 << 16
    for first in range(0, len(starts), step):
        spans = map(slice, starts[first : first + step].tolist(), ends[first : first + step].tolist())
        out[first : first + step] = np.fromiter(map(xxhash.xxh64_intdigest, map(view.__getitem__, spans)), np.uint64)
    return out


def window_hashes(words: np.ndarray, starts: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hashes of the windows of ``size`` words at the given starts; another seed gives an independent hash."""
    values = mix(words + _U((seed * 0x9E3779B97F4A7C15) & ((1 << 64) - 1))) if seed else words
    return span_hashes(values, starts, starts + size, seed)
