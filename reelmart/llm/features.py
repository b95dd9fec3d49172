"""Hashed features of whole texts, as dense blocks of rows: byte trigrams, their shapes, and repetition."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from reelmart.llm.text import slices, word_hashes, word_spans

_LETTERS = np.full(256, 0x20, np.uint8)
_LETTERS[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTERS[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTERS[0x80:] = np.arange(0x80, 0x100)

_SHAPES = np.arange(256, dtype=np.uint8)
_SHAPES[ord("a") : ord("z") + 1] = _SHAPES[0x80:] = ord("a")
_SHAPES[ord("A") : ord("Z") + 1] = ord("A")
_SHAPES[ord("0") : ord("9") + 1] = ord("0")

#: Bytes that are counted at once; a longer text is counted in pieces.
_PIECE = 4 << 20


def trigram_counts(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, dims: int) -> np.ndarray:
    """Counts of hashed trigrams of mapped bytes: a row for each text, ``dims`` (a power of two) columns."""
    rows = len(offsets) - 1
    out = np.zeros(rows * dims, np.float32)
    lo, hi = int(offsets[0]), int(offsets[-1])
    shift = np.uint32(32 - (dims.bit_length() - 1))
    for first in range(lo, hi, _PIECE):
        last = min(hi, first + _PIECE)
        codes = table[data[first : min(hi, last + 2)]].astype(np.uint32)
        if len(codes) < 3:
            continue
        grams = (((codes[:-2] << 16) | (codes[1:-1] << 8) | codes[2:]) * np.uint32(0x9E3779B1)) >> shift
        row = np.repeat(np.arange(rows), np.diff(np.clip(offsets, first, last)))[: len(grams)]
        inside = np.ones(len(grams) + 2, bool)  # not across texts
        for back in (1, 2):
            edges = offsets[1:] - back - first
            inside[edges[(edges >= 0) & (edges < len(grams))]] = False
        inside = inside[: len(grams)]
        out += np.bincount(row[inside] * dims + grams[inside], minlength=rows * dims).astype(np.float32)
    return out.reshape(rows, dims)


def letter_trigrams(data: np.ndarray, offsets: np.ndarray, dims: int) -> np.ndarray:
    """Trigrams of letters; ASCII is lower-cased, and all but letters are space."""
    return trigram_counts(data, offsets, _LETTERS, dims)


def shape_trigrams(data: np.ndarray, offsets: np.ndarray, dims: int) -> np.ndarray:
    """Trigrams of kinds of bytes: capital, other letter, digit, or the sign itself."""
    return trigram_counts(data, offsets, _SHAPES, dims)


def repetition(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Shares, each 0 to 1: words that repeat the one before, words seen before, capitals, other signs; 0 if empty."""
    starts, ends, firsts = word_spans(data, offsets)
    hashes, counts = word_hashes(data, starts, ends), np.diff(firsts)
    row = np.repeat(np.arange(len(counts)), counts)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    keys = np.sort((row.astype(np.uint64) << np.uint64(48)) | (hashes >> np.uint64(16)))
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    distinct = np.bincount((keys[new] >> np.uint64(48)).astype(np.int64), minlength=len(counts))
    lo, hi = int(offsets[0]), int(offsets[-1])
    kinds = _SHAPES[data[lo:hi]]
    capital = np.concatenate([[0], np.cumsum(kinds == ord("A"))])[offsets - lo]
    letter = np.concatenate([[0], np.cumsum((kinds == ord("a")) | (kinds == ord("A")))])[offsets - lo]
    white = np.concatenate([[0], np.cumsum(kinds <= 0x20)])[offsets - lo]
    size, words = np.maximum(np.diff(offsets), 1), np.maximum(counts, 1)
    shares = [np.bincount(row[again], minlength=len(counts)) / words, (counts - distinct) / words, np.diff(capital) / size, (np.diff(offsets) - np.diff(letter) - np.diff(white)) / size]
    return np.stack(shares, axis=1).astype(np.float32)


def binned(shares: np.ndarray, bins: int = 16) -> np.ndarray:
    """Each share as terms: its bin and, by nearness, the next one; (columns x (bins + 1)) wide."""
    rows, columns = shares.shape
    out = np.zeros((rows, columns, bins + 1), np.float32)
    at = np.clip(shares, 0, 1) * bins
    low = np.minimum(at.astype(np.int64), bins - 1)
    r, c = np.indices(low.shape)
    out[r, c, low], out[r, c, low + 1] = 1 - (at - low), at - low
    return out.reshape(rows, -1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length one; rows of zeros stay."""
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-12)


def row_blocks(offsets: np.ndarray, rows: int = 512) -> Iterator[tuple[int, int]]:
    """Rows to count at once, so that a dense block stays small."""
    return slices(offsets, 2 << 20, rows)
