"""Benchmark decontamination by greedy string tiling.

Tokens are lower-case runs of letters, digits and underscores. Every document is searched for seeds, runs of
``match`` tokens that an item also has; items that share seeds are tiled: the longest run that document and item share
is marked first, then the longest of what is left, down to ``match`` tokens, found by Karp-Rabin hashes of windows that
shrink with the longest match. The tiles don't overlap and may stand in any order, so reordered passages count. A
document contains an item if tiles cover ``coverage`` of the item's tokens.

Documents don't move: the seeds of a block of items go to every task. A block holds ``block_tokens`` tokens of items at
most (one longer item is a block of its own), so a task's memory is bounded; a larger benchmark takes as many passes
over the documents as it has blocks.

Defined cases: a null or empty text has no tokens and contains nothing; an item of fewer than ``match`` tokens has no
seed and is never found; equal items are each reported; repeated documents are each reported; empty tables give an empty
result; extra columns are left.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from reelmart.llm.text import mix, window_hashes

TOKEN = re.compile(r"\w+")


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall((text or "").lower())


class Items:
    """A block of items as numbers of their tokens, with the sorted hashes of their seeds."""

    def __init__(self, items: list[tuple[int, str]], match: int):
        self.match, self.ids = match, [i for i, _ in items]
        split = [tokens(text) for _, text in items]
        self.number = {t: n for n, t in enumerate(dict.fromkeys(t for words in split for t in words), 1)}
        self.words = [np.array([self.number[t] for t in words], np.int64) for words in split]
        seeds = [self._windows(words, match) for words in self.words]
        item = np.repeat(np.arange(len(items)), [len(s) for s in seeds])
        place = np.concatenate([np.arange(len(s)) for s in seeds]) if seeds else np.zeros(0, np.int64)
        seeds = np.concatenate(seeds) if seeds else np.zeros(0, np.uint64)
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.of, self.place = seeds[order], item[order], place[order]

    @staticmethod
    def _windows(words: np.ndarray, size: int) -> np.ndarray:
        n = len(words) - size + 1
        return window_hashes(mix(words.astype(np.uint64)), np.arange(n), size) if n > 0 else np.zeros(0, np.uint64)

    def seeded(self, document: np.ndarray, coverage: float) -> list[int]:
        """The items that share seeds with the document, enough to reach the coverage (tiles consist of seeds)."""
        if np.count_nonzero(document) < self.match or not len(self.seeds):
            return []
        windows = self._windows(document, self.match)
        at = np.minimum(np.searchsorted(self.seeds, windows), len(self.seeds) - 1)
        windows = np.unique(windows[self.seeds[at] == windows])
        places: dict[int, set[int]] = {}
        for lo, hi in zip(np.searchsorted(self.seeds, windows, "left"), np.searchsorted(self.seeds, windows, "right"), strict=True):
            for k in range(lo, hi):
                places.setdefault(int(self.of[k]), set()).update(range(self.place[k], self.place[k] + self.match))
        return sorted(i for i, covered in places.items() if len(covered) >= coverage * len(self.words[i]))

    def covered(self, item: int, document: np.ndarray) -> int:
        return tiled(self.words[item], document, self.match)


def tiled(item: np.ndarray, document: np.ndarray, match: int) -> int:
    """Tokens of the item under tiles: its runs in the document, longest first, unmarked in both, of ``match`` at least."""
    own, other = np.zeros(len(item), bool), np.zeros(len(document), bool)
    # token numbers of the item only; everything else can't be part of a match
    other |= ~np.isin(document, item)
    size = len(item)
    while size >= match:
        found = _matches(item, document, own, other, size)
        if not found:
            size = size - 1 if size <= 2 * match else max(2 * match, size // 2)
            # a smaller window may sit inside runs up to the last size tried, so grow what it finds
            continue
        longest = max(n for _, _, n in found)
        if longest > size:  # mark the longest first
            size = longest
            found = [m for m in found if m[2] == longest]
        for i, j, n in sorted(found, key=lambda m: (-m[2], m[0], m[1])):
            if not own[i : i + n].any() and not other[j : j + n].any():
                own[i : i + n] = other[j : j + n] = True
    return int(own.sum())


def _free(marked: np.ndarray, size: int) -> np.ndarray:
    """Starts of the windows without a marked token."""
    sums = np.concatenate([[0], np.cumsum(marked)])
    return np.flatnonzero(sums[size:] == sums[:-size]) if len(marked) >= size else np.zeros(0, np.int64)


def _matches(item: np.ndarray, document: np.ndarray, own: np.ndarray, other: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """(start in item, start in document, length) of maximal unmarked matches that hold an equal window of ``size``."""
    a, b = _free(own, size), _free(other, size)
    if not len(a) or not len(b):
        return []
    left, right = window_hashes(mix(item.astype(np.uint64)), a, size), window_hashes(mix(document.astype(np.uint64)), b, size)
    starts: dict[int, list[int]] = {}
    for i, h in zip(a.tolist(), left.tolist(), strict=True):
        starts.setdefault(h, []).append(i)
    out, known = [], set()
    for at in np.flatnonzero(np.isin(right, left)).tolist():
        j = int(b[at])
        for i in starts[int(right[at])]:
            if (i - 1, j - 1) in known:  # the same run, one further
                known.add((i, j))
                continue
            n = 0
            while i + n < len(item) and j + n < len(document) and item[i + n] == document[j + n] and not own[i + n] and not other[j + n]:
                n += 1
            if n >= size:
                known.add((i, j))
                out.append((i, j, n))
    return out


def _blocks(benchmark: DataFrame, block_tokens: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size, read one at a time."""
    block, size = [], 0
    for row in benchmark.select("item_id", "text").where("text is not null").orderBy("item_id", "text").toLocalIterator():
        n = len(tokens(row.text))
        if block and size + n > block_tokens:
            yield block
            block, size = [], 0
        block.append((row.item_id, row.text))
        size += n
    if block:
        yield block


def _found(items: Items, text: str | None, coverage: float) -> list[tuple[int, float]]:
    """(item's index, covered share) of the items that a text contains."""
    number = items.number.get
    document = np.array([number(t, 0) for t in tokens(text)], np.int64)
    shares = ((i, items.covered(i, document) / len(items.words[i])) for i in items.seeded(document, coverage))
    return [(i, share) for i, share in shares if share >= coverage]


def contained(docs: DataFrame, benchmark: DataFrame, match: int = 5, coverage: float = 0.6, block_tokens: int = 500_000) -> DataFrame:
    """doc_id, item_id, covered (share of the item's tokens): the items that documents contain."""
    spark = docs.sparkSession
    kinds = docs.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType
    schema = f"doc_id {kinds[0].simpleString()}, item_id {kinds[1].simpleString()}, covered double"
    ids = to_arrow_type(kinds[1])

    def search(block: list[tuple[int, str]]) -> DataFrame:
        sent = spark.sparkContext.broadcast(Items(block, match))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = sent.value
            for batch in batches:
                found = [(row, i, share) for row, text in enumerate(batch.column("text")) for i, share in _found(items, text.as_py(), coverage)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array([f[0] for f in found], pa.int64())), pa.array([items.ids[f[1]] for f in found], ids), pa.array([f[2] for f in found], pa.float64())],
                    names=["doc_id", "item_id", "covered"],
                )

        return docs.select("doc_id", "text").mapInArrow(run, schema)

    parts = [search(block) for block in _blocks(benchmark, block_tokens)]
    return reduce(DataFrame.union, parts) if parts else spark.createDataFrame([], schema)


def clean(docs: DataFrame, benchmark: DataFrame, match: int = 5, coverage: float = 0.6, block_tokens: int = 500_000) -> DataFrame:
    """The documents that contain no item, with their columns; nothing moves between tasks."""
    for block in _blocks(benchmark, block_tokens):
        sent = docs.sparkSession.sparkContext.broadcast(Items(block, match))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array([not _found(sent.value, text.as_py(), coverage) for text in batch.column("text")], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
