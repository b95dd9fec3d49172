"""Ranked lexical search by NRA: lists sorted by impact, read sequentially, with a score interval for every document.

Documents are indexed in blocks of bounded size. A block holds, for each term that is asked for, the documents that have
it in order of falling impact. For an item, all its lists are read step by step; a document's lower bound is what has
been read of it, its upper bound adds, for each list it has not been seen in, the impact up to which that list has been
read. Reading goes on until nothing unseen and nothing with an open interval can reach the ten best, equal scores
included, so members, ties and scores are final. A task keeps the best of its blocks for each item, and what it has so
far bounds the reading of the next block; the best of all tasks are ranked in Spark.

Items come in groups of a bounded number of terms, which tasks hold; documents are read once for the statistics and once
for the search of each group. Terms are told apart by their bytes, eight at a time, and not by hashes.

Defined cases: a null or empty text has no terms and counts neither for N nor as a result; rows of equal doc_id are
documents of their own; rows of one item_id are one item with the terms of all of them; a null doc_id or item_id is a
value like others, and ranks first among equal scores; an item without terms, or whose terms no document has, gives no
rows; so do empty tables; extra columns are left.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from reelmart.llm.scratch import written
from reelmart.llm.text import slices, utf8

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_INSIDE = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
_CASE = np.array([_LOWER.get(b, b) for b in range(256)], np.uint8)

#: Terms of the items of one group: what a task holds beside a block.
GROUP_TERMS = 1 << 18
#: Bytes of text in a block, and list entries read at a time, at first.
BLOCK_BYTES, FIRST_STEP = 32 << 20, 64


def terms(text: str | None) -> list[str]:
    return _TERM.findall((text or "").translate(_LOWER))


class Lookup:
    """Numbers of given terms, found for spans of bytes: a trie whose steps are words of eight bytes.

    A step takes (node, eight bytes) to the next node, so a span is found if and only if its bytes are those of a term;
    what lies beyond its end counts as zero bytes, which no term has.
    """

    def __init__(self, vocabulary: list[bytes]):
        self.number_of = {t: i for i, t in enumerate(vocabulary)}
        self.steps: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # sorted words, sorted (node, word), terms
        nodes = {b"": 0}
        for k in range(0, max(map(len, vocabulary), default=0), 8):
            found = {(nodes[t[:k]], int.from_bytes(t[k : k + 8], "little")): t[: k + 8] for t in vocabulary if len(t) > k}
            words = np.unique(np.array([w for _, w in found], np.uint64))
            pairs = sorted((node * len(words) + int(np.searchsorted(words, np.uint64(w))), prefix) for (node, w), prefix in found.items())
            ends = [self.number_of.get(prefix, -1) for _, prefix in pairs]
            self.steps.append((words, np.array([p for p, _ in pairs], np.int64), np.array(ends, np.int64)))
            nodes = {prefix: i for i, (_, prefix) in enumerate(pairs)}

    def __call__(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The number of each span's term, or -1. The data goes on for 8 bytes at least behind the last span."""
        out = np.full(len(starts), -1, np.int64)
        wide = np.ndarray(max(len(data) - 7, 0), "<u8", np.ascontiguousarray(data), strides=(1,))
        live, node = np.arange(len(starts)), np.zeros(len(starts), np.int64)
        for k, (words, pairs, ends) in enumerate(self.steps):
            left = lengths[live] - 8 * k
            mask = np.uint64(0xFFFFFFFFFFFFFFFF) >> ((8 - np.minimum(left, 8)) * 8).astype(np.uint64)
            word = wide[starts[live] + 8 * k] & mask
            place = np.minimum(np.searchsorted(words, word), len(words) - 1)
            pair = node * len(words) + place
            at = np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1)
            ok = (words[place] == word) & (pairs[at] == pair)
            done = ok & (left <= 8)
            out[live[done]] = ends[at[done]]
            live, node = live[ok & (left > 8)], at[ok & (left > 8)]
        return out


def _spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.concatenate([[False], _INSIDE[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def occurrences(texts: pa.Array, lookup: Lookup) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, times) for the terms asked for, by row and term, and the number of all terms of each row."""
    data, offsets = utf8(texts)
    n, size = np.zeros(len(texts), np.int64), max(len(lookup.number_of), 1)
    keys, times = [], []
    for lo, hi in slices(offsets, 1 << 20):
        # a byte that ends terms between texts, so that none runs into the next
        length = np.diff(offsets[lo : hi + 1])
        part = np.zeros(int(length.sum()) + len(length) + 8, np.uint8)
        begin = np.append(0, np.cumsum(length + 1)[:-1])
        row = np.repeat(np.arange(len(length)), length)
        part[np.arange(len(row)) + row] = _CASE[data[offsets[lo] : offsets[hi]]]
        starts, ends = _spans(part)
        rows = np.searchsorted(begin, starts, "right") - 1
        n[lo:hi] = np.bincount(rows, minlength=hi - lo)
        term = lookup(part, starts, ends - starts) if lookup.steps else np.full(len(starts), -1)
        hit = term >= 0
        key, count = np.unique((rows[hit] + lo) * size + term[hit], return_counts=True)
        keys.append(key)
        times.append(count)
    key = np.concatenate(keys) if keys else np.zeros(0, np.int64)
    return key // size, key % size, np.concatenate(times) if times else key, n


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def impacts(w: np.ndarray, tf: np.ndarray, n: np.ndarray, total_documents: int, total_terms: int) -> np.ndarray:
    """What occurrences add to a score; whole numbers, also where 64 bits don't hold the product in a length's share."""
    most = int(n.max(initial=0))
    wide = n if 90 * most * total_documents < 1 << 63 else n.astype(object)
    m = 10 + ((90 * wide * total_documents) // max(total_terms, 1)).astype(np.int64)
    return w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def nra(lists: list[tuple[np.ndarray, np.ndarray]], documents: int, k: int, floor: int = 0, step: int = FIRST_STEP) -> tuple[np.ndarray, np.ndarray, int]:
    """The k best of a block: (documents, scores) by falling score and document, and how many entries were read.

    lists: for each term (documents, impacts), impacts falling. floor: a score below which nothing is wanted. Documents
    are numbers below ``documents``; of equal scores the smaller ones are better.
    """
    lists = [x for x in lists if len(x[0])]
    lower, seen, depth, read = np.zeros(documents, np.int64), np.zeros(documents, np.int64), 0, 0
    while True:
        upto = depth + step
        fresh = [(d[depth:upto], s[depth:upto]) for d, s in lists if len(d) > depth]
        for d, s in fresh:
            lower[d] += s  # a document is in a list once
            read += len(d)
        depth, step = upto, depth + step
        frontier = [int(s[depth]) if len(s) > depth else 0 for _, s in lists]
        unseen = sum(frontier)
        kth = max(floor, int(np.partition(lower, documents - k)[documents - k]) if documents > k else 0, 1)
        if unseen >= kth:
            continue
        near = np.flatnonzero(lower + unseen >= kth)
        for (d, _), f in zip(lists, frontier, strict=True):
            if f:
                seen[d[:depth]] += f
        upper = lower[near] + unseen - seen[near]
        seen[:] = 0
        wanted = upper >= kth
        if not (wanted & (upper > lower[near])).any():
            near = near[wanted]
            near = near[np.lexsort((near, -lower[near]))][:k]
            return near, lower[near], read


class Block:
    """The inverted lists of a block of documents: for each term its documents in order of falling impact."""

    def __init__(self, rows: np.ndarray, term: np.ndarray, impact: np.ndarray, n_terms: int):
        order = np.lexsort((-impact, term))
        order = order[impact[order] > 0]
        self.rows, self.impact = rows[order], impact[order]
        self.ends = np.searchsorted(term[order], np.arange(n_terms + 1))

    def list_of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.ends[term : term + 2]
        return self.rows[a:b], self.impact[a:b]


def _blocks(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(ids, texts) of at most about so many bytes of text, in order of id."""
    for batch in batches:
        _, offsets = utf8(batch.column(1))
        for lo, hi in slices(offsets, block_bytes):
            ids, texts = (batch.column(i).slice(lo, hi - lo) for i in (0, 1))
            order = pc.sort_indices(ids, null_placement="at_start")
            yield ids.take(order), texts.take(order)


def _order(value) -> tuple:
    return (value is not None, value)


def _groups(items: DataFrame, item: str, text: str, most: int) -> Iterator[dict]:
    """The distinct terms of each item, some items at a time; the driver holds one group."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms(t))) for t in batch.column(1).to_pylist()]
            yield pa.record_batch({item: batch.column(0), "terms": pa.array(found, pa.list_(pa.string()))})

    kind = items.schema[item].dataType.simpleString()
    split = items.select(item, text).mapInArrow(parts, f"{item} {kind}, terms array<string>")
    group: dict = {}
    size = 0
    for row in split.groupBy(item).agg(F.array_distinct(F.flatten(F.collect_list("terms"))).alias("terms")).toLocalIterator():
        if group and size + len(row.terms) > most:
            yield group
            group, size = {}, 0
        group[row[item]] = [t.encode() for t in row.terms]
        size += len(row.terms)
    if size:
        yield group


def search(docs: DataFrame, items: DataFrame, k: int = 10, group_terms: int = GROUP_TERMS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k best documents of each item, of those with a score above 0."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    item_kind, doc_kind = items.schema["item_id"].dataType.simpleString(), docs.schema["doc_id"].dataType.simpleString()
    schema = f"item_id {item_kind}, doc_id {doc_kind}, score long"
    best = None
    for group in _groups(items, "item_id", "text", group_terms):
        found = _search_group(docs, group, k, schema, block_bytes)
        best = found if best is None else best.union(found)
    best = spark.createDataFrame([], schema) if best is None else best
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _search_group(docs: DataFrame, group: dict, k: int, schema: str, block_bytes: int) -> DataFrame:
    vocabulary = sorted({t for found in group.values() for t in found})
    lookup = Lookup(vocabulary)
    asked = {item: [lookup.number_of[t] for t in found] for item, found in group.items()}
    shared = docs.sparkSession.sparkContext.broadcast((lookup, asked))
    size = len(vocabulary)

    def statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """By term the documents that have it; at -1 and -2 the documents with terms and all their terms."""
        df, documents, total = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            _, term, _, n = occurrences(batch.column(0), shared.value[0])
            df += np.bincount(term, minlength=size)
            documents, total = documents + int((n > 0).sum()), total + int(n.sum())
        have = np.flatnonzero(df)
        yield pa.record_batch({"term": pa.array([-2, -1, *have.tolist()], pa.int64()), "n": pa.array([total, documents, *df[have].tolist()], pa.int64())})

    counted = docs.select("text").mapInArrow(statistics, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    counts = {r.term: r.n for r in counted.collect()}  # two numbers and one for each term of the group
    total_terms, total_documents = counts.get(-2, 0), counts.get(-1, 0)
    weights = np.array([weight(total_documents, counts.get(i, 0)) for i in range(size)], np.int64)
    item_type, doc_type = (to_arrow_type(T.StructType.fromDDL(schema)[name].dataType) for name in ("item_id", "doc_id"))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, asked = shared.value
        top: dict = {}
        for ids, texts in _blocks(batches, block_bytes):
            rows, term, times, n = occurrences(texts, lookup)
            block = Block(rows, term, impacts(weights[term], times, n[rows], total_documents, total_terms), size)
            for item, wanted in asked.items():
                have = top.get(item, [])
                floor = have[-1][0] if len(have) == k else 0
                documents, scores, _ = nra([block.list_of(t) for t in wanted], len(ids), k, floor)
                if len(documents):
                    more = zip(scores.tolist(), ids.take(pa.array(documents)).to_pylist(), strict=True)
                    top[item] = sorted([*have, *more], key=lambda r: (-r[0], _order(r[1])))[:k]
        flat = [(item, doc, score) for item, found in top.items() for score, doc in found]
        item, doc, score = (list(x) for x in zip(*flat, strict=True)) if flat else ([], [], [])
        yield pa.record_batch({"item_id": pa.array(item, item_type), "doc_id": pa.array(doc, doc_type), "score": pa.array(score, pa.int64())})

    found = written(docs.mapInArrow(best, schema), "best")
    shared.destroy()
    return found
