"""Removal of repeated passages: every word covered by a window of words that also starts earlier.

Anchors are windows of ``window - period + 1`` words at the positions of a difference cover modulo the period. For any
two equal windows there is an offset at which both hold an anchor, so a window whose anchors are all unique is unique.
Only the windows around shared anchors are then hashed whole (96 bits, over XXH64 of the words) and compared, which
extends anchors to exact matches of any length.

Documents are dealt to chunks by ranges of doc_id and written once, bucketed by chunk, in the shared folder; later passes
read a chunk beside the answers for it without moving texts. A chunk sends every hash once, however often it occurs
there, so a passage that a third of the documents share is one entry per chunk; answers are bits in the order sent.

Defined cases: a null text has no words and is kept as empty; fewer words than a window are kept; a null doc_id counts
as the smallest; rows of equal doc_id are separate documents, in the order of their texts; an empty table gives an
empty result; extra columns are left.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmart.llm.scratch import partitions, written, written_by
from reelmart.llm.text import slices, utf8, window_hashes, word_digests, word_spans

#: Perfect difference covers by period: any difference modulo the period is that of two of the positions.
COVERS = {3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9)}

_ENTRY = np.dtype([("a", "<u8"), ("b", "<u4")])


class Chunk:
    """The words of a chunk's documents, in order of doc_id; positions count over the whole chunk."""

    def __init__(self, table: pa.Table, window: int, period: int):
        self.window, self.period = window, period
        self.table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")]) if len(table) else table
        nulls = self.table.column("doc_id").null_count  # Arrow sorts them last
        if nulls:
            order = np.roll(np.arange(len(self.table)), nulls)
            self.table = self.table.take(pa.array(order))
        data, offsets = utf8(self.table.column("text").combine_chunks())
        hashes, counts = [], []
        for lo, hi in slices(offsets):
            starts, ends, firsts = word_spans(data, offsets[lo : hi + 1])
            hashes.append(word_digests(data, starts, ends))
            counts.append(np.diff(firsts))
        self.words = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        self.place = np.arange(len(self.words)) - np.repeat(self.first[:-1], self.counts)  # within the document
        self.left = np.repeat(self.counts, self.counts) - self.place  # words from here to the document's end

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions and hashes of the windows at cover positions."""
        gram = self.window - self.period + 1
        covered = np.zeros(self.period, bool)
        covered[list(COVERS[self.period])] = True
        long = np.repeat(self.counts >= self.window, self.counts)
        at = np.flatnonzero(covered[self.place % self.period] & (self.left >= gram) & long)
        return at, window_hashes(self.words, at, gram)

    def candidates(self, shared: np.ndarray) -> np.ndarray:
        """Starts of the windows that hold a shared anchor; shared: bits for the sorted distinct anchor hashes."""
        at, hashes = self.anchors()
        _, which, times = np.unique(hashes, return_inverse=True, return_counts=True)
        hit = at[(shared | (times > 1))[which]]
        back = np.minimum(self.period - 1, self.place[hit])
        step = np.zeros(len(self.words) + 1, np.int32)
        np.add.at(step, hit - back, 1)
        np.add.at(step, hit + 1, -1)
        return np.flatnonzero((np.cumsum(step[:-1]) > 0) & (self.left >= self.window))

    def windows(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct entries of the windows at the given starts, sorted; for each window its entry's index."""
        entries = np.zeros(len(at), _ENTRY)
        entries["a"] = window_hashes(self.words, at, self.window)
        entries["b"] = window_hashes(self.words, at, self.window, 1) >> np.uint64(32)
        order = np.lexsort((entries["b"], entries["a"]))
        ranked = entries[order]
        new = np.ones(len(at), bool)
        new[1:] = ranked[1:] != ranked[:-1]
        which = np.zeros(len(at), np.int64)
        which[order] = np.cumsum(new) - 1
        return ranked[new], which

    def removed(self, at: np.ndarray, which: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        """For each word, whether a window covers it whose words also start earlier, here or in an earlier chunk."""
        first = np.full(len(earlier), len(self.words))
        np.minimum.at(first, which, at)
        later = at[earlier[which] | (first[which] < at)]
        step = np.zeros(len(self.words) + 1, np.int32)
        np.add.at(step, later, 1)
        np.add.at(step, later + self.window, -1)
        return np.cumsum(step[:-1]) > 0


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """A bucket by the leading bits, so sorted hashes have sorted buckets."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _sent(chunk: int, sorted_: np.ndarray, keys: np.ndarray, buckets: int) -> pa.Table:
    """(bucket, chunk, entries): the sorted entries of a chunk, cut by bucket."""
    bucket = _bucket(keys, buckets)
    used, first = np.unique(bucket, return_index=True)
    ends = np.append(first[1:], len(bucket)) if len(used) else first
    blobs = [sorted_[a:b].tobytes() for a, b in zip(first, ends, strict=True)]
    return pa.table({"bucket": pa.array(used.astype(np.int64)), "chunk": pa.array(np.full(len(used), chunk, np.int64)), "entries": pa.array(blobs, pa.binary())})


def _answers(kind: int, table: pa.Table, entry: np.dtype) -> pa.Table:
    """(chunk, kind, bucket, bits): for each entry of each chunk, whether another (0) or an earlier (1) chunk has it."""
    table = table.sort_by("chunk")
    blobs = [np.frombuffer(x.as_buffer(), entry) for x in table.column("entries")]
    whose = np.repeat(np.arange(len(blobs)), [len(b) for b in blobs])
    entries = np.concatenate(blobs)
    order = np.lexsort((whose, entries)) if kind == 0 else np.lexsort((whose, entries["b"], entries["a"]))
    ranked = entries[order]
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = ranked[1:] == ranked[:-1]
    found = np.zeros(len(order), bool)
    found[order] = same[:-1] | same[1:] if kind == 0 else same[:-1]  # chunks ascend among equal entries
    n, ends = len(blobs), np.cumsum([len(b) for b in blobs])
    bits = [np.packbits(found[end - len(blob) : end]).tobytes() for blob, end in zip(blobs, ends, strict=True)]
    return pa.table({"chunk": table.column("chunk"), "kind": pa.array([kind] * n, pa.int32()), "bucket": table.column("bucket"), "bits": pa.array(bits, pa.binary())})


def _read(answers: pa.Table, kind: int, keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bits of a kind, in the order of the sorted distinct hashes that the chunk sent."""
    bits = {}
    for k, bucket, blob in zip(*(answers.column(c).to_pylist() for c in ("kind", "bucket", "bits")), strict=True):
        if k == kind:
            bits[bucket] = blob
    used, counts = np.unique(_bucket(keys, buckets), return_counts=True)
    parts = [np.unpackbits(np.frombuffer(bits[int(b)], np.uint8), count=int(n)) for b, n in zip(used, counts, strict=True)]
    return np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)


def without_repeats(docs: DataFrame, window: int = 20, period: int = 13, chunk_bytes: int = 8 << 20) -> DataFrame:
    """doc_id, n_words, n_removed, kept: the words that stay, joined by one space.

    chunk_bytes: about how much text a task holds; raise it with the data, as chunks answer each other.
    """
    if window < period:
        raise ValueError("an anchor needs a word at least: window >= period")
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", "text")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(partitions(spark), -(-total // chunk_bytes))
    dealt = docs.repartitionByRange(chunks, "doc_id").withColumn("chunk", F.spark_partition_id().cast("long"))
    texts = written_by(dealt, "chunks", "chunk", chunks)
    by_chunk = texts.groupBy("chunk")
    sent = "bucket long, chunk long, entries binary"

    def anchors(key: tuple, table: pa.Table) -> pa.Table:
        hashes = np.unique(Chunk(table, window, period).anchors()[1])
        return _sent(key[0].as_py(), hashes, hashes, chunks)

    def shared(table: pa.Table) -> pa.Table:
        return _answers(0, table, np.dtype("<u8"))

    answer = "chunk long, kind int, bucket long, bits binary"
    known = by_chunk.applyInArrow(anchors, sent).groupBy("bucket").applyInArrow(shared, answer)

    def around(table: pa.Table, answers: pa.Table) -> tuple[Chunk, np.ndarray]:
        chunk = Chunk(table, window, period)
        keys = np.unique(chunk.anchors()[1])
        return chunk, chunk.candidates(_read(answers, 0, keys, chunks))

    def windows(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        chunk, at = around(table, answers)
        entries, _ = chunk.windows(at)
        return _sent(key[0].as_py(), entries, entries["a"], chunks)

    def earlier(table: pa.Table) -> pa.Table:
        return _answers(1, table, _ENTRY)

    def kept(table: pa.Table, answers: pa.Table) -> pa.Table:
        chunk, at = around(table, answers)
        entries, which = chunk.windows(at)
        removed = chunk.removed(at, which, _read(answers, 1, entries["a"], chunks))
        gone = np.add.reduceat(np.append(removed, False), chunk.first[:-1], dtype=np.int64) * (chunk.counts > 0) if len(chunk.counts) else chunk.counts
        rest = []
        for row, text in enumerate(chunk.table.column("text")):
            words = (text.as_buffer().to_pybytes() if text.is_valid else b"").split()
            if gone[row]:
                words = compress(words, ~removed[chunk.first[row] : chunk.first[row + 1]])
            rest.append(b" ".join(words))
        return pa.table(
            {"doc_id": chunk.table.column("doc_id"), "n_words": pa.array(chunk.counts.astype(np.int64)), "n_removed": pa.array(gone.astype(np.int64)), "kept": pa.array(rest, pa.binary()).cast(pa.string())}
        )

    known = written(known, "answers")  # both later passes read it
    found = by_chunk.cogroup(known.groupBy("chunk")).applyInArrow(windows, sent).groupBy("bucket").applyInArrow(earlier, answer)
    return by_chunk.cogroup(known.union(found).groupBy("chunk")).applyInArrow(kept, f"doc_id {kind}, n_words long, n_removed long, kept string")
