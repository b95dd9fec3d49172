"""Quality by nearest neighbours: labelled latent-semantic vectors vote, weighted by cosine.

A text's terms are hashed byte trigrams, trigrams of the kinds of bytes, and binned shares of repeated words, capitals
and signs, each block weighed by inverse document frequency over all documents and brought to length one. A truncated
singular value decomposition of the labelled sample gives the latent space; the labelled vectors are broadcast (at most
about ``sample`` of each class, ``rank`` numbers each), and every document's cosines with all of them are computed
exactly, block by block. The score is the share of label 1 among the nearest, weighted by similarity; the sample holds
both classes evenly, so the score is not the share of good documents.

Defined cases: null and empty texts have no terms but those of their shares, which are zero, and are scored like others;
null labels are left out; without labels every score is 0.5; repeated rows are each scored; extra columns are left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmart.llm.features import binned, letter_trigrams, repetition, row_blocks, shape_trigrams, unit
from reelmart.llm.text import utf8

TERMS, SHAPES = 2048, 1024
BLOCKS = ((0, TERMS, 1.0), (TERMS, TERMS + SHAPES, 1.5), (TERMS + SHAPES, None, 1.5))


def terms(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Term weights before document frequencies: a row for each text."""
    grams = np.log1p(letter_trigrams(data, offsets, TERMS)), np.log1p(shape_trigrams(data, offsets, SHAPES))
    return np.hstack([*grams, binned(repetition(data, offsets))])


def weighed(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return np.hstack([unit(found[:, a:b] * idf[a:b]) * w for a, b, w in BLOCKS])


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each term occurs, and the number of documents; over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = None, 0
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for lo, hi in row_blocks(offsets):
                found = (terms(data, offsets[lo : hi + 1]) > 0).sum(0, dtype=np.int64)
                sums, n = found if sums is None else sums + found, n + hi - lo
        if sums is not None:  # the row of number -1 counts documents
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(sums))), pa.array(np.append(n, sums))], names=["term", "n"])

    rows = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    by = {r.term: r.n for r in rows}
    return np.array([by[i] for i in range(len(by) - 1)], np.float64), by.get(-1, 0)


class Model:
    """Latent space and labelled vectors, fitted on labelled term weights."""

    def __init__(self, found: np.ndarray, labels: np.ndarray, df: np.ndarray, n: int, rank: int, neighbours: int):
        self.idf = np.log((n + 1) / (df + 1)).astype(np.float32) + 0.1
        x = weighed(found, self.idf)
        self.space = _directions(x, rank)
        self.vectors, self.labels = unit(x @ self.space), labels.astype(np.float32)
        self.neighbours = min(neighbours, len(labels))

    def __call__(self, found: np.ndarray) -> np.ndarray:
        cosines = unit(weighed(found, self.idf) @ self.space) @ self.vectors.T
        near = np.argpartition(-cosines, self.neighbours - 1, axis=1)[:, : self.neighbours]
        weights = np.maximum(np.take_along_axis(cosines, near, 1), 1e-6) ** 8
        return np.clip((weights * self.labels[near]).sum(1) / weights.sum(1), 0, 1)


def _directions(x: np.ndarray, rank: int, rounds: int = 4) -> np.ndarray:
    """The leading right singular vectors, by subspace iteration from a fixed start."""
    rank = min(rank, *x.shape)
    basis = np.random.default_rng(0).standard_normal((x.shape[1], min(rank + 16, *x.shape))).astype(np.float32)
    for _ in range(rounds):
        basis = np.linalg.qr(x.T @ (x @ basis))[0]
    _, _, turn = np.linalg.svd(x @ basis, full_matrices=False)
    return (basis @ turn.T[:, :rank]).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, sample: int = 1000, rank: int = 64, neighbours: int = 15) -> Model | None:
    """A model from documents and (doc_id, quality) rows: about ``sample`` documents of each class, by a hash of doc_id."""
    labels = labels.where("quality is not null and doc_id is not null").select("doc_id", F.col("quality").cast("int").alias("quality")).distinct()
    classes = labels.groupBy("quality").count().collect()
    if not classes:
        return None
    share = F.create_map(*(F.lit(x) for r in classes for x in (r.quality, min(1.0, sample / r["count"]))))
    chance = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / (1 << 30)
    chosen = labels.where(chance < share[F.col("quality")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for lo, hi in row_blocks(offsets):
                found = terms(data, offsets[lo : hi + 1])
                yield pa.RecordBatch.from_arrays([batch.column("quality")[lo:hi], pa.array([r.tobytes() for r in found], pa.binary())], names=["quality", "terms"])

    # the sample is bounded, so it may be broadcast
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("quality", "text")
    rows = rows.mapInArrow(run, "quality int, terms binary").orderBy("quality", "terms").collect()
    if not rows:
        return None
    df, n = document_frequencies(docs)
    return Model(np.stack([np.frombuffer(r.terms, np.float32) for r in rows]), np.array([r.quality for r in rows]), df, n, rank, neighbours)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            scores = [np.full(hi - lo, 0.5) if model is None else model(terms(data, offsets[lo : hi + 1])) for lo, hi in row_blocks(offsets)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(scores) if scores else [], pa.float64())], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")
