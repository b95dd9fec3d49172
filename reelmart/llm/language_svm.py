"""Language identification by hierarchy: the family first, then one-versus-one support vector machines within it.

Features are hashed trigrams of letters of the whole text. The family is the one with the greatest multinomial
likelihood a trigram, from counts of its training texts. Within a family, a linear support vector machine for each pair
of languages votes; ties go to the greater sum of margins. Which languages are related is given by ``FAMILIES``; a
language that is not named there is a family by itself, so any label can be learned.

The models are fitted on a bounded sample, ``sample`` texts per language chosen by a hash of doc_id, and applied to all.

Defined cases: a null text or one without a letter is ``und`` with score 0; null labels are never learned from; without
any training text everything is ``und``; repeated rows count each; extra columns are left.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from reelmart.llm.features import letter_trigrams, row_blocks, unit
from reelmart.llm.text import utf8

#: ISO 639-1 codes by family.
FAMILIES = {
    "germanic": ("da", "de", "en", "is", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "baltic": ("lt", "lv"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "tr", "uz"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "semitic": ("ar", "he", "mt"),
}
UNKNOWN = "und"


def family(language: str) -> str:
    code = language.lower().replace("_", "-").split("-")[0]
    return next((name for name, codes in FAMILIES.items() if code in codes), language)


class Model:
    """Fitted on texts' trigram counts and their languages."""

    def __init__(self, counts: np.ndarray, languages: list[str], steps: int = 30, slack: float = 1e-3):
        self.dims = counts.shape[1]
        labels = np.array(languages, object)
        self.families: dict[str, list[str]] = {}
        for language in sorted(set(languages)):
            self.families.setdefault(family(language), []).append(language)
        self.names = sorted(self.families)
        sums = np.array([counts[[family(x) == name for x in languages]].sum(0) for name in self.names]).reshape(-1, self.dims)
        self.log = np.log((sums + 0.5) / (sums + 0.5).sum(1, keepdims=True)).astype(np.float32)
        points = self._points(counts)
        self.pairs = {}
        for members in self.families.values():
            for a, b in combinations(members, 2):
                one = (labels == a) | (labels == b)
                self.pairs[a, b] = _svm(points[one], np.where(labels[one] == a, 1.0, -1.0), steps, slack)

    @staticmethod
    def _points(counts: np.ndarray) -> np.ndarray:
        return unit(np.sqrt(counts))

    def __call__(self, counts: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score of each row."""
        total = np.maximum(counts.sum(1, keepdims=True), 1)
        mean = counts @ self.log.T / total
        best = mean.argmax(1)
        odds = np.exp(np.minimum(total, 50) * (mean - mean.max(1, keepdims=True)))
        score = odds.max(1) / odds.sum(1)
        out, points = np.array([self.families[self.names[i]][0] for i in best], object), self._points(counts)
        for i, name in enumerate(self.names):
            members, at = self.families[name], np.flatnonzero(best == i)
            if len(members) < 2 or not len(at):
                continue
            votes, margins = np.zeros((len(at), len(members))), np.zeros((len(at), len(members)))
            for (a, b), (weights, bias) in self.pairs.items():
                if a in members:
                    margin = points[at] @ weights + bias
                    for language, sign in ((a, 1), (b, -1)):
                        votes[:, members.index(language)] += sign * margin > 0
                        margins[:, members.index(language)] += sign * margin
            chosen = np.lexsort((np.arange(len(members))[None, :].repeat(len(at), 0), margins, votes), axis=1)[:, -1]
            out[at] = [members[c] for c in chosen]
            margin = margins[np.arange(len(at)), chosen] / (len(members) - 1)
            score[at] *= 1 / (1 + np.exp(-4 * margin))
        return out.tolist(), np.clip(score, 0, 1)


def _svm(points: np.ndarray, sides: np.ndarray, steps: int, slack: float) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear machine: dual coordinate descent on the hinge loss, sides weighed evenly."""
    x = np.hstack([points, np.ones((len(points), 1), points.dtype)]).astype(np.float64)
    top = np.where(sides > 0, 1 / max(1, (sides > 0).sum()), 1 / max(1, (sides < 0).sum())) / slack / 2
    norms, alpha, weights = (x * x).sum(1), np.zeros(len(x)), np.zeros(x.shape[1])
    random = np.random.default_rng(0)
    for _ in range(steps):
        moved = 0.0
        for i in random.permutation(len(x)):
            new = min(max(alpha[i] + (1 - sides[i] * (x[i] @ weights)) / norms[i], 0.0), top[i])
            weights += (new - alpha[i]) * sides[i] * x[i]
            moved = max(moved, abs(new - alpha[i]))
            alpha[i] = new
        if moved < 1e-3:
            break
    return weights[:-1].astype(np.float32), float(weights[-1])


def fold(doc_id: str | Column, folds: int) -> Column:
    """The remainder by which rows are held out: of the CRC-32 of doc_id as text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def _counts(docs: DataFrame, dims: int, keep: str) -> DataFrame:
    """(keep, counts): trigram counts of texts as bytes of 32-bit floats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for lo, hi in row_blocks(offsets):
                found = letter_trigrams(data, offsets[lo : hi + 1], dims)
                yield pa.RecordBatch.from_arrays([batch.column(keep)[lo:hi], pa.array([r.tobytes() for r in found], pa.binary())], names=[keep, "counts"])

    return docs.select(keep, "text").mapInArrow(run, f"{keep} string, counts binary")


def fit(training: DataFrame, dims: int = 2048, sample: int = 500) -> Model | None:
    """A model from rows of doc_id, text, lang: about ``sample`` texts of each language, by a hash of doc_id."""
    training = training.where("lang is not null and text is not null")
    found = training.groupBy("lang").count().collect()
    if not found:
        return None
    share = F.create_map(*(F.lit(x) for r in found for x in (r.lang, min(1.0, sample / r["count"]))))
    chance = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / (1 << 30)
    rows = _counts(training.where(chance < share[F.col("lang")]), dims, "lang").orderBy("lang", "counts").collect()
    if not rows:  # so few texts that none was drawn
        rows = _counts(training, dims, "lang").limit(sample).collect()
    return Model(np.stack([np.frombuffer(r.counts, np.float32) for r in rows]), [r.lang for r in rows])


def identify(docs: DataFrame, model: Model | None, keep: list[str] | None = None) -> DataFrame:
    """The documents' columns (or those to keep) with lang_pred and score, which replace columns of these names."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # dims x (families + pairs of related languages) numbers
    keep = [c for c in keep or docs.columns if c not in ("lang_pred", "score")]
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    carried = docs.select(*keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            data, offsets = utf8(batch.column("_text"))
            known = batch.column("_lettered").to_numpy(zero_copy_only=False)
            names, scores = [], []
            for lo, hi in row_blocks(offsets):
                if model is None:
                    language, score = [UNKNOWN] * (hi - lo), np.zeros(hi - lo)
                else:
                    language, score = model(letter_trigrams(data, offsets[lo : hi + 1], model.dims))
                names += [x if k and model else UNKNOWN for x, k in zip(language, known[lo:hi], strict=True)]
                scores.append(np.where(known[lo:hi], score, 0.0))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(names, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())],
                names=[*keep, "lang_pred", "score"],
            )

    schema = StructType([*carried.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return docs.select(*keep, F.col("text").alias("_text"), lettered.alias("_lettered")).mapInArrow(run, schema)


def accepted(docs: DataFrame, model: Model | None, least: float = 0.5) -> DataFrame:
    """The documents whose language is told with a score of ``least``; a missing lang is set to it."""
    told = identify(docs, model).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return told.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)
