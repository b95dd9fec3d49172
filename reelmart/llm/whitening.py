"""Whitening of vectors by a covariance from polarisation: variances of single dimensions and of sums of two of them.

Vectors become whole numbers x = floor(64 c) + 1000000. They are centred at the whole number next to the mean, and for
every dimension and every sum of two dimensions the squares of the centred values are summed exactly; what the mean has
behind the point is put right in exact whole numbers, n^2 Sum y^2 - n (Sum y)^2 for y = x - m. A covariance is half of
what the variance of a sum has above the two variances. Only the d (d + 1) / 2 sums, not the vectors, reach the driver,
which assembles the matrix and takes its eigenvectors.

Defined cases: a null vector goes, and one with a null or non-finite entry; so does one whose length isn't the commonest
(the greater of equally common ones), as it has other dimensions; entries beyond +-2**50 count as +-2**50; repeated rows
and null ids are vectors like others; components whose eigenvalue is zero to double precision are left out, so an empty
table, one vector or equal vectors give an empty result; a deviation that doesn't fit a long is null; extra columns are
left.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OFFSET, SCALE = 1_000_000, 64.0
_MOST = 2.0**50
#: Bits of a limb: products of sums of two limbs stay below 2**43, so a million of them fit a long.
_LIMB, _ROWS = 20, 1 << 19


def _entries(df: DataFrame, vector: str) -> DataFrame:
    """The rows whose vectors are whole and finite."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return df.where(F.col(vector).isNotNull() & ~bad)


def whole_numbers(column: pa.Array, d: int) -> np.ndarray:
    """The vectors' x, a row for each."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
    return np.floor(np.clip(values, -_MOST, _MOST) * SCALE).astype(np.int64) + OFFSET


def pair_squares(y: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """The exact sums over the rows of the squares of y_i + y_j, i <= j, as (bits to shift by, longs).

    Numbers are cut to limbs of 20 bits, one for ordinary vectors, so that no square and no sum leaves a long.
    """
    limbs: list[np.ndarray] = []
    while True:
        low = ((y + (1 << (_LIMB - 1))) & ((1 << _LIMB) - 1)) - (1 << (_LIMB - 1))
        limbs.append(low)
        y = (y - low) >> _LIMB
        if not y.any():
            break
    out: dict[tuple[int, int], list[np.ndarray]] = {}
    for i in range(y.shape[1]):
        sums = [limb[:, i : i + 1] + limb[:, i:] for limb in limbs]
        for a, x in enumerate(sums):
            for b in range(a, len(sums)):
                part = np.einsum("ij,ij->j", x, sums[b]) * (1 if a == b else 2)
                out.setdefault((a, b), []).append(part)
    return [(_LIMB * (a + b), np.concatenate(parts)) for (a, b), parts in out.items()]


@dataclass(frozen=True)
class Whitening:
    """What a fit has learned: centres m, the rest T = S - n m of the sums, unit eigenvectors (columns), eigenvalues."""

    n: int
    centre: list[int]
    rest: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def width(self) -> int:
        return len(self.centre)

    def whitened(self, y: np.ndarray) -> np.ndarray:
        mean = np.array([t / self.n for t in self.rest])
        return ((y - mean) @ self.vectors) / np.sqrt(self.values)

    def deviations(self, y: np.ndarray) -> list[int | None]:
        """The sums of (n x - S)^2 = (n y - T)^2, null beyond a long."""
        most, rest = int(np.abs(y).max(initial=0)), np.array(self.rest, object)
        largest = self.n * most + max(map(abs, self.rest))
        if largest**2 * self.width < 1 << 63:
            z = self.n * y - rest.astype(np.int64)
            return np.einsum("ij,ij->i", z, z).tolist()
        z = y.astype(object) * self.n - rest
        return [v if v < 1 << 63 else None for v in (z * z).sum(axis=1)]


def _width(df: DataFrame, vector: str) -> int:
    sizes = df.groupBy(F.size(vector).alias("d")).count()
    first = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    return first.d if first else 0


def fit(df: DataFrame, vector: str = "embedding", components: int = 32) -> Whitening | None:
    """Learned from all whole vectors of the table; None if no component has a variance."""
    rows = _entries(df.select(vector), vector)
    d = _width(rows, vector)
    rows = rows.where(F.size(vector) == d)
    if not d:
        return None

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole_numbers(batch.column(0), d)
            step = _ROWS if np.abs(x).max(initial=0) < 1 << 43 else 32  # sums stay below 2**62
            for lo in range(0, len(x), step):
                part = x[lo : lo + step]
                yield pa.record_batch({"dim": pa.array(np.arange(-1, d)), "part": pa.array([len(part), *part.sum(axis=0).tolist()], pa.int64())})

    exact = F.sum(F.col("part").cast("decimal(38,0)")).alias("total")
    total = {r.dim: int(r.total) for r in rows.mapInArrow(sums, "dim long, part long").groupBy("dim").agg(exact).collect()}
    n = total.pop(-1)
    centre = [(2 * total[i] + n) // (2 * n) for i in range(d)]
    rest = [total[i] - n * m for i, m in enumerate(centre)]

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = whole_numbers(batch.column(0), d) - np.array(centre)
            for lo in range(0, len(y), _ROWS):
                for shift, part in pair_squares(y[lo : lo + _ROWS]):
                    yield pa.record_batch({"pair": pa.array(np.arange(len(part))), "shift": pa.array(np.full(len(part), shift)), "part": pa.array(part)})

    found = rows.mapInArrow(squares, "pair long, shift long, part long").groupBy("pair", "shift").agg(exact).collect()
    pairs = [0] * (d * (d + 1) // 2)
    for r in found:
        pairs[r.pair] += int(r.total) << r.shift
    covariance = _polarised(pairs, rest, n)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    trace = float(np.trace(covariance))
    good = int((values > max(trace, 0.0) * 1e-12 * d).sum())
    keep = min(components, good)
    return Whitening(n, centre, rest, vectors[:, :keep].copy(), values[:keep].copy(), trace) if keep else None


def _polarised(pairs: list[int], rest: list[int], n: int) -> np.ndarray:
    """The covariance matrix from the sums of (y_i + y_j)^2: exact until the one division of each entry."""
    d, at = len(rest), 0
    spread = [[0] * d for _ in range(d)]  # n^2 times the variance of the sum of two dimensions
    for i in range(d):
        for j in range(i, d):
            spread[i][j] = n * pairs[at] - (rest[i] + rest[j]) ** 2
            at += 1
    out = np.zeros((d, d))
    for i in range(d):
        for j in range(i, d):  # the sum of a dimension with itself has four times its variance
            cross = 4 * spread[i][j] - spread[i][i] - spread[j][j] if i != j else 2 * spread[i][i]
            out[i, j] = out[j, i] = cross / (8 * n * n)
    return out


def _identity_error(rows: DataFrame, vector: str, model: Whitening) -> float:
    """The largest entry by which the covariance of the whitened rows misses the identity."""
    k, d = len(model.values), model.width

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            w = model.whitened(whole_numbers(batch.column(0), d) - np.array(model.centre))
            total[:k] += w.T @ w
            total[k] += w.sum(axis=0)
        yield pa.record_batch({"at": pa.array(np.arange(total.size)), "part": pa.array(total.ravel())})

    found = rows.select(vector).mapInArrow(moments, "at long, part double").groupBy("at").agg(F.sum("part").alias("part")).collect()
    total = np.zeros((k + 1) * k)
    for r in found:
        total[r["at"]] = r.part
    total = total.reshape(k + 1, k) / model.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def whitened(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 32) -> DataFrame:
    """key, component (from 1, by falling variance), n, deviation, whitened, explained, identity_error: a row for each
    whole vector and component."""
    kind = df.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model = fit(df, vector, components)
    if model is None:
        return df.sparkSession.createDataFrame([], schema)
    rows = _entries(df.select(key, vector), vector).where(F.size(vector) == model.width)
    error, k = _identity_error(rows, vector, model), len(model.values)
    shares = model.values / model.trace

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                y = whole_numbers(part.column(1), model.width) - np.array(model.centre)
                m = len(y)
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.record_batch(
                    {
                        key: part.column(0).take(each),
                        "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        "n": pa.array(np.full(m * k, model.n)),
                        "deviation": pa.array(model.deviations(y), pa.int64()).take(each),
                        "whitened": pa.array(model.whitened(y).ravel()),
                        "explained": pa.array(np.tile(shares, m)),
                        "identity_error": pa.array(np.full(m * k, error)),
                    }
                )

    return rows.mapInArrow(project, schema)
