import math
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from conftest import SMALL

from reelmart.llm import whitening
from reelmart.llm.whitening import fit, pair_squares, whitened

SCHEMA = "vec_id long, embedding array<float>, n string, component string, pair string, dim string"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, "n", "c", "p", "d") for i, v in vectors], SCHEMA)


def x_of(vectors):
    return [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]


def check(found, vectors, components=32):
    """Everything against exact fractions and numpy's own eigenvectors."""
    x = x_of([v for _, v in vectors])
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    z = [[n * r[i] - s[i] for i in range(d)] for r in x]
    cov = np.array([[float(Fraction(sum(r[i] * r[j] for r in z), n**3)) for j in range(d)] for i in range(d)])
    values = np.linalg.eigvalsh(cov)[::-1]
    k = min(components, int((values > values.sum() * 1e-12 * d).sum()))
    assert len(found) == n * k and {r.n for r in found} == {n}
    by = defaultdict(list)
    for r in found:
        by[r.component].append(r)
    centred = np.array([[float(Fraction(c, n)) for c in r] for r in z])
    order = {i: a for a, (i, _) in enumerate(vectors)}
    for c in range(1, k + 1):
        rows = sorted(by[c], key=lambda r: order[r.vec_id])
        assert [r.deviation for r in rows] == [sum(v * v for v in r) for r in z]
        assert {round(r.explained / (values[c - 1] / values.sum()), 6) for r in rows} == {1}
        w = np.array([r.whitened for r in rows])
        # the direction is an eigenvector: unit, and V v = e v
        v = centred.T @ w / n / math.sqrt(values[c - 1])
        assert abs(v @ v - 1) < 1e-8 and np.abs(cov @ v - values[c - 1] * v).max() < 1e-7 * values[0]
        assert np.abs(centred @ v / math.sqrt(values[c - 1]) - w).max() < 1e-7
    w = np.array([[r.whitened for r in sorted(by[c], key=lambda r: order[r.vec_id])] for c in range(1, k + 1)])
    error = np.abs(np.cov(w, bias=True) - np.eye(k)).max() if k > 1 else abs(w.var() - 1)
    assert {r.identity_error for r in found} == {found[0].identity_error} and abs(found[0].identity_error - error) < 1e-9 and error < 1e-4


@pytest.mark.parametrize("seed, d", [(0, 5), (1, 12), (2, 1), (3, 40)])
def test_brute_force(spark, seed, d):
    random_ = np.random.default_rng(seed)
    mixing = random_.normal(size=(d, d))
    vectors = [(i, (random_.normal(size=d) @ mixing + seed).tolist()) for i in range(120)]
    found = whitened(table(spark, vectors).repartition(5), components=32)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(found.collect(), vectors)


def test_given_table(spark):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    vectors = [(r.vec_id, r.embedding) for r in df.collect()]
    check(whitened(df).collect(), vectors)


def test_bad_vectors_go(spark):
    random_ = np.random.default_rng(5)
    good = [(i, random_.normal(size=4).tolist()) for i in range(30)]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0]), (103, [1.0, math.nan, 2.0, 3.0]), (104, [math.inf, 0.0, 0.0, 0.0]), (105, [0.0, 0.0, -math.inf, 0.0]), (106, [1.0] * 3), (107, [2.0] * 5)]
    check(whitened(table(spark, good + bad)).collect(), good)


def test_tables_without_a_component(spark):
    for vectors in ([], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(5)], [(1, None)], [(1, []), (2, [])]):
        assert whitened(table(spark, vectors)).collect() == []


def test_ties_repeats_and_constant_dimensions(spark):
    vectors = [(i % 7, [1.0 if i % 2 else -1.0, 0.5, 1.0 if i % 4 < 2 else -1.0]) for i in range(40)]
    found = whitened(table(spark, vectors)).collect()
    assert len(found) == 80 and {r.component for r in found} == {1, 2}
    assert all(abs(abs(r.whitened) - 1) < 1e-9 or abs(abs(r.whitened) - math.sqrt(2)) < 1e-9 or abs(r.whitened) < 1e-9 for r in found)
    assert len({r.explained for r in found}) <= 2 and all(abs(r.explained - 0.5) < 1e-9 for r in found)


def test_large_entries_stay_exact(spark):
    vectors = [(i, [float((-1) ** i * 2.0 ** (20 + i % 9)), float(i), 3.0e38 if i == 4 else 0.0]) for i in range(20)]
    model = fit(table(spark, vectors))
    x = [[min(max(math.floor(64 * min(max(float(np.float32(c)), -(2.0**50)), 2.0**50)), -(2**56)), 2**56) + 1_000_000 for c in v] for _, v in vectors]
    n, s = 20, [sum(c) for c in zip(*x, strict=True)]
    assert model.trace == pytest.approx(float(sum(Fraction(sum((n * r[i] - s[i]) ** 2 for r in x), n**3) for i in range(3))), rel=1e-14)
    found = {r.vec_id: r.deviation for r in whitened(table(spark, vectors)).where("component = 1").collect()}
    want = [sum((n * r[i] - s[i]) ** 2 for i in range(3)) for r in x]
    assert [found[i] for i in range(20)] == [v if v < 1 << 63 else None for v in want]


def test_many_large_entries(spark):
    vectors = [(i, [3e38 if i % 2 else -3e38, float(i)]) for i in range(300)]
    model = fit(table(spark, vectors).repartition(1))
    assert model.centre == [1_000_000, 1_009_568] and model.rest == [0, 0]


@pytest.mark.parametrize("bits", [3, 18, 21, 39, 55])
def test_sums_of_squares_are_exact(bits):
    random_ = np.random.default_rng(bits)
    y = random_.integers(-(1 << bits), 1 << bits, (50, 6))
    got = [0] * 21
    for shift, part in pair_squares(y):
        got = [g + (int(p) << shift) for g, p in zip(got, part, strict=True)]
    assert got == [sum((int(r[i]) + int(r[j])) ** 2 for r in y) for i in range(6) for j in range(i, 6)]


def test_covariances_come_from_variances(monkeypatch, spark):
    """Only sums of squares of single dimensions and of sums of two of them are gathered."""
    random_ = np.random.default_rng(9)
    vectors = [(i, random_.normal(size=6).tolist()) for i in range(50)]
    kept = []
    real = whitening._polarised
    monkeypatch.setattr(whitening, "_polarised", lambda pairs, rest, n: kept.append((pairs, rest, n)) or real(pairs, rest, n))
    fit(table(spark, vectors))
    (pairs, rest, n), x = kept[0], np.array(x_of([v for _, v in vectors]), object)
    centre = [(2 * int(c) + n) // (2 * n) for c in x.sum(axis=0)]
    y = x - np.array(centre, object)
    assert pairs == [int(((y[:, i] + y[:, j]) ** 2).sum()) for i in range(6) for j in range(i, 6)]
    assert rest == [int(c) for c in y.sum(axis=0)]
