import random

import numpy as np
import xxhash
from conftest import rows

from reelmart.llm import simhash_vptree as V

from .conftest import words


def fingerprint(text, shingle=3):
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    grams = [b" ".join(found[i : i + shingle]) for i in range(max(1, len(found) - shingle + 1))]
    sums = [sum(xxhash.xxh64_intdigest(g, 42) >> b & 1 for g in grams) for b in range(64)]
    return sum((2 * s > len(grams)) << b for b, s in enumerate(sums))


def reach(numbers, linked):
    """The least index that links reach, by trying all pairs."""
    parent = list(range(len(numbers)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(numbers)):
        for j in range(i):
            if linked(i, j):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(numbers))]


def test_brute_force(documents, odd_texts):
    table = [(i, t) for i, t in enumerate([t for t in odd_texts if t is None or len(t) < 100])]
    random_ = random.Random(3)
    for group in range(12):
        base = words(group, 300)
        for _ in range(8):
            copy = list(base)
            for _ in range(random_.randrange(3)):
                copy[random_.randrange(300)] = f"n{random_.randrange(9)}"
            table.append((len(table), " ".join(copy).upper()))
    got = rows(V.near_duplicates(documents(*table)), "doc_id", "fingerprint", "component_id")
    prints = [fingerprint(t) for _, t in table]
    least = reach(prints, lambda i, j: bin(prints[i] ^ prints[j]).count("1") <= 2)
    assert len(set(least)) < len(table) - 20
    assert got == sorted(((i, f"{p:016x}", r) for (i, _), p, r in zip(table, prints, least, strict=True)), key=str)


def clustered(n, seed):
    random_ = np.random.default_rng(seed)
    points = random_.integers(0, 1 << 63, n // 4, dtype=np.uint64)
    near = points[random_.integers(0, len(points), n - len(points))]
    for _ in range(3):
        near = near ^ (np.uint64(1) << random_.integers(0, 64, len(near), dtype=np.uint64))
    return np.unique(np.concatenate([points, near]))


def test_shards_lose_no_link(spark):
    """Many small shards: the components of the forest are those of all pairs."""
    points = clustered(1_500, 5)
    table = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp0 long").selectExpr("fp0 id", "0L size", "fp0")
    roots = {r.node: r.root for r in V.components(V.links(table, 2, shard_rows=40)).collect()}
    numbers = points.view(np.int64).tolist()
    close = np.bitwise_count(points[:, None] ^ points[None]) <= 2
    want = reach(numbers, lambda i, j: close[i, j])
    mine = [roots.get(x, x) for x in numbers]
    groups = lambda labels: {frozenset(i for i, y in enumerate(labels) if y == x) for x in set(labels)}
    assert groups(mine) == groups(want)
    assert len(set(want)) < len(points)


def test_local_tree_equals_all_pairs():
    points = clustered(1_200, 9)
    homes = 900
    root = V.link(points, homes, 4).roots(np.arange(len(points)))
    close = np.bitwise_count(points[:, None] ^ points[None]) <= 4
    want = reach(points, lambda i, j: close[i, j] and min(i, j) < homes)
    assert len(set(root.tolist())) == len(set(want))
    assert all((root[i] == root[j]) == (want[i] == want[j]) for i in range(0, len(points), 7) for j in range(len(points)))


def test_components_of_a_path(spark):
    edges = spark.range(40).selectExpr("id + 1 a", "id b")
    assert {(r.node, r.root) for r in V.components(edges).collect()} == {(i, 0) for i in range(1, 41)}


def test_empty_and_null_ids(documents):
    assert V.near_duplicates(documents()).collect() == []
    got = V.near_duplicates(documents((None, "a b c d"), (4, "a b c d"), (None, "q r s t"), (4, "a b c d")))
    assert rows(got, "doc_id", "component_id") == sorted([(None, 4), (4, 4), (4, 4), (None, None)], key=str)


def test_one_document_of_each_group_stays(documents):
    base, short, other = words(1, 400), words(2, 60), words(3, 400)
    near = [*base[:200], "changed", *base[201:]]
    half = [*base[:200], *words(4, 200)]
    table = [(7, " ".join(near)), (3, " ".join(base)), (9, " ".join(base)), (9, " ".join(base)), (5, " ".join(half)), (6, " ".join(other)), (8, " ".join(short)), (None, " ".join(short)), (1, None), (2, "")]
    kept = V.deduplicated(documents(*table))
    assert kept.columns == documents(*table).columns
    assert rows(kept, "doc_id") == sorted([(3,), (5,), (6,), (8,), (1,)], key=str)
    assert V.deduplicated(documents()).collect() == []


def test_near_copies_of_large_groups_are_found(documents):
    """Copies with a share of 0.9 or more of their 5-word shingles fall together, unrelated texts don't."""
    random_ = random.Random(8)
    table = []
    for group in range(10):
        base = words(group, 500)
        for copy in range(6):
            text = list(base)
            for _ in range(copy):
                text[random_.randrange(500)] = f"n{random_.randrange(9)}"
            table.append((len(table), " ".join(text)))
    assert rows(V.deduplicated(documents(*table)), "doc_id") == sorted([(6 * g,) for g in range(10)], key=str)


def similar(a, b, shingle=5):
    """The share of distinct shingles that two texts have in common."""
    a, b = ({tuple(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))} for w in (a.split(), b.split()))
    return len(a & b) / len(a | b)


def kept(texts):
    least = reach(texts, lambda i, j: similar(texts[i], texts[j]) >= 0.8)
    return sorted([(i,) for i in set(least)], key=str)


def test_a_repeated_line_links_no_different_texts(documents):
    line = " ".join(words(77, 10, 10**6))
    texts = [" ".join([line] * times + words(1_000 * times + i, own, 10**6)) for times, own in ((20, 400), (10, 100)) for i in range(12)]
    assert kept(texts) == sorted([(i,) for i in range(24)], key=str)
    assert rows(V.deduplicated(documents(*enumerate(texts))), "doc_id") == kept(texts)


def test_links_are_those_of_true_similarity(documents):
    """Copies around the threshold, texts and their doublings, short texts; in one block and in many."""
    random_, texts = random.Random(4), []
    for group, size in enumerate((9, 30, 120, 120, 400, 400, 400)):
        base = words(50 + group, size, 10**6)
        texts += [" ".join(base), " ".join(base + base), " ".join(base[: size - size // 8]), " ".join(base[: size - size // 4])]
        for edits in range(1, 10):
            copy = list(base)
            for _ in range(edits * size // 100 + 1):
                copy[random_.randrange(size)] = f"n{random_.randrange(10**6)}"
            texts.append(" ".join(copy))
    want = kept(texts)
    assert len(texts) // 5 < len(want) < len(texts) - 20
    for more in ({}, {"block_shingles": 700}):
        assert rows(V.deduplicated(documents(*enumerate(texts), (0, texts[0])), **more), "doc_id") == want


def test_alike_equals_all_pairs():
    random_ = np.random.default_rng(6)
    sets = [np.unique(random_.integers(40 * (i % 3), 40 * (i % 3) + 14, 20).astype(np.uint64)) for i in range(150)] + [np.zeros(0, np.uint64)] * 2
    pair = lambda i, j: len(np.union1d(sets[i], sets[j])) and len(np.intersect1d(sets[i], sets[j])) / len(np.union1d(sets[i], sets[j])) >= 0.8
    want, got = reach(sets, pair), V.alike(sets, 0.8).tolist()
    assert len(set(want)) > 5 and got == want


def test_the_sample_is_a_part_of_the_points(spark, monkeypatch):
    points = clustered(1_500, 5)
    table = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp0 long").selectExpr("fp0 id", "0L size", "fp0")
    sizes, tree = [], V.Tree
    monkeypatch.setattr(V, "Tree", lambda sample, depth: sizes.append(len(sample)) or tree(sample, depth))
    V.links(table, 2, shard_rows=40)
    assert 0 < sizes[0] < len(points) / 4
