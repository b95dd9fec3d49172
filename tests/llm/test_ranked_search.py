import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from reelmart.llm import ranked_search
from reelmart.llm.ranked_search import Lookup, nra, occurrences, search, terms

from .conftest import words

ITEM = "item_id long, text string, doc_id string, score string"


def split(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute_force(docs, items, k=10):
    found = [(d, Counter(split(t))) for d, t in docs]
    found = [(d, c) for d, c in found if c]
    n, total = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(split(text))
    out = []
    for item, query in wanted.items():
        scores = []
        for d, c in found:
            m = 10 + 90 * sum(c.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in query if c[t])
            if s > 0:
                scores.append((-s, (d is not None, d or 0), d))
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def found(spark, documents, docs, items, **options):
    table = spark.createDataFrame([(*r, "x", "y") for r in items], ITEM)
    got = search(documents(*docs), table, **options)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, got.collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_brute_force(spark, documents, seed):
    random_ = random.Random(seed)
    docs = [(i * 7 % 101, " ".join(words(seed * 500 + i, random_.randrange(1, 90), 60))) for i in range(100)]
    docs += [(200 + i, docs[i % 9][1]) for i in range(40)]  # ties
    items = [(i, " ".join(words(900 + i, 3 + 5 * i, 70))) for i in range(8)] + [(3, "w1 w2 W3"), (20, "w1 w1 w1"), (21, "w5")]
    assert found(spark, documents, docs, items) == brute_force(docs, items)
    assert found(spark, documents, docs, items, k=3, group_terms=20, block_bytes=2_000) == brute_force(docs, items, 3)


def test_odd_rows(spark, documents, odd_texts):
    docs = [*enumerate(odd_texts), (3, odd_texts[3]), (None, "two WORDS"), (None, None)]
    items = [(1, None), (2, ""), (3, "!!"), (4, "TWO É a"), (None, "one"), (5, odd_texts[8]), (5, "x" * 50_000), (6, "absent"), (4, "words e　f")]
    assert found(spark, documents, docs, items) == brute_force(docs, items)
    assert found(spark, documents, [], items) == found(spark, documents, docs, []) == []


def test_text_ids(spark, documents):
    docs = [(f"d{i}", " ".join(words(i % 5, 20, 30))) for i in range(30)]
    df = spark.createDataFrame(docs, "doc_id string, text string")
    items = spark.createDataFrame([("a", "w1 w2 w3"), ("b", "w9")], "item_id string, text string")
    got = sorted(map(tuple, search(df, items).collect()))
    assert {r[0] for r in got} == {"a", "b"}
    for (i, r, d, s), (j, q, e, u) in zip(got, got[1:], strict=False):
        assert i != j or (q == r + 1 and (s > u or (s == u and d < e)))


def test_terms_are_those_of_the_pattern():
    text = "Don't stop: ÉTÉ_9 x\x00y naïve中文 a-b\x7fc"
    assert terms(text) == split(text) and "ÉtÉ" in terms(text)


def test_lookup_is_by_bytes():
    """Terms that share beginnings, of 1 to 40 bytes, against a plain dictionary."""
    random_ = random.Random(1)
    pool = ["".join(random_.choices("ab", k=random_.choice([1, 2, 7, 8, 9, 15, 16, 17, 24, 40]))) for _ in range(400)]
    vocabulary = sorted({t.encode() for t in pool[:200]})
    lookup = Lookup(vocabulary)
    data = np.frombuffer(" ".join(pool).encode() + b"\0" * 8, np.uint8)
    ends = np.cumsum([len(t) + 1 for t in pool]) - 1
    starts = ends - [len(t) for t in pool]
    assert list(lookup(data, starts, ends - starts)) == [lookup.number_of.get(t.encode(), -1) for t in pool]
    assert list(Lookup([])(data, starts, ends - starts)) == [-1] * len(pool)


def test_occurrences(documents):
    texts = ["b a b", None, "", "c " * 5 + "B", "abc"]
    row, term, times, n = occurrences(pa.array(texts), Lookup([b"a", b"b"]))
    assert list(zip(row, term, times, strict=True)) == [(0, 0, 1), (0, 1, 2), (3, 1, 1)] and list(n) == [3, 0, 0, 6, 1]


@pytest.mark.parametrize("seed", range(20))
def test_nra_is_exact_and_reads_in_order(seed):
    """Against sums over all lists, with many equal scores, whatever floor and step."""
    random_ = np.random.default_rng(seed)
    documents, lists, total = 300, [], np.zeros(300, np.int64)
    for _ in range(1 + seed % 7):
        d = random_.choice(documents, random_.integers(1, documents), replace=False)
        s = random_.integers(1, 6 if seed % 2 else 1000, len(d)) * 10
        order = np.argsort(-s, kind="stable")
        lists.append((d[order], s[order]))
        total[d] += s
    best = np.lexsort((np.arange(documents), -total))
    best = best[total[best] > 0][:10]
    for floor in (0, int(total[best[-1]]), int(total[best[0]])):
        got, scores, read = nra(lists, documents, 10, floor, step=8)
        want = [d for d in best if total[d] >= floor]
        assert list(got[: len(want)]) == want and list(scores) == list(total[got]) and read <= sum(len(d) for d, _ in lists)


def test_nra_stops_early():
    """One list with a few high impacts and another with low ones: the tail is not read."""
    high = (np.arange(1000), np.append(np.full(10, 10**6), np.ones(990, np.int64)))
    low = (np.arange(1000), np.append(np.full(10, 10**5), np.ones(990, np.int64)))
    got, scores, read = nra([high, low], 1000, 10)
    assert list(got) == list(range(10)) and set(scores) == {1_100_000} and read < 300


def test_impacts_beyond_64_bits():
    w, tf = np.array([3, 5]), np.array([2, 7])
    n, documents, total = np.array([10**9, 5 * 10**8]), 10**11, 10**14
    want = [int(w[i]) * (10**9 * int(tf[i]) // (1000 * int(tf[i]) + 8 * (10 + 90 * int(n[i]) * documents // total))) for i in range(2)]
    assert list(ranked_search.impacts(w, tf, n, documents, total)) == want
