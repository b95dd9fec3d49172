import random

import numpy as np
import pytest
from conftest import rows

from reelmart.llm import decontaminate_tiling as D

from .conftest import words


def naive(item, document, match):
    """Greedy string tiling by trying every pair of places; the longest match first, then by place."""
    own, other, total = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(document)):
                n = 0
                while i + n < len(item) and j + n < len(document) and item[i + n] == document[j + n] and i + n not in own and j + n not in other:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < match:
            return total
        own.update(range(i, i + n))
        other.update(range(j, j + n))
        total += n


@pytest.mark.parametrize("seed", range(40))
def test_tiling(seed):
    random_ = random.Random(seed)
    item = [random_.randrange(1, 6) for _ in range(random_.randrange(1, 30))]
    document = [random_.randrange(0, 6) for _ in range(40)]
    for _ in range(2):
        i = random_.randrange(len(item))
        at = random_.randrange(len(document))
        document[at:at] = item[i : i + 9]
    assert D.tiled(np.array(item), np.array(document), 3) == naive(item, document, 3)


@pytest.fixture(scope="module")
def benchmark(spark):
    def make(*items):
        return spark.createDataFrame(list(items), "item_id long, text string")

    return make


def test_finds_passages_in_any_order_and_leaves_the_rest(documents, benchmark):
    item = words(1, 40)
    swapped = [*item[20:], *words(2, 30), *item[:20]]
    loud = " ".join(item).upper().replace(" ", "!! \n")
    third, apart = item[:13], [w for i, w in enumerate(item) for w in (w, f"q{i}")]
    table = [(1, " ".join([*words(3, 50), *item, *words(4, 50)])), (2, " ".join(swapped)), (3, loud), (4, " ".join([*third, *words(5, 40)])), (5, " ".join(apart)), (6, None), (7, ""), (None, " ".join(item)), (8, " ".join(words(6, 60_000) + item)), (9, " ".join(words(7, 500))), (1, " ".join(item))]
    items = benchmark((10, " ".join(item)), (11, None), (12, ""), (13, "w1 w2"), (14, " ".join(item)), (None, " ".join(words(9, 30))))
    docs = documents(*table)
    for block in (10, 500_000):  # many blocks or one
        got = D.contained(docs, items, block_tokens=block)
        assert rows(got, "doc_id", "item_id", "covered") == sorted(((d, i, 1.0) for d in (1, 1, 2, 3, 8, None) for i in (10, 14)), key=str)
        kept = D.clean(docs, items, block_tokens=block)
        assert kept.columns == docs.columns and rows(kept, "doc_id") == sorted([(4,), (5,), (6,), (7,), (9,)], key=str)


def test_against_all_pairs(documents, benchmark):
    random_ = random.Random(2)
    items = [(i, " ".join(words(i, 12, 30))) for i in range(8)]
    table = []
    for i in range(40):
        text = words(100 + i, 30, 30)
        a = items[i % 8][1].split()
        cut = random_.randrange(4, 12)
        text[10:10] = a[:cut]
        text[5:5] = a[cut:]
        table.append((i, " ".join(text)))
    want = []
    for d, t in table:
        for i, x in items:
            share = naive(x.split(), t.split(), 3) / len(x.split())
            if share >= 0.7:
                want.append((d, i, share))
    got = D.contained(documents(*table), benchmark(*items), match=3, coverage=0.7)
    assert rows(got, "doc_id", "item_id", "covered") == sorted(want, key=str) and 10 < len(want) < 200


def test_empty(documents, benchmark):
    assert D.contained(documents(), benchmark((1, "a b c d e f"))).collect() == []
    assert D.contained(documents((1, "a b c d e f")), benchmark()).collect() == []
    assert D.clean(documents((1, "a b c d e f")), benchmark()).count() == 1
