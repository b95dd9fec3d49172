import zlib

import numpy as np
import pytest
from conftest import SMALL, rows

from reelmart.llm import quality_knn as Q
from reelmart.llm.queries import QUERIES

from .conftest import words


def corpus():
    good = [" ".join(words(i, 60)) + "." for i in range(60)]
    bad = [" ".join(f"{w}%%% &&&" for w in words(i, 40)) for i in range(20)] + [" ".join([f"w{i}"] * 50) for i in range(20)]
    return [(i, t, int(i < len(good))) for i, t in enumerate([*good, *bad])]


@pytest.fixture(scope="module")
def labels(spark):
    def make(*found):
        return spark.createDataFrame(list(found), "doc_id long, quality int, toxic int, score string")

    return make


def test_votes(documents, labels, odd_texts):
    mine = corpus()
    docs = documents(*((i, t) for i, t, _ in mine), *((500 + i, t) for i, t in enumerate(odd_texts)), (None, "no id"), (1, mine[1][1]))
    some = [(i, q, 0, "x") for i, _, q in mine if i % 3]
    model = Q.fit(docs, labels(*some, (None, 1, 0, "x"), (3, None, 0, "x"), (4000, 1, 0, "x"), some[0]), neighbours=5)
    scored = dict(rows(Q.score(docs, model), "doc_id", "score"))
    assert all(0 <= s <= 1 for s in scored.values()) and len(scored) == len(mine) + len(odd_texts) + 1
    held = [(scored[i] >= 0.3, bool(q)) for i, _, q in mine if i % 3 == 0]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    assert scored[500] == scored[501]  # null as empty


def test_vote_by_hand():
    random_ = np.random.default_rng(1)
    found = np.abs(random_.standard_normal((40, Q.TERMS + Q.SHAPES + 68))).astype(np.float32)
    quality = np.arange(40) % 2
    model = Q.Model(found, quality, np.full(found.shape[1], 5.0), 40, rank=8, neighbours=4)
    query = np.abs(random_.standard_normal((3, found.shape[1]))).astype(np.float32)
    got = model(query)
    for row, score in zip(query, got, strict=True):
        vector = Q.weighed(row[None], model.idf)[0] @ model.space
        cosines = [float(v @ vector / np.linalg.norm(vector)) for v in model.vectors]
        near = sorted(range(40), key=lambda i: -cosines[i])[:4]
        weight = [max(cosines[i], 1e-6) ** 8 for i in near]
        assert abs(score - sum(w * quality[i] for w, i in zip(weight, near, strict=True)) / sum(weight)) < 1e-3


def test_frequencies_cover_all_documents(documents):
    docs = documents(*((i, t) for i, t, _ in corpus()), (200, None))
    df, n = Q.document_frequencies(docs)
    assert n == 101 and df.max() <= 101 and len(df) == Q.TERMS + Q.SHAPES + 68


def test_without_labels(documents, labels):
    docs = documents((1, "a b"), (2, None))
    assert Q.fit(docs, labels()) is None
    assert rows(Q.score(docs, None), "doc_id", "score") == [(1, 0.5), (2, 0.5)]
    one = Q.fit(docs, labels((1, 1, 0, "x")))
    assert rows(Q.score(docs, one), "doc_id", "score") == [(1, 1.0), (2, 1.0)]
    assert Q.score(documents(), one).collect() == [] and Q.fit(documents(), labels((1, 1, 0, "x"))) is None


def test_held_out(spark):
    folder = SMALL.replace("0.001", "0.01")
    got = {r.doc_id: r for r in QUERIES["op1_quality"](spark, folder).collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) for d, r in got.items())
    held = [(got[r.doc_id].predicted, r.quality) for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if got[r.doc_id].held_out]
    assert len(got) == 1000 and sum(a == b for a, b in held) >= 0.95 * len(held)
