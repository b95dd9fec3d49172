import hashlib
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from reelmart.llm import winnowing as N

from .conftest import words


def selected(hashes, window):
    """Winnowing as defined: the least hash of every window, the rightmost among equals."""
    out = []
    for i in range(max(1, len(hashes) - window + 1)):
        part = list(enumerate(hashes[i : i + window], i))
        least = min(h for _, h in part)
        at = max(p for p, h in part if h == least)
        if not out or out[-1] != (least, at):
            out.append((least, at))
    return out


@pytest.fixture(scope="module")
def texts(odd_texts):
    random_ = random.Random(4)
    return [*odd_texts, *("".join(random_.choice("ab é\U0001f600") for _ in range(n)) for n in range(0, 60, 3)), "aaaa" * 30, "abc" * 40]


def grams(spark, texts, k):
    """The hashes of all k-grams of each text, by Spark's own hash of the same bytes."""
    parts = [(i, j, t[j : j + k].encode("utf-32-be")) for i, t in enumerate(texts) for j in range(max(1 if t else 0, len(t) - k + 1))]
    found = {}
    for r in spark.createDataFrame(parts, "i long, j long, b binary").select("i", "j", F.hash("b").alias("h")).collect():
        found.setdefault(r.i, {})[r.j] = r.h & 0xFFFFFFFF
    return [[h for _, h in sorted(found.get(i, {}).items())] for i in range(len(texts))]


@pytest.mark.parametrize(("k", "window"), [(16, 32), (5, 4), (3, 7), (2, 1)])
def test_brute_force(spark, documents, texts, k, window, monkeypatch):
    monkeypatch.setattr(N, "PIECE", 50)  # many pieces
    short = [t for t in texts if t is None or len(t) < 1000]
    table = documents(*enumerate(short)).withColumn("fp", N.fingerprints(F.col("text"), k, window))
    got = dict(rows(table.select("doc_id", F.arrays_zip(N.hashes(F.col("fp")).alias("h"), N.positions(F.col("fp")).alias("p")).alias("fp")), "doc_id", "fp"))
    for i, hashes in enumerate(grams(spark, [t or "" for t in short], k)):
        assert [tuple(x) for x in got[i]] == (selected(hashes, window) if hashes else [])


def test_guarantee(documents):
    """Texts that share a run of window + k - 1 code points share a fingerprint."""
    run = " ".join(words(5, 30))[: N.K + N.WINDOW - 1]
    table = documents(*((i, " ".join(words(50 + i, 40)) + run + " ".join(words(80 + i, 40))) for i in range(20)))
    found = [set(r[0]) for r in table.select(N.hashes(N.fingerprints(F.col("text")))).collect()]
    assert set.intersection(*found)


def test_compared(documents, texts, monkeypatch):
    table = [(i * 7 % 41 if i != 4 else None, t) for i, t in enumerate(texts)] + [(3, "tie b"), (3, "tie a")]
    got = N.compared(documents(*table)).collect()
    assert len(got) == len(table)
    order = sorted(((d, t or "") for d, t in table), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = []
    for (d, t), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        third = len(t) // 3
        want.append((d, len(t), hashlib.sha256((t[: len(t) - third] + after[:third]).encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_chars, hashlib.sha256(r.edited.encode()).hexdigest()) for r in got), key=str) == sorted(want, key=str)
    by_text = {}
    for r in got:
        own, edited = {x >> 31 for x in r.fingerprint}, {x >> 31 for x in r.edited_fingerprint}
        near = len(own & edited) / len(own | edited) if own | edited else 1.0
        assert abs(r.near_edited - near) < 1e-12 and 0 <= r.near_next <= 1
        by_text.setdefault((r.doc_id, r.n_chars), r)
    assert all(r.near_edited == 1 for r in got if r.n_chars < 3)


@pytest.mark.parametrize(("k", "window"), [(16, 32), (5, 4), (3, 7), (2, 1)])
def test_only_the_edited_part_is_hashed_again(spark, texts, k, window):
    """Equal to the fingerprint from scratch, whatever is kept."""
    random_, pairs = random.Random(6), []
    long = [" ".join(words(60 + i, 20 + 9 * i)) for i in range(15)]
    for t in [*(t or "" for t in texts if t is None or len(t) < 2000), *long] * 3:
        kept = random_.choice([len(t), len(t) - len(t) // 3, random_.randrange(len(t) + 1)])
        pairs.append((t, kept, t[:kept] + random_.choice(texts[-20:])[: random_.randrange(60)]))
    df = spark.createDataFrame(pairs, "text string, kept int, edited string")
    again = N.refingerprinted(F.col("edited"), F.col("kept"), N.fingerprints(F.col("text"), k, window), k, window)
    found = df.select("kept", "edited", again.alias("again"), N.fingerprints(F.col("edited"), k, window).alias("whole")).collect()
    assert [r for r in found if r.again != r.whole] == [] and sum(len(r.whole) > 3 for r in found) > 20


def test_likeness_of_neighbours(documents, texts):
    """near_next and edited_fingerprint by the definition, over the rows in order."""
    table = [(i, t) for i, t in enumerate([*texts, texts[-1], texts[8]])]
    got = {r.doc_id: r for r in N.compared(documents(*table)).collect()}
    direct = {r.doc_id: r.fp for r in documents(*[(i, got[i].edited) for i in got]).select("doc_id", N.fingerprints(F.col("text")).alias("fp")).collect()}
    for i in got:
        own, after = ({x >> 31 for x in got[j].fingerprint} for j in (i, (i - 1) % len(got)))
        assert got[i].edited_fingerprint == direct[i]
        assert abs(got[i].near_next - (len(own & after) / len(own | after) if own | after else 1.0)) < 1e-12


def test_neighbours_over_many_ranges(spark):
    rows_ = spark.range(500).selectExpr("(id * id * 31) % 10007 doc_id", "cast(id as string) text").dropDuplicates(["doc_id"])
    got = {r.doc_id: r.next_doc_id for r in N.with_next(rows_, ["doc_id"]).collect()}
    order = sorted(got, reverse=True)
    assert got == dict(zip(order, order[1:] + order[:1], strict=True))


def test_small_tables(documents):
    assert N.compared(documents()).collect() == []
    one = N.compared(documents((1, "only one document here"))).collect()[0]
    assert one.near_next == 1.0 and one.edited == "only one document here"[:15] + "only on"
    assert rows(N.compared(documents((None, None), (None, None))), "doc_id", "n_chars", "near_next") == [(None, 0, 1.0)] * 2
