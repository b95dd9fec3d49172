import collections
import math

import pytest
import xxhash
from conftest import SMALL

import corpus_pipeline
from reelmart.llm import mixing
from reelmart.llm.decontaminate_tiling import tokens

from .test_decontaminate_tiling import naive
from .test_simhash_vptree import reach

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage returned, in order, after the documents themselves."""
    folder = tmp_path_factory.mktemp("pipeline")
    out = [spark.read.parquet(f"{SMALL}/documents.parquet")]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], SMALL).write.parquet(f"{folder}/{i}")
        out.append(spark.read.parquet(f"{folder}/{i}"))
    return [df.collect() for df in out]


def test_stages_and_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near duplicates", "decontamination", "mixing", "sharding"]
    assert all(list(r.asDict()) == COLUMNS for rows in stages[:-1] for r in rows[:1])
    assert list(stages[-1][0].asDict()) == [*COLUMNS, "shard"]


def test_language_keeps_documents_with_a_language(stages):
    before, after = ({r.doc_id for r in rows} for rows in stages[:2])
    assert after <= before and len(before - after) <= 0.01 * len(before)


def fingerprint(words):
    grams = {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    out = []
    for seed in range(42, 46):
        sums = [sum(xxhash.xxh64_intdigest(g, seed) >> b & 1 for g in grams) for b in range(64)]
        out.append(sum((2 * s > len(grams)) << b for b, s in enumerate(sums)))
    return out


def test_near_duplicates_are_similar(stages):
    """Whatever went shares most of its 5-word shingles with something that was there."""
    before, after = stages[1:3]
    shingles = {}
    for r in before:
        w = (r.text or "").lower().split()
        shingles[r.doc_id] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}
    gone = set(shingles) - {r.doc_id for r in after}
    for d in gone:
        assert max(len(shingles[d] & s) / len(shingles[d] | s) for e, s in shingles.items() if e != d) >= 0.6


def test_decontamination_by_all_pairs(spark, stages):
    before, after = stages[2:4]
    items = [tokens(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    grams = [{tuple(x[i : i + 5]) for i in range(len(x) - 4)} for x in items]
    leaks = set()
    for r in before:
        document = tokens(r.text)
        own = {tuple(document[i : i + 5]) for i in range(len(document) - 4)}
        near = [k for k, g in enumerate(grams) if g & own]
        if any(naive(items[k], document, 5) >= 0.6 * len(items[k]) for k in near):
            leaks.add(r.doc_id)
    assert {r.doc_id for r in after} == {r.doc_id for r in before} - leaks


def test_mixing_meets_its_targets(stages):
    before, after = stages[3:5]
    count = lambda rows: collections.Counter({s: sum(len(r.text.split()) for r in rows if r.source == s) for s in {r.source for r in rows}})
    want, have = mixing.targets(dict(count(before))), count(after)
    assert all(abs(have[s] - want[s]) <= max(64, 0.02 * want[s]) for s in want)
    assert {r.doc_id for r in after} <= {r.doc_id for r in before} and all(r.n_chars == len(r.text) for r in after)


def test_sharding_keeps_equal_texts_together(stages):
    before, after = stages[4:6]
    assert sorted((r.doc_id, r.text) for r in before) == sorted((r.doc_id, r.text) for r in after)
    shards = collections.defaultdict(set)
    for r in after:
        shards[r.text].add(r.shard)
    assert all(len(s) == 1 for s in shards.values()) and set().union(*shards.values()) == set(range(16))


def test_run_is_the_stages(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SMALL).collect())) == sorted(map(tuple, stages[-1]))


def test_stages_take_odd_tables(spark, documents, odd_texts):
    for docs in (documents(*enumerate(odd_texts), (3, odd_texts[3]), (None, None), clash=False), documents(clash=False)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SMALL)
            assert out.columns[: len(docs.columns)] == docs.columns
            out.count()


def test_near_duplicates_by_true_similarity(stages):
    """Links are shares of 0.8 of distinct 5-word shingles, whatever the fingerprints say."""
    before, after = stages[1:3]
    before = sorted(before, key=lambda r: r.doc_id)
    words = [(r.text or "").encode().lower().split() for r in before]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in words]
    linked = lambda i, j: len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8
    least = reach(sets, linked)
    assert {r.doc_id for r in after} == {before[i].doc_id for i in set(least)} and len(after) < len(before)
    # fingerprints say what to compare: their margin holds all pairs of that similarity
    share = math.acos(1.6 / 1.8) / math.pi
    spread = math.sqrt(share * (1 - share))
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if linked(i, j) and words[i] != words[j]]
    prints = {i: fingerprint(words[i]) for i in {i for pair in pairs for i in pair}}
    apart = [[bin(a ^ b).count("1") for a, b in zip(prints[i], prints[j], strict=True)] for i, j in pairs]
    assert pairs and all(a[0] <= 64 * share + 24 * spread and sum(a) <= 256 * share + 48 * spread for a in apart)
