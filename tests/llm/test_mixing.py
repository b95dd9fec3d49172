import collections

import numpy as np
from conftest import rows

from reelmart.llm import mixing as M

from .conftest import words


def test_targets():
    assert M.targets({"a": 100, "b": 100, "c": 100}) == {"a": 200.0, "b": 250 / 3, "c": 500 / 3}
    assert M.targets({"b": 10, None: 10, "a": 1000}) == {"a": 1490.0, "b": 20.0, None: 20.0}
    full = M.targets({"a": 1, "b": 1000, "c": 10, None: 0})
    assert full["a"] == 2.0 and full["c"] == 20.0 and full[None] == 0.0
    assert abs(sum(full.values()) - 1.5 * 1011) < 1e-6
    assert M.targets({}) == {} and M.targets({None: 0}) == {None: 0.0}


def test_permutation():
    for n in (1, 2, 3, 5, 64, 1000):
        assert sorted(M.permuted(np.arange(n), n, 7).tolist()) == list(range(n))
    assert M.permuted(np.arange(1000), 1000, 7).tolist() != M.permuted(np.arange(1000), 1000, 8).tolist()


def test_draws_meet_the_quotas():
    quotas = np.array([900, 1, 0, 99])
    counts = M.draw(quotas, 64, 3)
    assert counts.sum(0).tolist() == quotas.tolist()
    assert counts.sum(1)[:-1].tolist() == [64] * (len(counts) - 1)
    assert len(set(counts[:, 0].tolist())) > 3  # random, not even


def table():
    out = [(i, " ".join(words(i, 30 + 17 * (i % 9))), None, f"s{i % 3}" if i % 7 else None) for i in range(120)]
    return [*out, (3, None, None, "s0"), (4, "", None, "s0"), (4, "", None, "s0"), (None, "lost words", None, "s1"), (9, out[9][1], None, out[9][3]), (500, " ".join(words(5, 30_000)), None, "s2"), (501, "x", None, "z")]


def test_taken(documents):
    mine = table()
    got = M.Mix(documents(*mine), block_words=16).taken().collect()
    size = lambda t: len((t or "").encode().split())
    assert sorted(((r.doc_id, r.size) for r in got), key=str) == sorted(((d, size(t)) for d, t, _, _ in mine), key=str)
    sizes = collections.Counter()
    for _, t, _, s in mine:
        sizes[s] += size(t)
    want = M.targets(dict(sizes))
    by_target = collections.defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        by_target[r.source_size, round(r.target, 6)] += r.taken
    assert set(by_target) == {(sizes[s], round(want[s], 6)) for s in sizes}
    for (_, target), taken in by_target.items():
        assert abs(taken - target) <= max(24, 0.02 * target)
    again = M.Mix(documents(*reversed(mine)), block_words=16).taken().collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_every_block_is_used_as_often_as_its_pass(documents):
    mix = M.Mix(documents(*table()), block_words=16)
    uses = collections.Counter((r.source, r.block) for r in mix.uses().collect())
    for source in mix.order:
        times = [uses[source, b] for b in range(mix.blocks(source))]
        assert sum(times) == mix.quota(source) and (not times or max(times) - min(times) <= 1)


def test_mixed_documents_carry_the_words_taken(documents):
    mine = documents(*table())
    taken = M.Mix(mine, block_words=16).taken().collect()
    mixed = M.mixed_documents(mine, block_words=16)
    assert mixed.columns == mine.columns
    out = mixed.collect()
    want, have = collections.Counter(), collections.Counter()
    for r in taken:
        want[r.doc_id] += r.taken
    for r in out:
        have[r.doc_id] += len(r.text.split())
        assert r.n_chars == len(r.text) and r.digest == "clash"
    assert {k: v for k, v in want.items() if v} == dict(have)
    texts = {(d, t) for d, t, _, _ in table()}
    assert any((r.doc_id, r.text) in texts for r in out)


def test_empty(documents):
    assert M.Mix(documents()).taken().collect() == []
    assert M.mixed_documents(documents()).collect() == []
    assert rows(M.Mix(documents((1, None), (2, ""))).taken(), "doc_id", "taken", "target") == sorted([(1, 0, 0.0), (2, 0, 0.0)], key=str)


def test_equal_rows_are_not_collected(documents):
    mine = documents(*[(1, "a b c d e", None, "s")] * 60, *[(None, "f g h", None, None)] * 9, (2, "i j", None, "s"))
    mixed = M.mixed_documents(mine, block_words=4)
    assert "copies" not in mixed._jdf.queryExecution().optimizedPlan().toString()
    want, have = collections.Counter(), collections.Counter()
    for r in M.Mix(mine, block_words=4).taken().collect():
        want[r.doc_id] += r.taken
    for r in mixed.collect():
        have[r.doc_id] += len(r.text.split())
    assert have == want
