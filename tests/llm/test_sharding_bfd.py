import collections
import random
import zlib

import pytest

from reelmart.llm import sharding_bfd as B

from .conftest import words


def naive(sizes, capacity):
    """Best fit by trying every bin."""
    rooms, out = [], []
    for size in sizes:
        fits = [(room, i) for i, room in enumerate(rooms) if room >= size]
        i = min(fits)[1] if fits else len(rooms)
        if not fits:
            rooms.append(max(capacity, size))
        rooms[i] -= size
        out.append(i)
    return out


@pytest.mark.parametrize("seed", range(5))
def test_tree_is_best_fit_decreasing(seed):
    random_ = random.Random(seed)
    sizes = sorted((random_.randrange(1, 120) for _ in range(400)), reverse=True)
    assert B.pack(sizes, 100) == naive(sizes, 100)


def test_nodes_of_taken_bins_serve_again():
    random_ = random.Random(3)
    packing = B.Packing(1000)
    for size in sorted((random_.randrange(1, 400) for _ in range(20_000)), reverse=True):
        packing.put(size)
    nodes = len(packing.open.room) - 1
    assert nodes <= len(packing.loads) and nodes == len(packing.open.free) + sum(load < 1000 for load in packing.loads)


def test_fixed_number_of_bins_is_even():
    random_ = random.Random(1)
    sizes = sorted((random_.randrange(1, 1000) for _ in range(3000)), reverse=True)
    loads = collections.Counter()
    for size, bin_ in zip(sizes, B.pack_into(sizes, 16), strict=True):
        loads[bin_] += size
    assert len(loads) == 16 and max(loads.values()) - min(loads.values()) < 0.01 * sum(sizes) / 16


def test_large_groups_stand_alone_and_the_rest_is_even():
    sizes = [1000, *[10] * 60]
    loads = collections.Counter()
    for size, bin_ in zip(sizes, B.pack_into(sizes, 4), strict=True):
        loads[bin_] += size
    assert sorted(loads.values()) == [200, 200, 200, 1000]
    assert B.pack_into([], 4) == [] and B.pack_into([5, 5], 4) == [0, 1] and sorted(B.pack_into([3, 3], 1)) == [0, 0]


def table(odd_texts):
    out = [(i, " ".join(words(i % 50, 20 + i % 30))) for i in range(300)] + [(1000 + i, "the same text") for i in range(200)]
    return [*out, *((2000 + i, t) for i, t in enumerate(odd_texts) if t is None or len(t) < 100), (None, "no id"), (900, "twice"), (900, "twice")]


def test_shards(documents, odd_texts):
    mine = table(odd_texts)
    got = B.shard_sizes(documents(*mine)).collect()
    size = lambda t: len((t or "").encode()) + 1
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=str) == sorted(((d, size(t), zlib.crc32((t or "").encode())) for d, t in mine), key=str)
    of, slots, loads = {}, collections.defaultdict(list), collections.Counter()
    text = dict(mine)
    for r in got:
        assert of.setdefault(text[r.doc_id] or "", r.shard) == r.shard  # equal texts together
        slots[r.shard].append(r.slot)
        loads[r.shard] += r.size
        assert r.law == "bytes" and r.grown_shard is None
    assert set(slots) <= set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(collections.Counter(text[d] or "" for d, _ in mine).items(), key=lambda x: x[1] * size(x[0]))
    assert max(loads.values()) <= max(1.1 * sum(loads.values()) / 16, largest[1] * size(largest[0]) * 1.05)
    again = B.shard_sizes(documents(*reversed(mine))).collect()
    assert {(r.doc_id, r.shard) for r in again} == {(r.doc_id, r.shard) for r in got}


def test_fixed_capacity_and_columns(documents, odd_texts):
    mine = documents(*table(odd_texts))
    out = B.sharded(mine, shards=None, capacity=5_000)
    assert out.columns == [*(c for c in mine.columns if c != "shard"), "shard"]
    loads = collections.Counter()
    for r in out.collect():
        loads[r["shard"]] += len((r.text or "").encode()) + 1
    total = sum(loads.values())
    assert sorted(loads.values())[-2] <= 5_000 * 1.01 and len(loads) <= 2 * total / 5_000 + 2


def test_empty(documents):
    assert B.shard_sizes(documents()).collect() == [] and B.sharded(documents()).collect() == []


@pytest.mark.parametrize("capacity", [100, 1500, 10**9])
def test_capacity_over_many_cells(documents, capacity):
    """Nearly no more shards than one packing of all groups needs; none above the capacity but single large groups."""
    random_ = random.Random(4)
    table = [(i, "x" * random_.randrange(0, 90) + str(i)) for i in range(2000)] + [(5000, "long " * 40), (5001, None)]
    got = B.sharded(documents(*table), None, capacity).select("doc_id", "shard").collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in table)
    size = {i: len(t or "") + 1 for i, t in table}
    loads = collections.Counter()
    for r in got:
        loads[r.shard] += size[r.doc_id]
    assert sorted(loads) == list(range(len(loads)))
    assert all(load <= capacity for load in loads.values() if load != size[5000])
    assert len(loads) <= 1.1 * (max(B.pack(sorted(size.values(), reverse=True), capacity)) + 1)
