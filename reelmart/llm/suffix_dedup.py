"""Removal of repeated byte strings: every byte covered by a string of ``window`` bytes that also starts in a document
with a smaller doc_id.

Suffixes are sorted by a mergesort that compares two of them by their common extension, found by binary search over
polynomial prefix hashes modulo 2**31 - 1; neighbours that agree for ``window`` bytes are the repeats. After a sort every
neighbouring pair is compared byte by byte, and a sort that a collision has spoilt is done again with another base, so
hashes never decide a result.

Only suffixes that can repeat are sorted, and only beside those they can equal. The key of a window is the least hash of
its grams; consecutive windows with one key form a run, sent as one string. A chunk of documents sends each key once
(a few bits come back: whether other documents have it), then the distinct strings of shared keys. All equal windows
have one key, so each key is a sort of its own, and so is each place of the key's gram within the window. Keys of many
different strings (the ends of a passage that a third of the documents share) are dealt out once more, every window by
its own hash, so no group grows with the table: a chunk sends equal strings once.
Texts that equal an earlier text as a whole are settled by their SHA-256 and not sorted at all.

Documents are dealt to chunks by ranges of doc_id and written once, bucketed by chunk, in the shared folder; later passes
read a chunk beside the answers for it without moving texts.

Defined cases: a null text is empty; a text shorter than a window is kept; a null doc_id counts as the smallest; rows of
equal doc_id don't remove each other's bytes; repeats within one document stay; what is kept may cut a character, so it
is binary; an empty table gives an empty result; extra columns are left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelmart.llm.scratch import partitions, written, written_by
from reelmart.llm.text import mix, utf8, window_hashes, word_hashes

_U = np.uint64
_PRIME = (1 << 31) - 1
_P, _SHIFT = _U(_PRIME), _U(31)
#: Bases of the polynomial hashes, tried one after another.
_BASES = (1_103_515_245, 1_812_433_253 % _PRIME, 69_069, 1_664_525)

#: Of a key in a chunk: how many different strings have it, up to a bound, and whether several documents do.
_ENTRY = np.dtype([("key", "<u4"), ("strings", "<u2")])
_SEVERAL = 1 << 15
#: Window starts that are hashed at a time, so that memory doesn't grow with a text's length.
_PIECE = 1 << 20
_ANCHORS, _WINDOWS, _COPIES = 0, 1, 2


def _mod(x: np.ndarray) -> np.ndarray:
    """Numbers below 2**63 modulo the prime."""
    x = (x & _P) + (x >> _SHIFT)
    x = (x & _P) + (x >> _SHIFT)
    return np.where(x >= _P, x - _P, x)


def _powers(base: int, n: int) -> np.ndarray:
    out, done = np.ones(max(n, 1), _U), 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = _mod(out[:more] * _U(base))
        base, done = base * base % _PRIME, done + more
    return out


class PrefixHashes:
    """Polynomial hashes of all prefixes of a byte string, and with them the common extension of any two places."""

    def __init__(self, data: np.ndarray, base: int = _BASES[0]):
        self.down = _powers(pow(base, -1, _PRIME), len(data) + 1)
        self.sums = np.zeros(len(data) + 1, _U)
        np.cumsum(_mod((data.astype(_U) + _U(1)) * _powers(base, len(data))[: len(data)]), out=self.sums[1:])
        self.sums = _mod(self.sums)

    def common(self, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
        """How many bytes, ``most`` at most, agree from each place of a and of b on."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), most)
        at_a, at_b, down_a, down_b = self.sums[a], self.sums[b], self.down[a], self.down[b]
        for _ in range(most.bit_length()):
            middle = (low + high + 1) >> 1
            one = _mod((self.sums[a + middle] + _P - at_a) * down_a)
            other = _mod((self.sums[b + middle] + _P - at_b) * down_b)
            same = one == other
            low, high = np.where(same, middle, low), np.where(same, high, np.maximum(middle - 1, low))
        return low


def _merge_sorted(data: np.ndarray, hashes: PrefixHashes, at: np.ndarray, group: np.ndarray, most: int) -> np.ndarray:
    """The order of the suffixes ``at`` by their first ``most`` bytes within their groups, which are given one by one.

    A bottom-up mergesort of all groups at once: in a merge, each suffix finds by binary search how many of the other
    run come before it.
    """
    order, n = np.arange(len(at)), len(at)
    new = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if n else np.zeros(0, np.int64)
    sizes = np.diff(np.append(new, n))
    first, end = np.repeat(new, sizes), np.repeat(new + sizes, sizes)
    run = 1
    while n and run < int(sizes.max()):
        place = np.arange(n)
        mine = (place - first) // run
        other = first + (mine ^ 1) * run
        active = np.flatnonzero(other < end)
        low, high = other[active], np.minimum(other[active] + run, end[active])
        left, base, a = mine[active] % 2 == 0, low.copy(), at[order[active]]
        for _ in range(run.bit_length()):
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) >> 1
            x, y = a[open_], at[order[middle]]
            length = hashes.common(x, y, most)
            inside = np.minimum(length, most - 1)
            before = np.where(length == most, ~left[open_], data[y + inside] < data[x + inside])
            low[open_] = np.where(before, middle + 1, low[open_])
            high[open_] = np.where(before, high[open_], middle)
        to = place.copy()
        to[active] = np.where(left, place[active], place[active] - run) + (low - base)
        merged = np.empty_like(order)
        merged[to] = order
        order, run = merged, run * 2
    return order


def _neighbours(data: np.ndarray, x: np.ndarray, y: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """By the bytes themselves: which pairs of places agree for ``most`` bytes, and which are in falling order."""
    equal, falls = np.ones(len(x), bool), np.zeros(len(x), bool)
    wide = np.ndarray(max(len(data) - 7, 0), ">u8", data.tobytes(), strides=(1,))
    for offset in [*range(0, most - 7, 8), most - 8]:
        a, b = wide[x + offset], wide[y + offset]
        falls |= equal & (a > b)
        equal &= a == b
    return equal, falls


def suffix_sort(data: np.ndarray, at: np.ndarray, group: np.ndarray, most: int, bases: tuple[int, ...] = _BASES) -> tuple[np.ndarray, np.ndarray]:
    """The order of the suffixes by their first ``most`` bytes (8 at least, all inside the data) within their groups,
    and for each place in that order whether it has the same bytes and group as the place before it."""
    for base in bases:
        order = _merge_sorted(data, PrefixHashes(data, base), at, group, most)
        x, y, together = at[order[:-1]], at[order[1:]], group[order[1:]] == group[order[:-1]]
        equal, falls = _neighbours(data, x, y, most)
        if not (falls & together).any():  # else hashes collided
            return order, np.append(False, equal & together)[: len(order)]
    raise RuntimeError("the prefix hashes of all bases collide")


def _spread(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... counts[0] numbers, then those of the next."""
    return np.arange(int(counts.sum())) + np.repeat(first - np.append(0, np.cumsum(counts)[:-1])[: len(counts)], counts)


def _equal_spans(data: np.ndarray, x: np.ndarray, y: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Which pairs of spans of one length hold the same bytes."""
    differ = data[_spread(x, lengths)] != data[_spread(y, lengths)]
    total = np.append(0, np.cumsum(differ))
    ends = np.cumsum(lengths)
    return total[ends] == total[ends - lengths]


def _distinct(data: np.ndarray, ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The strings ordered by id, and which of that order differ from the one before; equal ones keep their order."""
    order = np.lexsort((hashes, lengths, ids))
    new = np.ones(len(order), bool)
    same = (ids[order[1:]] == ids[order[:-1]]) & (lengths[order[1:]] == lengths[order[:-1]]) & (hashes[order[1:]] == hashes[order[:-1]])
    pairs = np.flatnonzero(same)
    if len(pairs):
        a, b = order[pairs], order[pairs + 1]
        new[pairs[_equal_spans(data, starts[a], starts[b], lengths[a])] + 1] = False
    return order, new


class Chunk:
    """The documents of a chunk, in order of doc_id, and the runs of their windows."""

    def __init__(self, number: int, table: pa.Table, copies: set[bytes], window: int, gram: int, buckets: int):
        self.number, self.window, self.gram, self.buckets = number, window, gram, buckets
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")]) if len(table) else table
        if nulls := table.column("doc_id").null_count:  # Arrow sorts them last
            table = table.take(pa.array(np.roll(np.arange(len(table)), nulls)))
        self.ids = table.column("doc_id").combine_chunks()
        self.data, self.offsets = utf8(table.column("text").combine_chunks())
        n = len(table)
        known = pc.fill_null(pc.not_equal(self.ids[1:], self.ids[:-1]), False).to_numpy(zero_copy_only=False) if n else np.zeros(0, bool)
        null = self.ids.is_null().to_numpy(zero_copy_only=False)
        self.rank = np.cumsum(np.append(False, known | (null[1:] != null[:-1]))[:n]) + (number << 40)
        self.copy, firsts = np.zeros(n, bool), {}
        for row in np.flatnonzero(np.diff(self.offsets) >= window):
            digest = hashlib.sha256(self.data[self.offsets[row] : self.offsets[row + 1]]).digest()
            self.copy[row] = digest in copies or firsts.setdefault(digest, self.rank[row]) < self.rank[row]
        parts = [self._runs(lo) for lo in range(int(self.offsets[0]), int(self.offsets[-1]) - window + 1, _PIECE)]
        join = lambda i, kind: np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, kind)
        self.start, self.count, self.key, self.row = join(0, np.int64), join(1, np.int64), join(2, _U), join(3, np.int64)

    def _runs(self, lo: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Start, number of windows, key and row of the runs of windows that begin in a piece."""
        n = min(_PIECE, int(self.offsets[-1]) - self.window + 1 - lo)
        part = self.data[lo : lo + n + self.window - 1]
        least = window_hashes(part, np.arange(len(part) - self.gram + 1), self.gram)
        wide, reach = self.window - self.gram + 1, 1
        while reach * 2 <= wide:
            least, reach = np.minimum(least[: len(least) - reach], least[reach:]), reach * 2
        least = np.minimum(least[:n], least[wide - reach : wide - reach + n])
        first = int(np.searchsorted(self.offsets, lo, "right")) - 1
        last = int(np.searchsorted(self.offsets, lo + n, "left"))
        inside = np.minimum(self.offsets[first + 1 : last + 1], lo + n) - np.maximum(self.offsets[first:last], lo)
        row = np.repeat(np.arange(first, last), inside)
        fits = (np.arange(lo, lo + n) + self.window <= self.offsets[row + 1]) & ~self.copy[row]
        begin = fits.copy()
        begin[1:] &= (least[1:] != least[:-1]) | (row[1:] != row[:-1]) | ~fits[:-1]
        at = np.flatnonzero(begin)
        total = np.append(0, np.cumsum(fits))
        counts = np.diff(total[np.append(at, n)])
        return at + lo, counts, self._id(mix(least[at])), row[at]

    def _id(self, key: np.ndarray) -> np.ndarray:
        """The bucket of a key above 32 more of its bits."""
        bucket = ((key >> _U(32)) * _U(self.buckets)) >> _U(32)
        return (bucket << _U(32)) | (key & _U(0xFFFFFFFF))

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct keys, sorted; how many different strings have each, told apart by their ends and lengths; and
        whether several documents have it."""
        last = self.start + self.count + self.window - 9
        wide = np.ndarray(max(len(self.data) - 7, 0), "<u8", np.ascontiguousarray(self.data), strides=(1,))
        ends = mix(wide[self.start] + self.count.astype(_U)) ^ wide[last]
        order = np.lexsort((ends, self.key))
        key, ends, rank = self.key[order], ends[order], self.rank[self.row[order]]
        new = np.append(True, key[1:] != key[:-1])[: len(key)]
        strings = new | np.append(True, ends[1:] != ends[:-1])[: len(key)]
        first = np.flatnonzero(new)
        if not len(first):
            return key, first, np.zeros(0, bool)
        several = np.minimum.reduceat(rank, first) < np.maximum.reduceat(rank, first)
        return key[first], np.add.reduceat(strings.astype(np.int64), first), several

    def strings(self, bits: dict[int, bytes]) -> Strings:
        keys = np.unique(self.key)
        buckets, sizes = np.unique(keys >> _U(32), return_counts=True)
        both = [np.unpackbits(np.frombuffer(bits[int(b)], np.uint8)).reshape(2, -1)[:, :n] for b, n in zip(buckets, sizes, strict=True)]
        shared, hot = np.concatenate(both, axis=1).astype(bool) if both else np.zeros((2, 0), bool)
        place = np.searchsorted(keys, self.key)
        return Strings(self, np.flatnonzero(shared[place] & ~hot[place]), np.flatnonzero(shared[place] & hot[place]))


class Strings:
    """The strings of a chunk's shared runs, one for each window where the key is hot, and the distinct ones of them."""

    def __init__(self, chunk: Chunk, runs: np.ndarray, hot: np.ndarray):
        windows = _spread(chunk.start[hot], chunk.count[hot])
        start = np.concatenate([chunk.start[runs], windows])
        count = np.concatenate([chunk.count[runs], np.ones(len(windows), np.int64)])
        row = np.concatenate([chunk.row[runs], np.repeat(chunk.row[hot], chunk.count[hot])])
        single = np.append(np.zeros(len(runs), bool), np.ones(len(windows), bool))
        id_ = np.concatenate([chunk.key[runs], np.zeros(len(windows), _U)])
        order = np.argsort(start, kind="stable")
        self.start, self.count, row, single, id_ = (x[order] for x in (start, count, row, single, id_))
        self.rank = chunk.rank[row]
        length = self.count + chunk.window - 1
        hashes = word_hashes(chunk.data, self.start, self.start + length)
        id_[single] = chunk._id(mix(hashes[single]))
        order, new = _distinct(chunk.data, id_, self.start, length, hashes)
        self.first = order[new]  # of each distinct string, the one of the least doc_id
        self.which = np.zeros(len(order), np.int64)
        self.which[order] = np.cumsum(new) - 1
        self.id, self.length, self.data = id_[self.first], length[self.first], chunk.data

    def sent(self, chunk: int) -> pa.Table:
        buckets, ends = _cut(self.id)
        low = (self.id & _U(0xFFFFFFFF)).astype("<u4")
        columns = {"ids": low, "lengths": self.length.astype("<u4"), "ranks": self.rank[self.first].astype("<i8")}
        out = {name: [x[a:b].tobytes() for a, b in ends] for name, x in columns.items()}
        texts = [self.data[_spread(self.start[self.first[a:b]], self.length[a:b])].tobytes() for a, b in ends]
        return pa.table({"bucket": pa.array(buckets), "chunk": pa.array(np.full(len(buckets), chunk, np.int64)), **{n: pa.array(x, pa.binary()) for n, x in out.items()}, "texts": pa.array(texts, pa.binary())})

    def repeats(self, window: int, bits: dict[int, bytes]) -> np.ndarray:
        """The starts of windows whose bytes also start in a document with a smaller doc_id."""
        count = self.count[self.first]
        buckets, ends = _cut(self.id)
        parts = [np.unpackbits(np.frombuffer(bits[int(b)], np.uint8), count=int(count[x:y].sum())) for b, (x, y) in zip(buckets, ends, strict=True)]
        flags = np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)
        offset = np.append(0, np.cumsum(count)[:-1])[: len(count)]
        later = self.rank > self.rank[self.first[self.which]]
        starts = _spread(self.start, self.count)
        return starts[flags[_spread(offset[self.which], self.count)] | np.repeat(later, self.count)]


def _cut(ids: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The buckets of sorted ids and where each begins and ends."""
    buckets, first = np.unique(ids >> _U(32), return_index=True)
    return buckets.astype(np.int64), list(zip(first.tolist(), [*first[1:].tolist(), len(ids)][: len(first)], strict=True))


def _answer(kind: int, table: pa.Table, bits: list[bytes]) -> pa.Table:
    n = len(table)
    return pa.table({"chunk": table.column("chunk"), "kind": pa.array([kind] * n, pa.int32()), "bucket": table.column("bucket"), "bits": pa.array(bits, pa.binary())})


def _shared(table: pa.Table, most: int) -> pa.Table:
    """For each key of each chunk of a bucket: whether several documents have it, and whether it is hot."""
    entries = [np.frombuffer(x.as_buffer(), _ENTRY) for x in table.column("entries")]
    ends = np.cumsum([len(e) for e in entries])
    every = np.concatenate(entries)
    _, which, chunks = np.unique(every["key"], return_inverse=True, return_counts=True)
    strings = np.bincount(which, weights=every["strings"] & (_SEVERAL - 1))[which]
    shared = (chunks[which] > 1) | (every["strings"] >= _SEVERAL)
    hot = strings > most
    return _answer(_ANCHORS, table, [np.packbits(shared[e - len(x) : e]).tobytes() + np.packbits(hot[e - len(x) : e]).tobytes() for x, e in zip(entries, ends, strict=True)])


def _batches(many: np.ndarray, group: np.ndarray, windows: np.ndarray) -> Iterator[np.ndarray]:
    """The strings that aren't alone in their groups: whole groups, and about a piece of windows at a time."""
    while len(many):
        last = max(int(np.searchsorted(np.cumsum(windows[many]), _PIECE)), 1)
        last = int(np.searchsorted(group[many], group[many[last - 1]], "right"))
        yield many[:last]
        many = many[last:]


def _places(text: np.ndarray, at: np.ndarray, window: int, gram: int) -> np.ndarray:
    """Where in each window its gram of the least hash is, the first of equals: the same for equal windows."""
    bits, reach, wide = _U(len(text).bit_length()), 1, window - gram + 1
    grams = window_hashes(text, np.arange(len(text) - gram + 1), gram)
    least = (grams >> bits << bits) | np.arange(len(grams), dtype=_U)
    while reach * 2 <= wide:
        least, reach = np.minimum(least[: len(least) - reach], least[reach:]), reach * 2
    found = np.minimum(least[at], least[at + wide - reach])
    return (found & ((_U(1) << bits) - _U(1))).astype(np.int64) - at


def _earlier(table: pa.Table, window: int, gram: int) -> pa.Table:
    """For each window of each chunk's strings: whether it also starts in a document with a smaller doc_id."""
    column = lambda name, kind: np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in table.column(name)])
    ids, lengths, ranks = column("ids", "<u4"), column("lengths", "<u4").astype(np.int64), column("ranks", "<i8")
    data = column("texts", np.uint8)
    starts, counts = np.append(0, np.cumsum(lengths)[:-1]), lengths - window + 1
    order, new = _distinct(data, ids, starts, lengths, word_hashes(data, starts, starts + lengths))
    which = np.zeros(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    at = np.flatnonzero(new)
    own, least = order[at], np.minimum.reduceat(ranks[order], at)  # of the distinct strings: one of each, its least rank
    group = ids[own]
    alone = np.append(True, group[1:] != group[:-1]) & np.append(group[1:] != group[:-1], True)
    windows = counts[own]
    offset = np.append(0, np.cumsum(windows)[:-1])
    low = np.repeat(least, windows)  # of each window: the least rank of those that have it
    for some in _batches(np.flatnonzero(~alone), group, windows):
        text = data[_spread(starts[own[some]], lengths[own[some]])]
        first = np.append(0, np.cumsum(lengths[own[some]])[:-1])
        suffixes = _spread(first, windows[some])
        alike = np.repeat(group[some].astype(np.int64), windows[some]) * window + _places(text, suffixes, window, gram)
        by = np.argsort(alike, kind="stable")
        order, same = suffix_sort(text, suffixes[by], alike[by], window)
        by, begins = by[order], np.flatnonzero(~same)
        lowest = np.minimum.reduceat(np.repeat(least[some], windows[some])[by], begins)
        low[_spread(offset[some], windows[some])[by]] = np.repeat(lowest, np.diff(np.append(begins, len(by))))
    flags = low[_spread(offset[which], counts)] < np.repeat(ranks, counts)
    rows = np.cumsum([len(x.as_buffer()) // 4 for x in table.column("ids")])
    total = np.append(0, np.cumsum(counts))
    edges = total[np.append(0, rows)]
    return _answer(_WINDOWS, table, [np.packbits(flags[a:b]).tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)])


def _known(answers: pa.Table) -> tuple[set[bytes], dict[int, bytes], dict[int, bytes]]:
    """What came back for a chunk: digests of texts that an earlier chunk has, bits of its keys, bits of its windows."""
    out: list[dict] = [{}, {}, {}]
    for kind, bucket, bits in zip(*(answers.column(c).to_pylist() for c in ("kind", "bucket", "bits")), strict=True):
        out[kind][bits if kind == _COPIES else bucket] = bits
    return set(out[_COPIES]), out[_ANCHORS], out[_WINDOWS]


def without_repeats(docs: DataFrame, window: int = 50, gram: int = 24, chunk_bytes: int = 8 << 20, bucket_bytes: int = 2 << 20, hot: int = 1 << 10) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept: the bytes that stay, as binary.

    chunk_bytes, bucket_bytes: about how much text a chunk holds, and for how much text there is a bucket of keys; what
    tasks hold at a time follows from them, not from the table. hot: a key of more different strings is dealt out once
    more, by windows, so what one sort holds is bounded.
    """
    if not 8 <= gram <= window:
        raise ValueError("8 <= gram <= window")
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", "text")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks, buckets = (max(partitions(spark), -(-total // size)) for size in (chunk_bytes, bucket_bytes))
    dealt = docs.repartitionByRange(chunks, "doc_id").withColumn("chunk", F.spark_partition_id().cast("long"))
    texts = written_by(dealt, "bytes", "chunk", chunks)
    by_chunk = texts.groupBy("chunk")

    digests = texts.where(F.octet_length("text") >= window).select("chunk", F.unhex(F.sha2("text", 256)).alias("bits")).distinct()
    earliest = F.min("chunk").over(Window.partitionBy("bits"))
    copies = digests.withColumn("low", earliest).where("chunk > low").select("chunk", F.lit(_COPIES).alias("kind"), F.lit(0).cast("long").alias("bucket"), "bits")
    copies = written(copies, "copies")
    answer = "chunk long, kind int, bucket long, bits binary"

    def of(key: tuple, table: pa.Table, copied: set[bytes]) -> Chunk:
        return Chunk(key[0].as_py(), table, copied, window, gram, buckets)

    def anchors(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = of(key, table, _known(answers)[0])
        keys, different, several = chunk.anchors()
        entries = np.zeros(len(keys), _ENTRY)
        entries["key"], entries["strings"] = keys & _U(0xFFFFFFFF), np.minimum(different, _SEVERAL - 1) + several * _SEVERAL
        cut, ends = _cut(keys)
        blobs = [entries[a:b].tobytes() for a, b in ends]
        return pa.table({"bucket": pa.array(cut), "chunk": pa.array(np.full(len(cut), chunk.number, np.int64)), "entries": pa.array(blobs, pa.binary())})

    def strings(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        copied, bits, _ = _known(answers)
        chunk = of(key, table, copied)
        return chunk.strings(bits).sent(chunk.number)

    def kept(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        copied, bits, windows = _known(answers)
        chunk = of(key, table, copied)
        first, n = int(chunk.offsets[0]), int(chunk.offsets[-1] - chunk.offsets[0])
        edges = chunk.offsets - first
        at = chunk.strings(bits).repeats(window, windows) - first
        gone = np.zeros(n + 1, bool)
        step = np.zeros(n + 1, np.int32)
        np.add.at(step, at, 1)
        np.add.at(step, at + window, -1)
        gone[:n] = np.cumsum(step[:-1]) > 0
        gone[:n] |= np.repeat(chunk.copy, np.diff(edges))
        begins = gone.copy()
        inner = np.ones(n + 1, bool)
        inner[edges] = False  # a run ends where its document does
        begins[1:] &= ~(gone[:-1] & inner[1:])
        upto, runs = np.append(0, np.cumsum(gone[:n])), np.append(0, np.cumsum(begins[:n]))
        rest = chunk.data[first : first + n][~gone[:n]].tobytes()
        ends = (edges - upto[edges]).astype(np.int64)
        left = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(chunk.ids), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(rest)])
        counts = [pa.array(np.diff(x).astype(np.int64)) for x in (edges, upto[edges], runs[edges])]
        return pa.table({"doc_id": chunk.ids, **dict(zip(("n_bytes", "n_removed", "n_spans"), counts, strict=True)), "kept": left.cast(pa.binary())})

    sent = "bucket long, chunk long, entries binary"
    keys = by_chunk.cogroup(copies.groupBy("chunk")).applyInArrow(anchors, sent).groupBy("bucket").applyInArrow(lambda t: _shared(t, hot), answer)
    known = copies.union(written(keys, "keys"))
    sent = "bucket long, chunk long, ids binary, lengths binary, ranks binary, texts binary"
    found = by_chunk.cogroup(known.groupBy("chunk")).applyInArrow(strings, sent).groupBy("bucket").applyInArrow(lambda t: _earlier(t, window, gram), answer)
    result = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary"
    return by_chunk.cogroup(known.union(found).groupBy("chunk")).applyInArrow(kept, result)
