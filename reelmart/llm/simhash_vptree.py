"""Near duplicates by SimHash fingerprints, linked exactly by a vantage-point tree.

Fingerprints are made where the texts lie; only distinct fingerprints move. The upper levels of the tree come from a
bounded sample (``sample``) and decide which shard a fingerprint lives in. A fingerprint within ``distance`` of a
boundary also visits the shard beyond it, so every pair within the distance meets in exactly one home. Each shard
grows its own tree and compares exactly what the triangle bounds leave. A shard returns a spanning forest of its
links, never all pairs of a group, and connected components are joined by alternating stars, each step written to
the shared folder.

``near_duplicates`` answers with fingerprints alone. ``deduplicated`` removes documents, so there fingerprints (of
distinct shingles) only say which documents to compare; links are decided by the shingles themselves.

Defined cases: a null text counts as empty; a text of no words has fingerprint zero and links like any other; fewer
words than a shingle are one shingle; rows with a null doc_id are linked too, but name a component only if it has no
other id (then null); repeated rows each return a row; an empty table gives an empty result; extra columns are left.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelmart.llm.scratch import written
from reelmart.llm.text import mix

SEED = 42


def _fingerprint(words: list[bytes], shingle: int, parts: int) -> list[int]:
    """``parts`` 64-bit fingerprints; the first is of XXH64 with seed 42, the others of further seeds."""
    n = len(words)
    if not n:
        return [0] * parts
    count = max(1, n - shingle + 1)
    columns = [islice(words, i, None) for i in range(shingle)]
    grams = map(b" ".join, zip(*columns, strict=False)) if n >= shingle else iter([b" ".join(words)])
    bits = np.zeros((parts, 64), np.int64)
    while batch := list(islice(grams, 1 << 16)):
        for part in range(parts):
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, batch, repeat(SEED + part)), np.uint64, len(batch))
            bits[part] += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.packbits(bits * 2 > count, axis=1, bitorder="little").view(np.int64).ravel().tolist()


def fingerprints(docs: DataFrame, shingle: int = 3, parts: int = 1) -> DataFrame:
    """doc_id, digest (of the text), size (words), fp0 .. fp<parts-1> (64 bits as a signed long) of every whole text."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, digest long, size long, " + ", ".join(f"fp{i} long" for i in range(parts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, found = [], []
            for text in batch.column("text"):
                words = (text.as_buffer().to_pybytes() if text.is_valid else b"").lower().split()
                sizes.append(len(words))
                found.append(_fingerprint(words, shingle, parts))
            columns = np.array(found, np.int64).reshape(-1, parts).T
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("digest"), pa.array(sizes, pa.int64()), *(pa.array(np.ascontiguousarray(c)) for c in columns)],
                names=["doc_id", "digest", "size", *(f"fp{i}" for i in range(parts))],
            )

    return docs.select("doc_id", F.xxhash64("text").alias("digest"), "text").mapInArrow(run, schema)


def shingles(text: pa.Scalar, shingle: int) -> np.ndarray:
    """The hashes of a text's distinct shingles, ascending."""
    words = (text.as_buffer().to_pybytes() if text.is_valid else b"").lower().split()
    columns = [islice(words, i, None) for i in range(shingle)]
    grams = map(b" ".join, zip(*columns, strict=False)) if len(words) >= shingle else iter([b" ".join(words)] if words else [])
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64))


def _set_fingerprint(found: np.ndarray, parts: int) -> list[int]:
    """``parts`` 64-bit fingerprints of distinct shingles, each counted once."""
    bits = np.zeros((parts, 64), np.int64)
    for first in range(0, len(found), 1 << 16):
        for part in range(parts):
            hashes = mix(found[first : first + (1 << 16)] + np.uint64(part * 0x9E3779B97F4A7C15 % (1 << 64)))
            bits[part] += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.packbits(bits * 2 > len(found), axis=1, bitorder="little").view(np.int64).ravel().tolist()


def set_fingerprints(docs: DataFrame, shingle: int, parts: int) -> DataFrame:
    """doc_id, digest (of the text), kind (of the set of shingles), size (of the set), fp0 .. fp<parts-1>."""
    names = [f"fp{i}" for i in range(parts)]
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, digest long, kind long, size long, " + ", ".join(f"{c} long" for c in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column("text"):
                own = shingles(text, shingle)
                kind = np.uint64(xxhash.xxh64_intdigest(own.tobytes(), SEED)).view(np.int64)
                found.append((int(kind), len(own), *_set_fingerprint(own, parts)))
            columns = np.array(found, np.int64).reshape(-1, parts + 2).T
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("digest"), *(pa.array(np.ascontiguousarray(c)) for c in columns)],
                names=["doc_id", "digest", "kind", "size", *names],
            )

    return docs.select("doc_id", F.xxhash64("text").alias("digest"), "text").mapInArrow(run, schema)


def _apart(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


class Tree:
    """The upper levels: at each node a vantage point and a radius; leaves are the shards."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.nodes: dict[int, tuple[np.uint64, int]] = {}
        self._grow(sample, depth, 1)

    def _grow(self, points: np.ndarray, depth: int, node: int) -> None:
        split = _split(points) if depth and len(points) > 1 else None
        if split is None:
            return
        self.nodes[node] = split
        near = _apart(points, split[0]) <= split[1]
        self._grow(points[near], depth - 1, 2 * node)
        self._grow(points[~near], depth - 1, 2 * node + 1)

    def place(self, points: np.ndarray, distance: int, home: bool = True) -> Iterator[tuple[int, np.ndarray, bool]]:
        """(shard, indexes, at home) for each shard that any point lives in or visits; guests visit only."""
        todo = [(1, np.arange(len(points)), home)]
        while todo:
            node, at, home = todo.pop()
            if not len(at):
                continue
            if node not in self.nodes:
                yield node, at, home
                continue
            vantage, radius = self.nodes[node]
            away = _apart(points[at], vantage).astype(np.int16)
            if home:
                todo += [(2 * node, at[away <= radius], True), (2 * node + 1, at[away > radius], True)]
                todo.append((2 * node + 1, at[(away <= radius) & (away > radius - distance)], False))
            else:
                todo += [(2 * node, at[away <= radius + distance], False), (2 * node + 1, at[away > radius - distance], False)]


def _split(points: np.ndarray) -> tuple[np.uint64, int] | None:
    """The vantage point, of a few, whose median splits the points most evenly; none if no distance differs."""
    best, share = None, 0
    for vantage in points[:: max(1, len(points) // 4)][:4]:
        away = _apart(points, vantage)
        for radius in {int(np.median(away)), int(np.median(away)) - 1}:
            near = int((away <= radius).sum())
            if min(near, len(points) - near) > share:
                best, share = (vantage, radius), min(near, len(points) - near)
    return best


class Forest:
    """Sets of linked items; links are given as one item and an array of its neighbours."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, at: np.ndarray) -> np.ndarray:
        up = self.parent[at]
        while True:
            higher = self.parent[up]
            if np.array_equal(higher, up):
                return up
            up = higher

    def join(self, at: np.ndarray) -> None:
        roots = self.roots(at)
        least = roots.min()
        self.parent[roots] = least
        self.parent[at] = least


#: Below so many comparisons a shard compares outright.
OUTRIGHT = 1 << 16


def link(points: np.ndarray, homes: int, distance: int, agree=None) -> Forest:
    """All links within a shard whose first ``homes`` points live there; visitors aren't compared with each other.

    agree(i, js): which of the points js within the distance of i are linked; all if not given.
    """
    forest = Forest(len(points))
    todo = [(np.arange(homes), np.arange(homes, len(points)))]
    while todo:
        own, guests = todo.pop()
        if not len(own):
            continue
        work = len(own) * (len(own) + len(guests))
        split = _split(points[own]) if work > OUTRIGHT else None
        if split is not None:
            vantage, radius = split
            a, g = _apart(points[own], vantage).astype(np.int16), _apart(points[guests], vantage).astype(np.int16)
            near = own[a <= radius], guests[g <= radius + distance]
            crossing = own[(a <= radius) & (a > radius - distance)]
            far = own[a > radius], np.concatenate([guests[g > radius - distance], crossing])
            if sum(len(x) * (len(x) + len(y)) for x, y in (near, far)) < 0.9 * work:  # else the bounds prune nothing
                todo += [near, far]
                continue
        both = np.concatenate([own, guests])
        values = points[both]
        step = max(1, (1 << 20) // len(both))
        for first in range(0, len(own), step):
            block = values[first : min(first + step, len(own))]
            close = _apart(block[:, None], values[None, first:]) <= distance
            close[np.arange(len(block)), np.arange(len(block))] = False
            for row in np.flatnonzero(close.any(1)):
                i, js = both[first + row], both[first + np.flatnonzero(close[row])]
                js = js if agree is None else js[agree(i, js)]
                if len(js):
                    forest.join(np.append(js, i))
    return forest


def links(
    points: DataFrame, distance: int, total: int | None = None, ratio: float | None = None, shard_rows: int = 4_000, sample: int = 1 << 15
) -> DataFrame:
    """(a, b) of ids of points: a spanning forest, shard by shard, of all links between points.

    points: id, size, fp0, ... ; distance: bits of fp0; total: bits of all fingerprints together; ratio: least ratio
    of sizes. With a ratio, points are first split into bands of sizes, and visit the next higher band. shard_rows:
    points of a shard, about, as far as the sample allows (the points that reach the driver: a bounded number, and an
    eighth of all at most, about).
    """
    names = [c for c in points.columns if c.startswith("fp")]
    step = -math.log(ratio) if ratio else 1.0
    band = F.floor(F.log(F.greatest("size", F.lit(0.5))) / step) if ratio else F.lit(0).cast("long")
    points = points.select("id", "size", band.alias("band"), *names)
    counts = points.groupBy("band").count().agg(F.max("count").alias("most"), F.sum("count").alias("all")).first()
    most, share = counts.most or 0, min(sample / max(1, counts["all"] or 0), 1 / 8)
    depth = max(0, min(int(math.log2(sample)) - 5, math.ceil(math.log2(max(1, most) / shard_rows))))
    chance = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 30)) / (1 << 30)  # about as many points as asked for
    picked = sorted(r.fp0 for r in points.where(chance < share).select("fp0").collect()) if depth else []
    tree = Tree(np.random.default_rng(0).permutation(np.array(picked, np.int64)).view(np.uint64), depth)
    columns = ["band", "shard", "guest", "id", "size", *names]
    schema = "band long, shard long, guest boolean, id long, size long, " + ", ".join(f"{c} long" for c in names)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp0").to_numpy(zero_copy_only=False).view(np.uint64)
            bands = batch.column("band").to_numpy(zero_copy_only=False)
            for up in (0, 1) if ratio else (0,):
                for shard, at, home in tree.place(fp, distance, home=not up):
                    kept = batch.take(pa.array(at))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(bands[at] + up), pa.array(np.full(len(at), shard)), pa.array(np.full(len(at), not home)), *(kept.column(c) for c in columns[3:])],
                        names=columns,
                    )

    def join(table: pa.Table) -> pa.Table:
        table = table.sort_by([("guest", "ascending"), ("id", "ascending")])
        fps = [table.column(c).to_numpy().view(np.uint64) for c in names]
        size, ids = table.column("size").to_numpy(), table.column("id").to_numpy()
        homes = len(table) - int(table.column("guest").to_numpy().sum())

        def agree(i: int, js: np.ndarray) -> np.ndarray:
            fine = np.ones(len(js), bool)
            if total is not None:
                fine &= sum(_apart(f[js], f[i]).astype(np.int32) for f in fps) <= total
            if ratio:
                fine &= np.minimum(size[js], size[i]) >= ratio * np.maximum(size[js], size[i])
            return fine

        root = link(fps[0], homes, distance, agree if total is not None or ratio else None).roots(np.arange(len(table)))
        least = ids.copy()  # of a set of linked points, at its root
        np.minimum.at(least, root, ids)
        other = np.flatnonzero(ids != least[root])
        return pa.table({"a": ids[other], "b": least[root[other]]})

    placed = points.mapInArrow(place, schema)
    return placed.groupBy("band", "shard").applyInArrow(join, "a long, b long").where("a <> b").distinct()


def _star(edges: DataFrame) -> DataFrame:
    """Every number of an edge points to the least of its smaller neighbours; edges (a, b) with a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a number points to the least of it and its neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _closed(edges: DataFrame) -> bool:
    """Whether all edges (a, b), a > b, distinct, are stars: every a has one edge, and no b is an a."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(edges.select("b", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1 and up > 0").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every number that has an edge (a, b); the root is the least number of its component.

    Where the edges are stars already, as those of components within one shard are, no step is taken.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _closed(edges):
        edges = written(_star(_large_star(edges)), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def grouped(prints: DataFrame, distance: int, total: int | None = None, ratio: float | None = None, **more) -> tuple[DataFrame, DataFrame]:
    """The distinct points (id, root, first, least) and the rows of prints with their point's id.

    first is the least doc_id of the point, least the least (no id, doc_id, digest); root is the same for all points
    that links reach. Rows of equal fingerprints (and sizes, if a ratio is given) are one point from the start.
    """
    point = [*(["size"] if ratio else []), *(c for c in prints.columns if c.startswith("fp"))]
    rows = prints.withColumn("id", F.xxhash64(*point) if len(point) > 1 else F.col(point[0]))
    points = rows.groupBy("id").agg(
        *(F.first(c).alias(c) for c in dict.fromkeys(["size", *point])),
        F.min("doc_id").alias("first"),
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("least"),
    )
    points = written(points, "points")
    roots = components(links(points, distance, total, ratio, **more))
    roots = roots.union(roots.select("root", "root")).distinct()
    points = points.select("id", "first", "least").join(roots, F.col("id") == F.col("node"), "left")
    return points.select("id", F.coalesce("root", "id").alias("root"), "first", "least"), rows


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """doc_id, fingerprint, component_id: the least doc_id that links reach."""
    points, rows = grouped(written(fingerprints(docs, shingle), "fingerprints"), distance)
    points = written(points, "roots")
    named = points.groupBy("root").agg(F.min("first").alias("component_id"))
    known = points.join(named, "root").select("id", "component_id")
    return rows.join(known, "id").select("doc_id", F.lower(F.lpad(F.hex("fp0"), 16, "0")).alias("fingerprint"), "component_id")


def alike(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """For each set the first of those that links reach; linked are two that share ``similarity`` of all their items.

    A set is compared with those not yet reached only, by the places of its items, so that a group of copies costs
    one comparison each.
    """
    n, sizes = len(sets), np.array([len(x) for x in sets], np.int64)
    items = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    order = np.argsort(items, kind="stable")
    items, owners = items[order], np.repeat(np.arange(n), sizes)[order]
    first, left, held = np.full(n, -1), n, n
    for start in range(n):
        if first[start] >= 0:
            continue
        first[start], todo, left = start, [start], left - 1
        while todo and left:
            i = todo.pop()
            if left < 0.5 * held:  # those reached need no comparison
                kept, held = first[owners] < 0, left
                items, owners = items[kept], owners[kept]
            lo, hi = np.searchsorted(items, sets[i], "left"), np.searchsorted(items, sets[i], "right")
            counts = hi - lo
            met = owners[np.repeat(lo - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())]
            js, shared = np.unique(met[first[met] < 0], return_counts=True)
            js = js[shared / (sizes[i] + sizes[js] - shared) >= similarity]
            first[js], left = start, left - len(js)
            todo += js.tolist()
    return first


def verified(docs: DataFrame, kinds: DataFrame, shingle: int, similarity: float, block_shingles: int = 1 << 21) -> DataFrame:
    """(node, root) of kinds: the components of all links, by their shingles, between kinds of one root.

    kinds: kind, root, size, least (a row of docs that has it). Roots of at most ``block_shingles`` are compared whole,
    each in one task, which gives their components at once. A larger one is cut into blocks, so no task holds more than
    about two of them: each block is compared within itself and with one kind, the leader; then each block of those
    that don't reach the leader so meets all blocks of its root; only these links are searched for components.
    """
    roots = kinds.groupBy("root").agg(F.count("*").alias("kinds"), F.sum("size").alias("total"), F.min("kind").alias("leader")).where("kinds > 1")
    members = kinds.join(roots, "root").withColumn("blocks", F.ceil(F.col("total") / block_shingles))
    members = written(members.select("kind", "root", "size", "blocks", "leader", "least.doc_id", "least.digest"), "members")
    known = members.agg(F.sum(F.when(F.col("blocks") <= 1, F.col("size"))).alias("small"), F.max("blocks").alias("blocks")).first()
    d = docs.select("doc_id", F.xxhash64("text").alias("digest"), "text").alias("d")
    on = F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("d.digest") == F.col("m.digest"))
    columns = ["kind", "root", "size", "blocks", "leader"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = pa.array([shingles(text, shingle).tobytes() for text in batch.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), sets], names=[*columns, "items"])

    sets = d.join(members.alias("m"), on).select(*(f"m.{c}" for c in columns), "d.text")
    sets = sets.mapInArrow(cut, ", ".join(f"{c} long" for c in columns) + ", items binary").dropDuplicates(["kind"])  # repeated rows
    sets = written(sets, "shingles")

    def join(table: pa.Table) -> pa.Table:
        table = table.sort_by([("root", "ascending"), ("first", "descending"), ("kind", "ascending")])
        root, kind = table.column("root").to_numpy(), table.column("kind").to_numpy()
        items = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("items")]
        cuts = [0, *(np.flatnonzero(root[1:] != root[:-1]) + 1).tolist(), len(root)]
        a, b = [], []
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            a.append(kind[lo:hi])
            b.append(kind[lo:hi][alike(items[lo:hi], similarity)])
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})

    def compared(rows: DataFrame, *places: str) -> DataFrame:
        return rows.groupBy(*places).applyInArrow(join, "a long, b long").where("a <> b")

    def block(of: str, count: str) -> Column:
        return F.pmod(F.xxhash64("kind", F.lit(of)), F.col(count))

    small = sets.where("blocks <= 1").withColumn("first", F.lit(False))
    small = small.withColumn("place", F.pmod(F.xxhash64("root"), F.lit((known.small or 0) // block_shingles + 1)))
    closed = compared(small, "place").toDF("node", "root")
    if (known.blocks or 0) <= 1:
        return closed
    large = sets.where("blocks > 1").withColumn("first", F.col("kind") == F.col("leader"))
    dealt = large.where("not first").withColumn("place", block("all", "blocks"))
    heads = large.where("first").withColumn("place", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    found = [written(compared(dealt.unionByName(heads), "root", "place"), "met")]
    apart = large.where("not first").join(found[0].select(F.col("a").alias("kind"), F.col("b").alias("leader")), ["kind", "leader"], "left_anti")
    apart = apart.join(apart.groupBy("root").agg(F.ceil(F.sum("size") / block_shingles).alias("parts")), "root")
    apart = written(apart.drop("items"), "apart")
    if not apart.isEmpty():
        parts = apart.select("root", "parts").distinct()
        side = apart.join(sets.select("kind", "items"), "kind").withColumn("part", block("apart", "parts"))
        side = side.withColumn("place", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        rest = dealt.join(parts, "root").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        found.append(compared(side.unionByName(rest), "root", "part", "place"))
    return closed.union(components(reduce(DataFrame.union, found)))


def deduplicated(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, block_shingles: int = 1 << 21, **more) -> DataFrame:
    """One document of each group of near copies, with the columns of ``docs``: the one of the least doc_id, then digest.

    Near copies share ``similarity`` of all their distinct shingles, or are linked by others that do. Four fingerprints
    of 64 bits say which to compare: the share of differing bits estimates the angle between two sets of shingles,
    whose cosine is 2 s / (1 + s) at least, and ties in short texts raise it by a quarter at most. The first
    fingerprint searches and all four together decide, each with a margin of three standard deviations; the numbers of
    shingles must agree in the same ratio, as those of near copies do. At this width the triangle bounds prune little:
    bands of sizes do most of the work. What fingerprints bring together is then compared shingle by shingle.
    """
    share = 1.25 * math.acos(2 * similarity / (1 + similarity)) / math.pi
    spread = math.sqrt(share * (1 - share))
    prints = written(set_fingerprints(docs, shingle, parts=4), "fingerprints")
    points, rows = grouped(prints, int(64 * share + 24 * spread), int(256 * share + 48 * spread), similarity, **{"shard_rows": 20_000, **more})
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("least")
    kinds = rows.join(points.select("id", "root"), "id").groupBy("kind").agg(F.first("root").alias("root"), F.first("size").alias("size"), least)
    kinds = written(kinds, "kinds")
    known = verified(docs, kinds, shingle, similarity, block_shingles)
    known = kinds.join(known.withColumnRenamed("root", "joined"), F.col("kind") == F.col("node"), "left")
    keep = known.groupBy(F.coalesce("joined", "kind")).agg(F.min("least").alias("least")).select("least.doc_id", "least.digest")
    rows = docs.withColumn("_llm_digest", F.xxhash64("text")).alias("d")
    rows = rows.join(keep.alias("k"), F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("d._llm_digest") == F.col("k.digest")), "left_semi")
    others = F.to_json(F.struct(F.lit(0).alias("_"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns) if c not in ("doc_id", "text"))))
    copy = F.row_number().over(Window.partitionBy("doc_id", "_llm_digest").orderBy(others))  # of repeated rows the least by all columns
    return rows.withColumn("_llm_copy", copy).where("_llm_copy = 1").select(*docs.columns)
