"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Groups (equal texts) come as digests with their bytes. Packing has two levels, so that no task holds all groups: the
groups are spread over cells by digest, and each cell streams its groups in descending size into bundles of a fixed
capacity, always the tightest that still has room, found in a balanced tree; then the bundles, whose number depends on
the shards and cells and not on the data, are packed the same way into the shards. With a fixed number of shards the
capacity is the least that best fit decreasing keeps within that number. With a fixed capacity each cell packs its groups
into shards of that capacity at once, and only the one shard that a cell leaves half empty is packed with those of other
cells.

Defined cases: a null text is an empty one, of size 1; rows of equal texts stay together, repeated rows
included; a group above the capacity has a shard of its own; a null doc_id is numbered first; an empty table gives an
empty result; extra columns are kept by ``sharded`` and left by ``shard_sizes``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from reelmart.llm.scratch import partitions, written

#: With a capacity: how many shards' worth of bytes make a cell of its own.
SHARDS_OF_A_CELL = 16


class OpenBins:
    """Bins by remaining room in a treap: the tightest bin with room for a size in logarithmic time.

    The node of a bin that is taken serves the next one added, so there are never more nodes than open bins.
    """

    __slots__ = ("left", "right", "room", "bin", "rank", "root", "state", "free")

    def __init__(self):
        self.left, self.right, self.room, self.bin, self.rank = [0], [0], [0], [0], [0]
        self.root, self.state, self.free = 0, 0x2545F491, []

    def add(self, room: int, bin_: int) -> None:
        self.state = (self.state * 1103515245 + 12345) & 0x7FFFFFFF
        node = self.free.pop() if self.free else len(self.room)
        for column, value in ((self.left, 0), (self.right, 0), (self.room, room), (self.bin, bin_), (self.rank, self.state)):
            column[node : node + 1] = [value]
        below, above = self._split(self.root, room, bin_)
        self.root = self._merge(self._merge(below, node), above)

    def take(self, size: int) -> tuple[int, int] | None:
        """(room, bin) of the tightest bin with at least that room, removed; the lowest bin among equals."""
        node, best = self.root, 0
        while node:
            if self.room[node] >= size:
                node, best = self.left[node], node
            else:
                node = self.right[node]
        if not best:
            return None
        room, bin_ = self.room[best], self.bin[best]
        below, rest = self._split(self.root, room, bin_)
        _, above = self._split(rest, room, bin_ + 1)
        self.root = self._merge(below, above)
        self.free.append(best)
        return room, bin_

    def _split(self, node: int, room: int, bin_: int) -> tuple[int, int]:
        """Nodes below (room, bin) and the others."""
        if not node:
            return 0, 0
        if (self.room[node], self.bin[node]) < (room, bin_):
            a, b = self._split(self.right[node], room, bin_)
            self.right[node] = a
            return node, b
        a, b = self._split(self.left[node], room, bin_)
        self.left[node] = b
        return a, node

    def _merge(self, a: int, b: int) -> int:
        if not a or not b:
            return a or b
        if self.rank[a] > self.rank[b]:
            self.right[a] = self._merge(self.right[a], b)
            return a
        self.left[b] = self._merge(a, self.left[b])
        return b


class Packing:
    """Best fit for sizes that come in descending order."""

    def __init__(self, capacity: int):
        self.capacity, self.open, self.loads = capacity, OpenBins(), []

    def put(self, size: int) -> int:
        found = self.open.take(size)
        room, bin_ = found or (max(self.capacity, size), len(self.loads))
        if found is None:
            self.loads.append(0)
        self.loads[bin_] += size
        if room > size:
            self.open.add(room - size, bin_)
        return bin_


def pack(sizes: list[int], capacity: int) -> list[int]:
    """The bin of each size; sizes must descend."""
    packing = Packing(capacity)
    return [packing.put(size) for size in sizes]


def pack_into(sizes: list[int], bins: int) -> list[int]:
    """Bins 0 .. bins - 1 of sizes that descend, by the least capacity at which best fit decreasing needs no more.

    A size above an even share of what is left takes a bin of its own, so the others still share evenly.
    """
    alone, rest = 0, sum(sizes)
    while alone < min(bins - 1, len(sizes)) and sizes[alone] * (bins - alone) > rest:
        rest -= sizes[alone]
        alone += 1
    own, n = sizes[alone:], bins - alone
    low = max([-(-sum(own) // n), *own[:1]])
    high = low + max(own[:1], default=0) + 1
    while max(pack(own, high), default=0) >= n:
        high *= 2
    while low < high:
        middle = (low + high) // 2
        if max(pack(own, middle), default=0) < n:
            high = middle
        else:
            low = middle + 1
    return [*range(alone), *(alone + b for b in pack(own, high))]


def _digest() -> Column:
    """128 bits of the text's SHA-256: the name of its group."""
    return F.unhex(F.substring(F.sha2(F.coalesce("text", F.lit("")), 256), 1, 32))


def _groups(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, digest of every row."""
    text = F.coalesce("text", F.lit(""))
    size = (F.octet_length(text) + 1).cast("long")
    return docs.select("doc_id", size.alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), _digest().alias("digest"))


def assign(rows: DataFrame, shards: int | None = 16, capacity: int | None = None, bundles: int = 64) -> tuple[DataFrame, DataFrame]:
    """(digest, cell, bundle) of every group and (cell, bundle, shard) of the bundles, for rows with digest and size.

    shards: their number, or None with a capacity in bytes. bundles: how many a shard has at least.
    """
    spark = rows.sparkSession
    total = rows.agg(F.sum("size")).first()[0] or 0
    groups = rows.groupBy("digest").agg(F.sum("size").alias("bytes"))
    if shards:
        cells, room = partitions(spark), max(1, total // (shards * bundles))
    else:  # a cell fills its shards by itself, so it should have many
        cells, room = min(partitions(spark), max(1, total // (SHARDS_OF_A_CELL * capacity))), capacity
    groups = groups.withColumn("cell", F.pmod(F.xxhash64("digest"), F.lit(cells)))

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packings: dict[int, Packing] = {}
        for batch in batches:
            cell = batch.column("cell").to_pylist()
            places = []
            for c, size in zip(cell, batch.column("bytes").to_pylist(), strict=True):
                if c not in packings:
                    packings[c] = Packing(room)
                places.append(packings[c].put(size))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.int64())], names=[*batch.schema.names, "bundle"])

    sorted_groups = groups.repartition(cells, "cell").sortWithinPartitions("cell", F.desc("bytes"), "digest")
    placed = written(sorted_groups.mapInArrow(bundle, "digest binary, bytes long, cell long, bundle long"), "groups")
    loads = placed.groupBy("cell", "bundle").agg(F.sum("bytes").alias("load"))
    places = _into_shards(spark, loads, shards) if shards else _own_shards(spark, loads, capacity)
    return placed.select("digest", "cell", "bundle"), places


def _table(spark: SparkSession, loads: list[Row], shard: list[int]) -> DataFrame:
    columns = [[r.cell for r in loads], [r.bundle for r in loads], shard]
    kinds = [pa.int64(), pa.int64(), pa.int32()]
    return spark.createDataFrame(pa.table(list(map(pa.array, columns, kinds)), names=["cell", "bundle", "shard"]))


def _descending(loads: DataFrame) -> list[Row]:
    return sorted(loads.collect(), key=lambda r: (-r.load, r.cell, r.bundle))


def _into_shards(spark: SparkSession, loads: DataFrame, shards: int) -> DataFrame:
    # at most 2 x shards x bundles + cells rows, whatever the data: all bundles of a cell but one are over half full
    found = _descending(loads)
    return _table(spark, found, pack_into([r.load for r in found], shards))


def _own_shards(spark: SparkSession, loads: DataFrame, capacity: int) -> DataFrame:
    """Bins over half full are shards as they are, numbered cell by cell; the others are packed together.

    Best fit leaves at most one bin of a cell half empty, so the driver sees two rows a cell.
    """
    loads = written(loads.withColumn("whole", F.col("load") * 2 > capacity), "loads")
    whole = loads.where("whole")
    bases, base = [], 0
    for row in sorted(whole.groupBy("cell").count().collect(), key=lambda r: r.cell):
        bases.append((row.cell, base))
        base += row["count"]
    in_cell = F.row_number().over(Window.partitionBy("cell").orderBy("bundle"))
    places = whole.join(spark.createDataFrame(bases, "cell long, base long"), "cell").select(
        "cell", "bundle", (F.col("base") + in_cell - 1).cast("int").alias("shard")
    )
    rest = _descending(loads.where("NOT whole"))
    return places.union(_table(spark, rest, [base + s for s in pack([r.load for r in rest], capacity)]))


def numbered(rows: DataFrame, order: list[str], shard: str = "shard", part: str = "cell") -> DataFrame:
    """slot: gapless from 0 in each shard, by part and then order; parts are numbered side by side."""
    spec = Window.partitionBy(shard, part)
    rows = rows.withColumn("_n", F.row_number().over(spec.orderBy(*order)))
    counts = rows.groupBy(shard, part).agg(F.count("*").alias("_rows"))
    below = Window.partitionBy(shard).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(shard, part, F.coalesce(F.sum("_rows").over(below), F.lit(0)).alias("_base"))
    return rows.join(bases, [shard, part]).withColumn("slot", F.col("_base") + F.col("_n") - 1).drop("_n", "_base")


def shard_sizes(docs: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: every document's place; the law is `bytes`."""
    rows = written(_groups(docs), "sizes")
    groups, places = assign(rows, shards)
    rows = rows.join(groups, "digest").join(places, ["cell", "bundle"])
    # rows of a hot group share a cell; a finer part by doc_id spreads their numbering
    rows = rows.withColumn("cell", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(partitions(docs.sparkSession))))
    rows = numbered(rows, ["doc_id", "digest"])
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def sharded(docs: DataFrame, shards: int | None = 16, capacity: int | None = None) -> DataFrame:
    """The documents with shard; extra columns are kept, clashing ones replaced."""
    docs = docs.drop("shard", "_llm_digest")
    groups, places = assign(written(_groups(docs), "sizes"), shards, capacity)
    of = groups.join(places, ["cell", "bundle"]).select(F.col("digest").alias("_llm_digest"), "shard")
    return docs.withColumn("_llm_digest", _digest()).join(of, "_llm_digest").drop("_llm_digest")
