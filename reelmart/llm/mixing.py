"""Mixing sources to target weights in fixed-length blocks of words.

A source's documents, in a hashed order, are one stream of words, cut into blocks of ``block_words``. Each output
shard draws its number of blocks per source from a multinomial over what the sources have still to give, so the sums
meet the targets. A slot of a source is mapped to a block by the source's own pseudorandom permutation of its block
numbers (a Feistel network with cycle walking): slot i takes block perm(i mod blocks), so no block is taken twice
before all are taken once. Blocks are joined with the pieces of documents by (source, block), which splits any large
source evenly. Only counts per source and shard are known to the driver.

Defined cases: a null text has no words; null is a source of its own, last in order; documents without words take
nothing; repeated rows are separate documents; an empty table gives an empty result; columns besides doc_id, text and
source are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelmart.llm.scratch import partitions, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)


def word_count(text: str | Column = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def targets(sizes: dict[str | None, int], share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> dict[str | None, float]:
    """Words to take of each source: ``share`` of all words by weight, none above ``most`` times its size.

    Sources stand in code point order, null last; the weights repeat. What a full source can't take is shared anew
    among the others by weight.
    """
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-8")) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out: dict[str | None, float] = {}
    left, open_ = share * sum(sizes.values()), list(order)
    while open_:
        per = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if per * weight[s] >= most * sizes[s]]
        if not full:
            return out | {s: per * weight[s] for s in open_}
        out |= {s: float(most * sizes[s]) for s in full}
        left -= sum(out[s] for s in full)
        open_ = [s for s in open_ if s not in full]
    return out


def draw(quotas: np.ndarray, slots: int, seed: int) -> np.ndarray:
    """Blocks per output shard and source: multinomial draws over what is left, ``slots`` blocks a shard."""
    random, left, rows = np.random.default_rng(seed), quotas.astype(np.int64).copy(), []
    while left.sum():
        counts, free = np.zeros_like(left), min(slots, int(left.sum()))
        while free:  # what a source can't give is drawn anew from the others
            rest = left - counts
            counts += np.minimum(random.multinomial(free, rest / rest.sum()), rest)
            free = min(slots, int(left.sum())) - int(counts.sum())
        rows.append(counts)
        left -= counts
    return np.array(rows, np.int64).reshape(len(rows), len(quotas))


def permuted(x: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of 0 .. n - 1 at x: four Feistel rounds over the next power of four, walked into range."""
    half = max(1, (max(1, n - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    rounds = np.frombuffer(hashlib.sha256(key.to_bytes(8, "little")).digest(), np.uint64)

    def once(v: np.ndarray) -> np.ndarray:
        left, right = v >> np.uint64(half), v & mask
        for k in rounds:
            f = (right ^ k) * np.uint64(0x9E3779B97F4A7C15)
            left, right = right, left ^ ((f ^ (f >> np.uint64(29))) >> np.uint64(17) & mask)
        return (left << np.uint64(half)) | right

    out = once(x.astype(np.uint64))
    while (beyond := out >= n).any():
        out[beyond] = once(out[beyond])
    return out.astype(np.int64)


class Mix:
    """The plan of a mix over documents: streams, quotas and uses of blocks.

    block_words: words of a block; shards: output shards; buckets: parts of a source that are numbered side by side.
    """

    def __init__(self, docs: DataFrame, share: float = 1.5, most: float = 2.0, block_words: int = 64, shards: int = 1024, seed: int = 0, buckets: int = 512):
        self.spark, self.block_words, self.shards, self.seed = docs.sparkSession, block_words, shards, seed
        rows = docs.select("doc_id", "source", word_count().alias("size"), F.xxhash64("text").alias("digest"))
        rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(buckets)))
        # the digest breaks ties of ids, so that reruns number alike; equal rows are interchangeable
        within = Window.partitionBy("source", "part").orderBy("doc_id", "digest").rowsBetween(Window.unboundedPreceding, -1)
        numbered = rows.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0)))
        self.rows = written(numbered, "sized")
        parts = self.rows.groupBy("source", "part").agg(F.sum("size").alias("words"))
        below = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        self.bases = parts.select("source", "part", F.coalesce(F.sum("words").over(below), F.lit(0)).alias("base"))
        found = self.rows.groupBy("source").agg(F.sum("size").alias("words")).collect()
        self.sizes = {r.source: r.words for r in found}
        self.targets = targets(self.sizes, share, most)
        self.order = sorted(self.sizes, key=lambda s: (s is None, (s or "").encode()))

    def blocks(self, source) -> int:
        return -(-self.sizes[source] // self.block_words)

    def quota(self, source) -> int:
        """Blocks to take; in proportion to the target, as the last block of a stream may be short."""
        size = self.sizes[source]
        return round(self.targets[source] / size * self.blocks(source)) if size else 0

    def sources(self) -> DataFrame:
        """source, source_size, target, blocks, number."""
        order = self.order
        columns = {
            "source": pa.array(order, pa.string()),
            "source_size": pa.array([self.sizes[s] for s in order], pa.int64()),
            "target": pa.array([float(self.targets[s]) for s in order], pa.float64()),
            "blocks": pa.array([self.blocks(s) for s in order], pa.int64()),
            "number": pa.array(range(len(order)), pa.int32()),
        }
        return self.spark.createDataFrame(pa.table(columns))

    def draws(self) -> DataFrame:
        """shard, number (of the source), first, slots: which slots of a source an output shard takes."""
        quotas = np.array([self.quota(s) for s in self.order], np.int64)
        counts = draw(quotas, -(-int(quotas.sum()) // self.shards), self.seed)
        first = np.cumsum(counts, axis=0) - counts
        shard, number = np.nonzero(counts)
        return self.spark.createDataFrame(
            pa.table({"shard": shard.astype(np.int64), "number": number.astype(np.int32), "first": first[shard, number], "slots": counts[shard, number]})
        )

    def uses(self) -> DataFrame:
        """shard, source, slot, block, pass: the block that each slot takes."""
        seed = self.seed
        slots = self.draws().repartition(partitions(self.spark)).join(self.sources(), "number")
        slots = slots.select("shard", "number", "source", "blocks", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("slots") - 1)).alias("slot"))

        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                number, blocks, slot = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("number", "blocks", "slot"))
                block = np.zeros(len(slot), np.int64)
                for s in np.unique(number):
                    at = number == s
                    n = int(blocks[at][0])
                    block[at] = permuted(slot[at] % n, n, seed * 1_000_003 + int(s))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("shard"), batch.column("source"), batch.column("slot"), pa.array(block), pa.array(slot // np.maximum(blocks, 1))],
                    names=["shard", "source", "slot", "block", "pass"],
                )

        return slots.mapInArrow(choose, "shard long, source string, slot long, block long, pass long")

    def pieces(self) -> DataFrame:
        """The documents with words, cut at block boundaries: block, first (the document's word it begins with), words."""
        rows = self.rows.where("size > 0").alias("r")
        bases = self.bases.alias("b")
        rows = rows.join(bases, F.col("r.source").eqNullSafe(F.col("b.source")) & (F.col("r.part") == F.col("b.part")))
        rows = rows.select("r.source", "doc_id", "digest", "size", (F.col("before") + F.col("base")).alias("start"))
        blocks = F.sequence(F.expr(f"start div {self.block_words}"), F.expr(f"(start + size - 1) div {self.block_words}"))
        cut = rows.withColumn("block", F.explode(blocks))
        since = F.greatest(F.col("start"), F.col("block") * self.block_words)
        until = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * self.block_words)
        return cut.select("*", (since - F.col("start")).alias("first"), (until - since).alias("words"))

    def met(self) -> DataFrame:
        """The pieces, each with the passes that take its block."""
        used = self.uses().groupBy("source", "block").agg(F.sort_array(F.collect_list("pass")).alias("passes")).alias("u")
        pieces = self.pieces().alias("p")
        on = F.col("p.source").eqNullSafe(F.col("u.source")) & (F.col("p.block") == F.col("u.block"))
        return pieces.join(used, on, "left").select("p.*", F.coalesce("passes", F.array().cast("array<long>")).alias("passes"))

    def taken(self) -> DataFrame:
        """doc_id, size, source_size, target, taken: words that the mix takes of every document, repeats counted."""
        words = F.sum(F.col("words") * F.size("passes")).alias("taken")
        rows = self.met().groupBy("source", "doc_id", "size", "start").agg(words).drop("start")
        empty = self.rows.where("size = 0").select("source", "doc_id", "size", F.lit(0).cast("long").alias("taken"))
        rows, sources = rows.union(empty).alias("r"), self.sources().alias("s")
        rows = rows.join(sources, F.col("r.source").eqNullSafe(F.col("s.source")))
        return rows.select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: a row for each document and pass that takes words of it, with the columns of ``docs``.

    The text is the whole text if the pass takes all its words, else the words taken, joined by one space; n_chars
    follows it. Documents of which no word is taken don't occur.
    """
    key = ["doc_id", "source", "digest"]
    mix = Mix(docs, **options)
    met = mix.met().withColumn("pass", F.explode("passes"))
    parts = met.groupBy(*key, "start", "pass").agg(F.sort_array(F.collect_list(F.struct("first", "words"))).alias("parts"))
    # equal rows take a stream place each, by their number among equal rows
    places = mix.pieces().where("first = 0").select(*key, "start")
    places = places.withColumn("number", F.row_number().over(Window.partitionBy(*key).orderBy("start"))).alias("p")
    same = lambda a, b, columns: reduce(lambda x, y: x & y, (F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in columns))
    taken = places.join(parts.alias("t"), same("p", "t", [*key, "start"])).select("p.*", "t.parts").alias("c")
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "source", F.xxhash64("text").alias("digest"), "text")
    others = F.to_json(F.struct(F.lit(0).alias("_"), *(F.col("row").getField(c).alias(f"c{i}") for i, c in enumerate(docs.columns) if c not in ("doc_id", "source", "text"))))
    rows = rows.withColumn("number", F.row_number().over(Window.partitionBy(*key).orderBy(others))).alias("d")  # ties by all columns
    rows = rows.join(taken, same("d", "c", [*key, "number"])).select("row", "text", "parts")
    rows = rows.withColumn("found", F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)))
    pieces = F.transform("parts", lambda p: F.array_join(F.slice("found", (p["first"] + 1).cast("int"), p["words"].cast("int")), " "))
    taken = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["words"])
    rows = rows.select("row", F.when(taken == F.size("found"), F.col("text")).otherwise(F.array_join(pieces, " ")).alias("text"))
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return rows.select(*(changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))
