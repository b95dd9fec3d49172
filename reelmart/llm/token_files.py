"""Token ids of documents in flat unsigned files with 64-bit document offsets.

A dataset is a folder of shards, in ascending doc_id order: ``<shard>.bin`` holds the ids of its documents one after
another, ``<shard>.off`` one unsigned 64-bit number more than it has documents, the places in the whole dataset where
they start (little-endian both), and ``index`` is a Parquet table of doc_id, shard and row. A task encodes and writes
its range of documents in one pass; the shards' bases are prefix sums of their token counts, one number per shard; a
last pass turns counts into offsets. A file is written under a name of its own and then moved, so a task can run again.

Distinct words are encoded once per worker, up to a bound, where the vocabulary's normalizer and pre-tokenizer are known
not to look across white space (``separable``); else whole texts are encoded. A few megabytes at a time, words are numbered
by Arrow's dictionary encoding and ids gathered by those numbers, so Python only sees a word once each time.

Defined cases: a null or empty text is the end id alone; a null doc_id comes first; equal doc_ids stand in the order of
their texts; an empty table gives no shards and an empty result; extra columns are left.
"""

from __future__ import annotations

import json
import mmap
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import accumulate, chain, pairwise

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmart.llm.text import SEPARATOR, utf8

#: Words of a generation that a worker keeps with their ids.
KEPT_WORDS = 300_000


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _put(path: str, blocks: Iterator[bytes]) -> None:
    """Write a file and move it into place, so that a reader sees all of it or none."""
    files, at = _place(path)
    own = f"{at}.{uuid.uuid4().hex}"
    with files.open_output_stream(own) as out:
        for block in blocks:
            out.write(block)
    files.move(own, at)


class _Span:
    """Reads pieces of a file: memory-mapped if it is a local one."""

    def __init__(self, path: str):
        files, at = _place(path)
        if isinstance(files, fs.LocalFileSystem):
            with open(at, "rb") as file:
                empty = os.fstat(file.fileno()).st_size == 0
                self.map = b"" if empty else mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
            self.file = None
        else:
            self.file = files.open_input_file(at)

    def __call__(self, start: int, size: int) -> bytes:
        return self.map[start : start + size] if self.file is None else self.file.read_at(size, start)


#: The normalizer and pre-tokenizer of vocabularies whose texts can be encoded piece by piece.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_BYTE = np.arange(256, dtype=np.uint8)
_CAPITAL = (_BYTE >= ord("A")) & (_BYTE <= ord("Z"))
_LOW = (_BYTE + np.uint8(32) * _CAPITAL).tobytes()
_SMALL = (_BYTE >= ord("a")) & (_BYTE <= ord("z"))
_SIGN = (_BYTE > 0x20) & (_BYTE < 0x7F) & ~_CAPITAL & ~_SMALL & (_BYTE != ord("'"))
_SIGN[ord("0") : ord("9") + 1] = False
#: What a byte is: a separator (1), an ASCII letter (2), a sign (3), another one (0).
_KIND = (SEPARATOR + 2 * (_CAPITAL | _SMALL) + 3 * _SIGN).astype(np.uint8).tobytes()
#: Second bytes of the letters whose first byte is C3.
_LATIN = (_BYTE >= 0x80) & (_BYTE < 0xC0) & (_BYTE != 0x97) & (_BYTE != 0xB7)


def pieces(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, and how many each has; in fewer forms but with the same ids: ASCII capitals made small, signs after a letter cut off.

    A letter before a combining mark (lead bytes CC, CD) is left, since composing may come before the change of case.
    An apostrophe is left, since the pattern looks at what follows it. A text that may hold special tokens is only split.
    """
    raw = b" ".join([*texts, b""])  # a blank closes each text
    ends = list(accumulate(len(text) + 1 for text in texts))
    given, kind = np.frombuffer(raw, np.uint8), np.frombuffer(raw.translate(_KIND), np.uint8)
    low, letter = np.frombuffer(bytearray(raw.translate(_LOW)), np.uint8), kind == 2
    if b"\xcc" in raw or b"\xcd" in raw:
        before = np.flatnonzero((given == 0xCC) | (given == 0xCD)) - 1  # -1 is the last blank
        low[before] = given[before]
    if b"\xc3" in raw:
        second = np.flatnonzero(given == 0xC3) + 1
        letter[second] = _LATIN[given[second]]
    if b"<|" in raw:
        for text, a, b in zip(texts, [0, *ends], ends, strict=False):
            if b"<|" in text:
                low[a:b], letter[a:b] = given[a:b], False
    inside = kind != 1
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | ((kind[1:] == 3) & letter[:-1])
    data = low[inside]
    offsets = np.append(np.flatnonzero(starts[inside]), len(data))
    words = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return words, np.array([np.count_nonzero(starts[a:b]) for a, b in pairwise([0, *ends])], np.int64)


#: Small letters whose normal form and small form are themselves.
PLAIN = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
_PLAIN_WORD = re.compile(rb"[a-z]*(?:\xc3[\x9f-\xb6\xb8-\xbf][a-z]*)*").fullmatch


class Encoder:
    """Ids of texts, by distinct words where the vocabulary allows it.

    Words are kept in two generations: a full one becomes the older, and words that are still used move from there to
    the younger, so frequent words stay and memory is bounded.
    """

    def __init__(self, vocabulary: str, end: int):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer, self.end = Tokenizer.from_file(vocabulary), end
        self.by_word = separable(vocabulary)
        self.young: dict[bytes, bytes] = {}  # the ids of a word, four bytes each
        self.old: dict[bytes, bytes] = {}
        bytewise = ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytewise = str.maketrans({c: bytewise.pre_tokenize_str(c)[0][0] for c in PLAIN})

    def _encode(self, texts: list[bytes], at_once: int = 4096) -> tuple[np.ndarray, np.ndarray]:
        """Counts and ids; a bounded number of texts at a time, as an encoding is much larger than its ids."""
        lengths, ids = [], []
        for i in range(0, len(texts), at_once):
            found = [e.ids for e in self.tokenizer.encode_batch_fast([t.decode() for t in texts[i : i + at_once]], add_special_tokens=False)]
            lengths += map(len, found)
            ids.append(np.fromiter(chain.from_iterable(found), np.uint32))
        return np.array(lengths, np.int64), np.concatenate(ids) if ids else np.zeros(0, np.uint32)

    def _learn(self, words: list[bytes]) -> list[bytes]:
        # a word of small letters alone is one piece that the normalizer leaves as it is: straight to the model
        merge, table = self.tokenizer.model.tokenize, self.bytewise
        found: dict[bytes, bytes] = {}
        other = []
        for word in words:
            if _PLAIN_WORD(word):
                ids = [x.id for x in merge(word.decode() if word.isascii() else word.decode().translate(table))]
                found[word] = struct.pack(f"<{len(ids)}I", *ids)
            else:
                other.append(word)
        lengths, ids = self._encode(other)
        data = ids.astype("<u4").tobytes()
        ends = (4 * np.cumsum(lengths)).tolist()
        found.update(zip(other, (data[a:b] for a, b in pairwise([0, *ends])), strict=True))
        return list(map(found.__getitem__, words))

    def _ids(self, words: list[bytes]) -> list[bytes]:
        """The ids of distinct words, four bytes each."""
        found = list(map(self.young.get, words))
        gaps = [i for i, ids in enumerate(found) if ids is None]
        new = []
        for i in gaps:
            found[i] = self.old.get(words[i])
            if found[i] is None:
                new.append(i)
        for i, ids in zip(new, self._learn([words[i] for i in new]), strict=True):
            found[i] = ids
        if len(self.young) + len(gaps) > KEPT_WORDS:
            self.old, self.young = self.young, dict(zip(words, found, strict=True))
        else:
            self.young.update((words[i], found[i]) for i in gaps)
        return found

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts, each closed by the end id, and their counts."""
        if not self.by_word:
            lengths, ids = self._encode(texts, 64)
            return np.insert(ids, np.cumsum(lengths), self.end), lengths + 1
        words, counts = pieces(texts)
        words = words.dictionary_encode()
        data, offsets = utf8(words.dictionary)
        data = data.tobytes()
        known = self._ids([data[a:b] for a, b in pairwise(offsets.tolist())])
        # the end id is one more word, after the last one of each text
        codes = np.insert(words.indices.to_numpy(), np.cumsum(counts), len(known))
        found = pa.array([*known, struct.pack("<I", self.end)], pa.large_binary()).take(pa.array(codes))
        data, offsets = utf8(found)
        bounds = offsets[np.append(0, np.cumsum(counts + 1))] // 4
        return data[: offsets[-1]].view("<u4"), np.diff(bounds)


def separable(vocabulary: str) -> bool:
    """Whether a text's ids are those of its pieces, one after another: true for the one form known to be so."""
    with open(vocabulary, encoding="utf-8") as file:
        parts = json.load(file)
    split, *rest = (parts["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
    return (
        parts["model"]["type"] == "BPE"
        and (parts["normalizer"] or {}).get("normalizers") == NORMALIZERS
        and (split.get("pattern"), split.get("behavior"), split.get("invert")) == ({"Regex": PATTERN}, "Removed", True)
        and all((x["type"], x["add_prefix_space"], x["use_regex"]) == ("ByteLevel", False, False) for x in rest)
        and all(x["content"].startswith("<|") for x in parts["added_tokens"])
    )


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def _texts(batch: pa.RecordBatch, most: int = 4 << 20) -> Iterator[list[bytes]]:
    """A batch's texts, a few megabytes at a time."""
    run, size = [], 0
    for text in batch.column("text"):
        text = text.as_buffer().to_pybytes() if text.is_valid else b""
        run.append(text)
        size += len(text)
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run


def write(docs: DataFrame, path: str, vocabulary: str, end: int, shards: int, width: int = 4) -> None:
    """Encode the documents into ``shards`` shards under path, ids of ``width`` bytes (2 or 4)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    dtype = np.dtype(f"<u{width}")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        first = next(batches, None)
        if first is None:
            return
        key = (vocabulary, end)
        encoder = _ENCODERS[key] if key in _ENCODERS else _ENCODERS.setdefault(key, Encoder(*key))
        counts, ids = [], []

        def blocks() -> Iterator[bytes]:
            for batch in chain([first], batches):
                for texts in _texts(batch):
                    found, n = encoder(texts)
                    if len(found) and int(found.max()) >= 1 << 8 * width:
                        raise ValueError(f"an id does not fit {width} bytes")
                    counts.append(n)
                    yield found.astype(dtype).tobytes()
                ids.append(batch.column("doc_id"))

        _put(f"{path}/{shard:06d}.bin", blocks())
        counts, row = np.concatenate(counts), 0
        for column in ids:
            n = len(column)
            yield pa.RecordBatch.from_arrays(
                [column, pa.array(np.full(n, shard, np.int32)), pa.array(np.arange(row, row + n, dtype=np.int64)), pa.array(counts[row : row + n])],
                names=["doc_id", "shard", "row", "n_tokens"],
            )
            row += n

    spark = docs.sparkSession
    _make(path)
    ranges = docs.select("doc_id", "text").repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")
    ranges.mapInArrow(encode, f"doc_id {kind}, shard int, row long, n_tokens long").write.parquet(f"{path}/index")
    index = spark.read.parquet(f"{path}/index")
    totals = index.groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").collect()  # one row per shard
    sums = np.cumsum([0, *(r.n for r in totals)])
    bases = {r.shard: int(b) for r, b in zip(totals, sums, strict=False)}

    def offsets(key: tuple, rows: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        counts = rows.sort_by("row").column("n_tokens").to_numpy()
        starts = bases[shard] + np.concatenate([[0], np.cumsum(counts)])
        _put(f"{path}/{shard:06d}.off", iter([starts.astype("<u8").tobytes()]))
        return pa.table({"shard": pa.array([shard], pa.int32())})

    index.select("shard", "row", "n_tokens").groupBy("shard").applyInArrow(offsets, "shard int").count()


def _make(path: str) -> None:
    files, at = _place(path)
    files.create_dir(at, recursive=True)


def read(spark: SparkSession, path: str, width: int = 4) -> DataFrame:
    """doc_id, start, n_tokens, ids (bytes, little-endian, ``width`` each) of every document, from the files."""
    return _each(spark, path, width, lambda ids: ids, "ids binary", pa.binary())


def read_checksums(spark: SparkSession, path: str, width: int = 4) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (of the ids as 4-byte numbers) of every document, from the files."""

    def crc(ids: bytes) -> int:
        return zlib.crc32(ids if width == 4 else np.frombuffer(ids, f"<u{width}").astype("<u4").tobytes())

    return _each(spark, path, width, crc, "ids_crc32 long", pa.int64())


def _each(spark: SparkSession, path: str, width: int, value, column: str, kind: pa.DataType) -> DataFrame:
    index = spark.read.parquet(f"{path}/index").select("doc_id", "shard", "row")

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: tuple[int, _Span, _Span, int] | None = None
        for batch in batches:
            starts, lengths, values = [], [], []
            for shard, row in zip(batch.column("shard").to_pylist(), batch.column("row").to_pylist(), strict=True):
                if opened is None or opened[0] != shard:
                    off = _Span(f"{path}/{shard:06d}.off")
                    opened = shard, _Span(f"{path}/{shard:06d}.bin"), off, int.from_bytes(off(0, 8), "little")
                start, until = np.frombuffer(opened[2](8 * row, 16), "<u8").tolist()
                starts.append(start)
                lengths.append(until - start)
                values.append(value(opened[1](width * (start - opened[3]), width * (until - start))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(values, kind)],
                names=["doc_id", "start", "n_tokens", column.split()[0]],
            )

    return index.mapInArrow(load, f"doc_id {index.schema['doc_id'].dataType.simpleString()}, start long, n_tokens long, {column}")
