import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import rows
from tokenizers import Tokenizer

from reelmart.llm import token_files as T

from .conftest import words

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
TRICKY = ["H̱ẖ T̈ẗ J̌ǰ Àà", "O'SHEA'S it'LL a.'s a'.s 'S 's, x'd.", "≮ <|STARTOFTEXT|> A,B.C!?", "école, ÉCOLE! São-Paulo× 5÷6 ñ. ÿ; Ω. Ж!", "a´b a­b ﬁ, ǅ. K. Å!", "it’s “quoted”, …dots… —", "<|ENDOFTEXT|>Mixed, CASE.<|endoftext|>!", "it's they'RE", "a\x1cb\x1fc", "x y z　q\u0085r", "é ́a", "ΣΟΣ İI", "<|startoftext|> a<|endoftext|>b", "1234 5,6", "\U0001f600\U0001f600", "​ x​", "﻿a", "a\vb\fc\rd"]


def expected(table, vocabulary, end):
    tokenizer, at, out = Tokenizer.from_file(vocabulary), 0, []
    for doc_id, text in sorted(table, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_which_vocabularies_are_separable():
    assert T.separable(WORDS) and not T.separable(BYTES)


@pytest.mark.parametrize("vocabulary", [WORDS, BYTES])
@pytest.mark.parametrize("width", [2, 4])
def test_round_trip(spark, documents, odd_texts, tmp_path, vocabulary, width):
    table = [(7 * i % 40, t) for i, t in enumerate([*odd_texts, *TRICKY, *(" ".join(words(i, 50)) for i in range(20))])] + [(None, "no id"), (None, None)]
    path = f"file://{tmp_path}/tokens"
    T.write(documents(*table), path, vocabulary, end=2, shards=5, width=width)
    want = expected(table, vocabulary, 2)
    assert rows(T.read_checksums(spark, path, width), "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=str)
    shards = sorted(tmp_path.glob("tokens/*.bin"))
    ids = np.concatenate([np.fromfile(p, f"<u{width}") for p in shards])  # the files themselves, in order
    starts = np.concatenate([np.fromfile(p.with_suffix(".off"), "<u8")[:-1] for p in shards])
    assert starts.tolist() == [w[1] for w in want] and len(ids) == want[-1][1] + want[-1][2]
    tokenizer = Tokenizer.from_file(vocabulary)
    doc = {r.doc_id: np.frombuffer(r.ids, f"<u{width}")[:-1].tolist() for r in T.read(spark, path, width).where("doc_id = 0").collect()}
    texts = [t for d, t in table if d == 0]
    assert doc[0] in [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_words_beyond_what_a_worker_keeps(monkeypatch):
    monkeypatch.setattr(T, "KEPT_WORDS", 150)
    encoder, tokenizer = T.Encoder(WORDS, 2), Tokenizer.from_file(WORDS)
    for seed in range(12):
        texts = [" ".join(words(seed * 10 + i, 30)) for i in range(5)] + [""]
        ids, counts = encoder([t.encode() for t in texts])
        want = [[*tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]
        assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_only_distinct_words_become_objects(monkeypatch):
    blocks, learn = [], T.Encoder._learn
    monkeypatch.setattr(T.Encoder, "_learn", lambda self, found: blocks.append(sys.getallocatedblocks()) or learn(self, found))
    encoder, texts = T.Encoder(WORDS, 2), [" ".join(words(i, 20_000)).encode() for i in range(5)]
    before = sys.getallocatedblocks()
    ids, _ = encoder(texts)
    assert len(ids) > 100_000 and max(blocks) - before < 20_000  # 400 words, 100,000 times


@pytest.mark.parametrize("texts", [[""], ["", " \t", ""], [*TRICKY, "", "A", "\u0300b", "c", ".d", "<|endoftext|>X.", ".É", "!", "Ã", "\u0301", "B<|endoftext|>", ".A", ""]])
def test_texts_side_by_side(texts):
    ids, counts = T.Encoder(WORDS, 2)([t.encode() for t in texts])
    want = [[*Tokenizer.from_file(WORDS).encode(t, add_special_tokens=False).ids, 2] for t in texts]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_ids_that_do_not_fit(documents, tmp_path):
    with pytest.raises(Exception, match="does not fit"):
        T.write(documents((1, "a")), f"file://{tmp_path}/x", WORDS, end=70_000, shards=1, width=2)


def test_empty(spark, documents, tmp_path):
    T.write(documents(), f"file://{tmp_path}/none", WORDS, end=2, shards=3)
    assert T.read(spark, f"file://{tmp_path}/none").collect() == []
