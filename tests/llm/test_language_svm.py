import zlib

import numpy as np
import pytest
from conftest import SMALL, rows

from reelmart.llm import features, language_svm as L
from reelmart.llm.queries import QUERIES
from reelmart.llm.text import utf8


def grams(texts, dims=256):
    import pyarrow as pa

    data, offsets = utf8(pa.array(texts))
    return features.letter_trigrams(data, offsets, dims)


def test_trigrams_by_counting():
    texts = ["Abc dÉ", "", "ab", "abcabc abc", "é" * 5, "zz  zz"]
    found = grams(texts)
    for text, row in zip(texts, found, strict=True):
        codes = features._LETTERS[np.frombuffer(text.encode(), np.uint8)].tolist()
        want = np.zeros(256)
        for a, b, c in zip(codes, codes[1:], codes[2:], strict=False):
            want[((a << 16 | b << 8 | c) * 0x9E3779B1 & 0xFFFFFFFF) >> 24] += 1
        assert row.tolist() == want.tolist()


def test_families():
    assert L.family("de") == L.family("en") == "germanic" and L.family("pt-BR") == "romance" and L.family("xx") == "xx"


TRAINING = {
    "en": ["the and of that with", "this is the thing of the north", "with them and the others"],
    "de": ["der die das und nicht", "ich bin nicht der und die schule", "das ist eine sache und nicht die"],
    "fr": ["le la les dans avec", "je suis dans la maison avec les", "elle est avec le chien dans la"],
    "es": ["el los las para una", "estoy para los perros con una", "ella para las casas y los"],
    "xx": ["zzq qqz zqzq qzz", "qzqz zzqq qzz zqq", "zzz qqq zqz qzq"],
}


@pytest.fixture(scope="module")
def training(documents):
    return documents(*((100 * k + 10 * i + j, f"{t} {t}", language) for k, (language, texts) in enumerate(TRAINING.items()) for i, t in enumerate(texts) for j in range(4)), (9000, "no label", None), (9001, None, "en"))


def test_learned_and_odd_rows(documents, training, odd_texts):
    model = L.fit(training)
    assert set(model.pairs) == {("de", "en"), ("es", "fr")} and len(model.names) == 3
    table = [(i, texts[0]) for i, texts in enumerate(TRAINING.values())] + [(50 + i, t) for i, t in enumerate(odd_texts)] + [(None, "12 %% !!"), (0, TRAINING["en"][0])]
    got = L.identify(documents(*table), model)
    assert got.columns[-2:] == ["lang_pred", "score"] and got.where("score < 0 or score > 1 or score is null").count() == 0
    told = dict(rows(got, "doc_id", "lang_pred"))
    assert [told[i] for i in range(5)] == list(TRAINING)
    assert told[50] == told[51] == told[52] == told[None] == "und" and told[53] != "und"
    kept = L.accepted(documents(*table), model)
    assert kept.columns == documents(*table).columns and {(0,), (1,), (2,), (3,), (4,)} <= set(rows(kept, "doc_id"))
    assert not {50, 51, 52, None} & {r.doc_id for r in kept.collect()}


def test_nothing_to_learn(documents):
    docs = documents((1, "some words", None), (2, None, "en"))
    assert L.fit(docs) is None
    assert rows(L.identify(docs, None), "doc_id", "lang_pred", "score") == [(1, "und", 0.0), (2, "und", 0.0)]
    assert L.identify(documents(), None).collect() == [] and L.fit(documents()) is None


def test_machine_separates():
    random_ = np.random.default_rng(0)
    points = random_.standard_normal((200, 10)).astype(np.float32)
    sides = np.where(points[:, 3] - points[:, 7] + 0.2 > 0, 1.0, -1.0)
    weights, bias = L._svm(points, sides, 200, 1e-4)
    assert (np.sign(points @ weights + bias) == sides).mean() > 0.98


def test_held_out(spark):
    got = QUERIES["op3_language"](spark, SMALL).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert len(got) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)
