import random

import numpy as np
import pytest
from conftest import rows

from reelmart.llm import suffix_dedup
from reelmart.llm.suffix_dedup import PrefixHashes, suffix_sort, without_repeats

from .conftest import words

COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept")


def brute_force(table, window=50):
    """Every window of every text, looked up among all windows of smaller ids."""
    least, out = {}, []
    rank = lambda d: (d is not None, d or 0)
    for d, text in sorted(table, key=lambda r: rank(r[0])):
        data = (text or "").encode()
        for i in range(len(data) - window + 1):
            least.setdefault(data[i : i + window], rank(d))
    for d, text in table:
        data = (text or "").encode()
        gone = [False] * len(data)
        for i in range(len(data) - window + 1):
            if least[data[i : i + window]] < rank(d):
                gone[i : i + window] = [True] * window
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(data), sum(gone), spans, bytes(b for b, g in zip(data, gone, strict=True) if not g)))
    return sorted(out, key=str)


def got(df, **options):
    found = without_repeats(df, **options)
    assert found.columns == list(COLUMNS)
    return sorted(((*map(lambda c: r[c], COLUMNS[:4]), bytes(r.kept)) for r in found.collect()), key=str)


@pytest.mark.parametrize("seed", range(2))
def test_brute_force(documents, seed):
    random_ = random.Random(seed)
    shared = [" ".join(words(100 + i, 10 + 9 * i)) for i in range(5)] + ["дом и лес " * 12, "aab" * 40]
    table = []
    for i in range(70):
        text = " ".join(words(seed * 1000 + i, 30))
        for k in range(i % 4):
            at, passage = random_.randrange(len(text)), shared[(i + k) % 7]
            cut = random_.randrange(30)
            text = text[:at] + passage[cut : cut + random_.choice([49, 50, 51, 80, 200])] + text[at:]
        table.append((i * 3 % 60, text))  # some ids occur twice
    table += [(i + 100, table[i][1]) for i in range(0, 70, 5)] + [(5, table[9][1])]
    assert got(documents(*table), chunk_bytes=3_000, bucket_bytes=2_000) == brute_force(table)


@pytest.mark.parametrize("window, gram", [(8, 8), (13, 8), (33, 9), (64, 64)])
def test_other_windows(documents, window, gram):
    table = [(i, "".join(random.Random(i).choices("ab", k=120)) + "x" * (i % 70)) for i in range(40)]
    assert got(documents(*table), window=window, gram=gram, chunk_bytes=700) == brute_force(table, window)


def test_hot_keys_are_dealt_out(documents):
    """A passage that all documents share, between texts of their own: equal with and without hot keys."""
    passage = " ".join(words(7, 30))
    table = [(i, " ".join([*words(i, 8), passage, *words(1000 + i, 8)])) for i in range(150)]
    want = brute_force(table)
    assert got(documents(*table), chunk_bytes=2_000) == want
    chunk = suffix_dedup.Chunk(0, documents(*table).select("doc_id", "text").toArrow(), set(), 50, 24, 4)
    keys, n, several = chunk.anchors()
    at = [keys >> np.uint64(32) == b for b in np.unique(keys >> np.uint64(32))]
    bits = {b: np.packbits(several[p]).tobytes() + np.packbits(several[p] & (n[p] < 400)).tobytes() for b, p in enumerate(at)}
    strings = chunk.strings(bits)
    assert n[several].min() == 1 and n.max() >= 140 and (strings.count == 1).sum() > 0.9 * len(strings.count)
    assert len(strings.first) < len(strings.start)  # equal windows go once
    assert got(documents(*table), chunk_bytes=2_000, hot=1) == want


def test_odd_rows(documents, odd_texts):
    table = [(i if i != 3 else None, t) for i, t in enumerate(odd_texts)] + [(8, odd_texts[8]), (None, odd_texts[8]), (20, odd_texts[7])]
    assert got(documents(*table), chunk_bytes=10_000) == brute_force(table)
    assert got(documents()) == []


def test_text_ids_and_pieces(spark, monkeypatch):
    """Ids may be texts, and a text may be longer than what is hashed at a time."""
    monkeypatch.setattr(suffix_dedup, "_PIECE", 64)
    table = [(f"d{i:02}", " ".join(words(i % 7, 20 + i))) for i in range(30)]
    df = spark.createDataFrame(table, "doc_id string, text string")
    want = brute_force([(int(d[1:]) + 1, t) for d, t in table])
    assert got(df, chunk_bytes=500) == sorted(((f"d{d - 1:02}", *rest) for d, *rest in want), key=str)


def test_windows_of_thue_morse_words_are_told_apart(documents):
    """Texts that collide in polynomial hashes modulo a power of two, whatever the base."""
    word = "a"
    for _ in range(12):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    table = [(0, word), (1, other), (2, f"{other} {word}")]
    assert got(documents(*table), window=4096, gram=4096) == brute_force(table, 4096)


@pytest.mark.parametrize("seed", range(3))
def test_suffix_sort_is_the_order_of_bytes(seed):
    random_ = np.random.default_rng(seed)
    data = random_.integers(97, 97 + 2 + seed, 900).astype(np.uint8)
    at = random_.permutation(900 - 20)[:600]
    group = np.sort(random_.integers(0, 9, 600))
    order, same = suffix_sort(data, at, group, 20)
    text = data.tobytes()
    key = [(group[i], text[at[i] : at[i] + 20]) for i in order]
    assert key == sorted(key) and list(same) == [i > 0 and key[i] == key[i - 1] for i in range(600)]


def test_collisions_are_noticed_and_sorted_again():
    """With base 1 a hash is a sum of bytes, and everything with equal sums collides."""
    data = np.frombuffer(b"abcdefghbacdefghcabdefghzz", np.uint8)
    at, group = np.array([0, 8, 16]), np.zeros(3, int)
    with pytest.raises(RuntimeError, match="collide"):
        suffix_sort(data, np.array([8, 0, 16]), group, 8, bases=(1,))
    order, same = suffix_sort(data, np.array([8, 0, 16]), group, 8, bases=(1, 69_069))
    assert list(np.array([8, 0, 16])[order]) == [0, 8, 16] and not same.any()
    assert list(PrefixHashes(data).common(at[:2], at[1:], 8)) == [0, 0]


def test_results_are_rows_of_documents(documents):
    table = [(i, "x" * i) for i in range(60)]
    found = rows(without_repeats(documents(*table)), "doc_id", "n_bytes", "n_removed")
    assert found == sorted(((i, i, i if i > 50 else 0) for i in range(60)), key=str)
