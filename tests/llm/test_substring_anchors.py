import hashlib

import pytest
from conftest import rows

from reelmart.llm.substring_anchors import COVERS, without_repeats

from .conftest import words


def brute_force(table, window):
    """Removed flags by looking at every window in order."""
    seen, out = set(), []
    for doc_id, text in sorted(table, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        found = (text or "").encode().split()
        gone = [False] * len(found)
        for i in range(len(found) - window + 1):
            key = tuple(found[i : i + window])
            if key in seen:
                gone[i : i + window] = [True] * window
            seen.add(key)
        kept = b" ".join(w for w, g in zip(found, gone, strict=True) if not g).decode()
        out.append((doc_id, len(found), sum(gone), kept))
    return sorted(out, key=str)


@pytest.mark.parametrize("period", COVERS)
def test_cover_holds_every_difference(period):
    cover = COVERS[period]
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


@pytest.mark.parametrize("seed", range(3))
def test_brute_force(documents, seed):
    shared = [words(100 + i, 25 + 7 * i) for i in range(4)]
    table = []
    for i in range(60):
        text = words(seed * 1000 + i, 40)
        for k in range(i % 3):
            text[k * 11 : k * 11] = shared[(i + k) % 4][: 18 + (i + k) % 20]
        table.append((i * 3 % 50, " ".join(text)))  # some ids occur twice
    got = without_repeats(documents(*table), chunk_bytes=2_000)
    assert rows(got, "doc_id", "n_words", "n_removed", "kept") == brute_force(table, 20)


def test_small_window(documents):
    table = [(i, " ".join(words(i, 30, 3))) for i in range(30)]
    got = without_repeats(documents(*table), window=7, period=7, chunk_bytes=500)
    assert rows(got, "doc_id", "n_words", "n_removed", "kept") == brute_force(table, 7)


def test_odd_rows(documents, odd_texts):
    table = [(i if i != 3 else None, t) for i, t in enumerate(odd_texts)] + [(8, odd_texts[8]), (None, odd_texts[8])]
    got = without_repeats(documents(*table), chunk_bytes=1_000)
    digests = [(a, b, c, hashlib.sha256(d.encode()).hexdigest()) for a, b, c, d in rows(got, "doc_id", "n_words", "n_removed", "kept")]
    assert digests == [(a, b, c, hashlib.sha256(d.encode()).hexdigest()) for a, b, c, d in brute_force(table, 20)]


def test_one_passage_in_all(documents):
    passage = " ".join(words(7, 40))
    table = [(i, f"{passage} tail {i}") for i in range(80)]
    got = rows(without_repeats(documents(*table), chunk_bytes=400), "doc_id", "n_removed")
    assert got == sorted([(0, 0), *((i, 41) for i in range(1, 80))], key=str)  # the word after it is shared too


def test_empty_table(documents):
    assert without_repeats(documents()).collect() == []


def test_words_built_to_collide(documents):
    """Thue-Morse words and their complements have equal polynomial hashes modulo 2**64, whatever the base."""
    bits = [bin(i).count("1") % 2 for i in range(4096)]
    one, other = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    rest = " ".join(words(5, 19))
    table = [(1, f"{one} {rest}"), (2, f"{other} {rest}"), (3, f"{one} {rest}")]
    got = without_repeats(documents(*table), chunk_bytes=1_000)
    assert rows(got, "doc_id", "n_words", "n_removed", "kept") == brute_force(table, 20)
    assert dict(rows(got, "doc_id", "n_removed")) == {1: 0, 2: 0, 3: 20}
