import random

import pytest

#: Columns that the operators use themselves; a table may have them too.
CLASHING = {c: "clash" for c in ("digest", "size", "shard", "slot", "score", "lang_pred", "block", "pass", "row", "fp0", "id", "start", "chunk", "cell")}


@pytest.fixture(scope="session")
def documents(spark):
    """documents((doc_id, text[, lang[, source]]), ...): a table with the columns of documents and clashing ones."""

    def make(*rows, clash=True):
        more = CLASHING if clash else {}
        full = []
        for row in rows:
            doc_id, text, lang, source = (*row, None, None)[:4]
            full.append((doc_id, text, lang, source, None if text is None else len(text), *more.values()))
        schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", {c} string" for c in more)
        return spark.createDataFrame(full, schema)

    return make


def words(seed: int, n: int, vocabulary: int = 400) -> list[str]:
    random_ = random.Random(seed)
    return [f"w{random_.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="session")
def odd_texts():
    """Texts that break things: null, empty, white space, one word, many blanks, control signs, very long, copies."""
    return [
        None,
        "",
        " \t\n ",
        "one",
        "two  words",
        "a\x1cb c d e　f",
        "\U0001f600 é́ É",
        "x" * 50_000,
        " ".join(words(1, 60_000)),
        "two  words",
        None,
        "",
    ]
