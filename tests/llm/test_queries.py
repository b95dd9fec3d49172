import pytest
from conftest import SMALL

import __spark_entry__ as entry
import check
from reelmart.llm.queries import ORACLES, QUERIES

COLUMNS = {
    "op1_quality": ["doc_id", "held_out", "score", "predicted"],
    "op2_decontamination": ["doc_id", "item_id", "covered"],
    "op3_language": ["doc_id", "held_out", "lang_pred", "score"],
    "op4_winnowing": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op5_mixing": ["doc_id", "size", "source_size", "target", "taken"],
    "op6_chat": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    "op7_token_files": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op8_substrings": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op9_simhash": ["doc_id", "fingerprint", "component_id"],
    "op10_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op11_suffixes": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op12_search": ["item_id", "rank", "doc_id", "score"],
    "op13_whitening": ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
}


def test_all_are_registered():
    assert set(COLUMNS) == set(QUERIES) and set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(COLUMNS))
def test_columns_and_rows(spark, name):
    got = QUERIES[name](spark, SMALL)
    assert got.columns == COLUMNS[name]
    rows = got.count()
    if name == "op6_chat":
        assert rows == 1 + spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id").distinct().count()
    elif name == "op12_search":
        assert rows == 10 * spark.read.parquet(f"{SMALL}/benchmark.parquet").count()
    elif name == "op13_whitening":
        assert rows == 32 * spark.read.parquet(f"{SMALL}/embeddings.parquet").count()
    elif name != "op2_decontamination":
        assert rows == spark.read.parquet(f"{SMALL}/documents.parquet").count()


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    assert check.compare(spark, check.duck(SMALL), SMALL, name) == ""
