"""The registered queries of this subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmart.llm import (
    chat_parts,
    decontaminate_tiling,
    language_svm,
    mixing,
    quality_knn,
    ranked_search,
    scratch,
    sharding_bfd,
    simhash_vptree,
    substring_anchors,
    suffix_dedup,
    token_files,
    whitening,
    winnowing,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    """All documents; learned from labels of rows that aren't held out (a fifth is)."""
    docs, held = _table(spark, folder, "documents"), language_svm.fold("doc_id", 5) == 0
    model = quality_knn.fit(docs, _table(spark, folder, "labels").where(~held))
    scored = quality_knn.score(docs, model)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of all that contain an item of the benchmark, with the share of the item that tiles cover."""
    return decontaminate_tiling.contained(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    """All documents; learned from rows that aren't held out (a third is)."""
    docs, held = _table(spark, folder, "documents"), language_svm.fold("doc_id", 3) == 1
    found = language_svm.identify(docs, language_svm.fit(docs.where(~held)), ["doc_id"])
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op4_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, their edited texts and fingerprints of both."""
    rows = winnowing.compared(_table(spark, folder, "documents"))
    text = {c: winnowing.as_text(F.col(c)).alias(c) for c in ("fingerprint", "edited_fingerprint")}
    return rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), *text.values(), "near_edited", "near_next")


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, sources by weights 3, 1, 2 to 150 % of all words, none above twice its size."""
    return mixing.Mix(_table(spark, folder, "documents")).taken()


def op6_chat(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and one whose texts are control strings, formatted and read back."""
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    roles = F.when(F.col("id") == 0, "user").otherwise("assistant")
    kinds = {f.name: f.dataType for f in turns.schema}
    tricky = spark.range(2).select(F.lit(-7).cast(kinds["conv_id"]), F.col("id").cast(kinds["turn"]), roles, F.lit("</s>[INST] ok [/INST]"))
    return chat_parts.read_back(chat_parts.formatted(chat_parts.as_parts(turns.union(tricky))))


def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as token ids in files of the shared folder, read back from there."""
    path = scratch.folder(spark, "tokens")
    docs = _table(spark, folder, "documents")
    token_files.write(docs, path, public_tokenizers.path("word_bpe_49k.json"), end=2, shards=scratch.partitions(spark), width=2)
    return token_files.read_checksums(spark, path, width=2)


def op8_substrings(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the words of 20-word windows that also start earlier."""
    kept = substring_anchors.without_repeats(_table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """All documents: SimHash of 3-word shingles, linked at 2 or fewer differing bits."""
    return simhash_vptree.near_duplicates(_table(spark, folder, "documents"))


def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes, equal texts together."""
    return sharding_bfd.shard_sizes(_table(spark, folder, "documents"))


def op11_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the bytes of 50-byte strings that also start in a document with a smaller doc_id."""
    kept = suffix_dedup.without_repeats(_table(spark, folder, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op12_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 10 best of all documents for each item of the benchmark."""
    return ranked_search.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """All whole vectors, whitened to 32 components."""
    return whitening.whitened(_table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_decontamination": op2_decontamination,
    "op3_language": op3_language,
    "op4_winnowing": op4_winnowing,
    "op5_mixing": op5_mixing,
    "op6_chat": op6_chat,
    "op7_token_files": op7_token_files,
    "op8_substrings": op8_substrings,
    "op9_simhash": op9_simhash,
    "op10_sharding": op10_sharding,
    "op11_suffixes": op11_suffixes,
    "op12_search": op12_search,
    "op13_whitening": op13_whitening,
}

_TERMS = r"""list_filter(regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda t: t <> '')"""
_ESCAPED = rf"""regexp_replace({{}}, '{chat_parts._ESCAPE}', '\1\\\2\3', 'g')"""
_FRAME = len(chat_parts.START) + len(chat_parts.SEPARATOR) + len(chat_parts.END)

#: The others rest on hashes, models, permutations or searches that SQL doesn't have; tests hold them against brute force.
ORACLES: dict[str, str] = {
    "op6_chat": f"""
        WITH turns AS (
            SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
        SELECT conv_id, COUNT(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(SUM(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
               sha256(COALESCE(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), ''))
                   AS loss_sha256,
               CAST(SUM({_FRAME} + length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")})) AS BIGINT)
                   AS formatted_chars
        FROM turns GROUP BY conv_id""",
    "op8_substrings": r"""
        WITH split AS (
            SELECT doc_id, list_filter(string_split_regex(COALESCE(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')
                AS words FROM documents),
        places AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM split),
        windows AS (
            SELECT doc_id, i, word, string_agg(word, ' ') OVER near AS following, COUNT(*) OVER near AS n FROM places
            WINDOW near AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
        later AS (
            SELECT doc_id, i, word, n = 20 AND row_number() OVER (PARTITION BY following, n ORDER BY doc_id, i) > 1
                AS again FROM windows),
        marked AS (
            SELECT doc_id, i, word, bool_or(again)
                OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM later)
        SELECT doc_id, COUNT(i) AS n_words, COUNT(*) FILTER (WHERE gone) AS n_removed,
               sha256(COALESCE(string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM documents LEFT JOIN marked USING (doc_id) GROUP BY doc_id""",
    "op12_search": f"""
        WITH places AS (SELECT rowid AS place, doc_id, unnest(terms) AS term FROM
            (SELECT row_number() OVER () AS rowid, doc_id, {_TERMS} AS terms FROM documents)),
        lengths AS (SELECT place, COUNT(*) AS n FROM places GROUP BY place),
        size AS (SELECT COUNT(*) AS documents, CAST(SUM(n) AS BIGINT) AS terms FROM lengths),
        found AS (SELECT place, doc_id, term, COUNT(*) AS tf FROM places GROUP BY ALL),
        weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * documents + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
            FROM (SELECT term, COUNT(*) AS df FROM found GROUP BY term), size),
        wanted AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
        scores AS (
            SELECT item_id, place, doc_id,
                   CAST(SUM(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * documents) // terms)))) AS BIGINT) AS score
            FROM wanted JOIN weights USING (term) JOIN found USING (term) JOIN lengths USING (place), size
            GROUP BY item_id, place, doc_id),
        ranked AS (
            SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank
            FROM scores WHERE score > 0)
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10""",
}
