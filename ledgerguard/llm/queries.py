"""The registered queries of this subpackage: one ``opN_<name>`` per operator, each over
its whole table with production parameters, and the corpus pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerguard.llm import (centroid_bounds, chat_windows, language_id, length_buckets, line_templates, multiset_hash,
                             nbest_pieces, oracles, part_trie, projection_forest, simhash_groups, suffix_dedup, token_records,
                             token_rollup)
from ledgerguard.llm.common import scratch_path, table
from ledgerguard.llm.pretokens import vocabulary_path

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_templates.drop_recurring_lines(docs, with_text=False)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language_id.identify(docs, vocabulary_path("byte_bpe_50k.tiktoken"), keep_text=False)
    return found.select("doc_id", language_id.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    grouped = simhash_groups.simhash_components(docs, shingle=3, radius=3, keep_text=False)
    return grouped.select("doc_id", simhash_groups.fingerprint_hex("fp").alias("fingerprint"), "component_id")


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset_hash.document_fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return token_rollup.rollup_documents(docs, scratch_path(spark, "token-rollup"),
                                         vocabulary_path("byte_bpe_50k.json"))


def op6_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-records")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    token_records.write_token_records(docs, folder, vocabulary_path("byte_bpe_50k.json"), end_id=0)
    return token_records.read_token_records(spark, folder)


def op7_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection_forest.nearest(table(spark, sf_dir, "embeddings"), query_every=20, top=20)


def op8_nbest_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return nbest_pieces.encode_nbest(docs, vocabulary_path("piece_bpe_32k.model"), n=4)


def op9_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return length_buckets.pack_texts(docs, vocabulary_path("byte_bpe_50k.json"), ["doc_id"])


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs, length=50).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op11_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)], turns.schema)
    return chat_windows.conversation_digests(chat_windows.format_conversations(turns.unionByName(extra)))


def op12_centroid_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_bounds.cluster_vectors(table(spark, sf_dir, "embeddings"), k=8, rounds=10, dimension=64)


def op13_part_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_trie.compress_vectors(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2).drop("label")


QUERIES: dict[str, QueryFn] = {
    "op1_line_templates": op1_line_templates,
    "op2_language_id": op2_language_id,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_document_fingerprints": op4_document_fingerprints,
    "op5_token_rollup": op5_token_rollup,
    "op6_token_records": op6_token_records,
    "op7_projection_forest": op7_projection_forest,
    "op8_nbest_pieces": op8_nbest_pieces,
    "op9_length_buckets": op9_length_buckets,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_chat_windows": op11_chat_windows,
    "op12_centroid_bounds": op12_centroid_bounds,
    "op13_part_trie": op13_part_trie,
}

ORACLES: dict[str, str] = {
    "op1_line_templates": oracles.line_templates(),
    # bytes as pairs of hex digits
    "op10_suffix_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS p FROM d)),
low AS (SELECT s, min(doc_id) AS low FROM w GROUP BY s),
hit AS (SELECT w.doc_id, w.p, lag(w.p) OVER (PARTITION BY w.doc_id ORDER BY w.p) AS before
        FROM w JOIN low ON low.s = w.s WHERE low.low < w.doc_id),
island AS (SELECT doc_id, p, count(*) FILTER (WHERE before IS NULL OR p > before + 50)
             OVER (PARTITION BY doc_id ORDER BY p) AS g FROM hit),
span AS (SELECT doc_id, min(p) AS a, max(p) + 50 AS b FROM island GROUP BY doc_id, g),
total AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS spans, max(b) AS last FROM span GROUP BY doc_id),
piece AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS x, a AS y FROM span
          UNION ALL SELECT d.doc_id, coalesce(last, 0), n FROM d LEFT JOIN total ON total.doc_id = d.doc_id),
kept AS (SELECT d.doc_id, string_agg(substr(h, 2 * x + 1, 2 * (y - x)), '' ORDER BY x) AS k
         FROM piece JOIN d ON d.doc_id = piece.doc_id GROUP BY d.doc_id)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM d JOIN kept ON kept.doc_id = d.doc_id LEFT JOIN total ON total.doc_id = d.doc_id""",
    "op11_chat_windows": oracles.chat_windows(),
    "op12_centroid_bounds": oracles.centroid_rounds(),
    "op13_part_trie": oracles.part_codes(),
}
