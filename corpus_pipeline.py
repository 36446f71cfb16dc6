"""The corpus pipeline: five stages, each on all that its predecessor kept.

Each stage is a function (spark, docs, sf_dir) -> DataFrame; its result is written as Parquet
and read again as the next one's docs.  All but the last return the columns of documents
(with ``n_chars`` brought up to date where the text changes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerguard.llm import language_id, length_buckets, line_templates, simhash_groups, suffix_dedup
from ledgerguard.llm.common import store, table
from ledgerguard.llm.pretokens import vocabulary_path

MIN_LANGUAGE_SCORE = 0.5


def _with_text(docs: DataFrame, columns: list[str]) -> DataFrame:
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long"))
    return docs.select(*columns)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language (no text, no letter, or no language with most of
    the probability) go."""
    found = language_id.identify(docs, vocabulary_path("byte_bpe_50k.tiktoken"))
    known = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    return found.where(known).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of recurring line templates go; every document stays."""
    return _with_text(line_templates.drop_recurring_lines(docs), docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the one with the smallest doc_id."""
    grouped = simhash_groups.simhash_components(docs, shingle=3, radius=3)
    return simhash_groups.keep_first_of_group(grouped, docs.columns)


def drop_repeated_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes covered by 50-byte strings of earlier documents go; every document stays."""
    cut = suffix_dedup.remove_repeats(docs, length=50, with_text=True)
    return _with_text(cut.withColumn("text", F.coalesce("kept_text", "text")), docs.columns)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length buckets and batches of the documents that are left."""
    return length_buckets.pack_texts(docs, vocabulary_path("byte_bpe_50k.json"), ["doc_id", "lang", "source"])


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("suffix_dedup", drop_repeated_bytes),
    ("packing", pack_documents),
]

#: not expressible in SQL (learned models, fingerprints, byte-level tokens); tests use brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
