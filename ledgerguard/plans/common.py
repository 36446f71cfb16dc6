"""Shared inputs of the registered queries (lazy DataFrames, nothing collected)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerguard.operators.features import add_card_features, add_card_features_skew_safe, detect_hot_keys
from ledgerguard.operators.rules import apply_rules, reason_codes
from ledgerguard.sources.adapters import load_card_transactions

STAND_IN_MODULUS = 9973
_HOT_CARDS: dict[tuple[str, str], list] = {}


def stand_in_score(minor: str = "amount_minor") -> Column:
    """Deterministic stand-in for a learned score (same text in the oracles)."""
    return (F.col(minor) % STAND_IN_MODULUS) / F.lit(float(STAND_IN_MODULUS))


def card_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_card_transactions(spark, sf_dir)


def card_featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card features; keys above the hot-key threshold take the per-day split path.  The keys
    are counted once per session and data set."""
    txn = card_txn(spark, sf_dir)
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _HOT_CARDS:
        _HOT_CARDS[at] = detect_hot_keys(txn)
    return add_card_features_skew_safe(txn, hot_keys=_HOT_CARDS[at])


def card_rowwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card features for queries that read only row-wise ones (the windows are pruned)."""
    return add_card_features(card_txn(spark, sf_dir))


def card_ruled(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = apply_rules(card_featured(spark, sf_dir))
    return r.withColumn("reason_codes", reason_codes())


def card_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return card_ruled(spark, sf_dir).withColumn("model_score", stand_in_score())


def rnd(c, nd: int = 6) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("double"), nd)
