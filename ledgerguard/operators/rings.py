"""Ring detection and explainability G1-G6 (Column predicates and aggregates)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerguard.operators.wide_features import GENERIC_DEVICE_FREQ

NO_REASON = "model/anomaly only"
# Sharing-bucket edges (lo, hi] and labels.
SHARING_BUCKETS = [(-1, 0, "0"), (0, 1, "1"), (1, 3, "2-3"), (3, 6, "4-6"), (6, 10000, "7+")]


def _num(df: DataFrame, c: str) -> Column:
    return F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in df.columns else F.lit(0.0)


def specific_device(df: DataFrame, generic_freq: float = GENERIC_DEVICE_FREQ) -> Column:
    """G1: the fingerprint links earlier cards and is rare (0 < freq < limit)."""
    freq, cards = _num(df, "device_fp_freq"), _num(df, "device_prior_cards")
    return (cards > 0) & (freq > 0) & (freq < F.lit(float(generic_freq)))


def ring_reason_codes(df: DataFrame, device_thr: int = 4, velocity_thr: int = 5,
                      generic_freq: float = GENERIC_DEVICE_FREQ) -> Column:
    """Gated device reason and account-velocity reason, joined '; '."""
    cards = _num(df, "device_prior_cards")
    dev = F.when(specific_device(df, generic_freq) & (cards >= device_thr),
                 F.concat(F.lit("device shared by "), cards.cast("long").cast("string"), F.lit("+ cards")))
    vel = F.when(_num(df, "uid_txn_24h") >= velocity_thr, F.lit("account velocity"))
    s = F.concat_ws("; ", dev, vel)
    return F.when(s == "", F.lit(NO_REASON)).otherwise(s)


def ring_rule_score(df: DataFrame, generic_freq: float = GENERIC_DEVICE_FREQ) -> Column:
    """max(specific ? clip(cards / 10) : 0, clip(uid_txn_24h / 10))."""
    clip = lambda c: F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))
    dev = F.when(specific_device(df, generic_freq), clip(_num(df, "device_prior_cards") / 10.0)).otherwise(F.lit(0.0))
    vel = clip(_num(df, "uid_txn_24h") / 10.0)
    return F.greatest(dev, vel)


def confound_summary(df: DataFrame, min_cards: int = 7, generic_freq: float = GENERIC_DEVICE_FREQ) -> DataFrame:
    """Rows on NON-specific fingerprints that still link >= min_cards cards."""
    sel = df.where(~specific_device(df, generic_freq) & (_num(df, "device_prior_cards") >= min_cards))
    return sel.agg(F.count(F.lit(1)).alias("rows"), F.avg("is_fraud").alias("fraud_rate"))


def sharing_bucket(col: Column) -> Column:
    out = F.lit(None).cast("string")
    for lo, hi, lab in reversed(SHARING_BUCKETS):
        out = F.when((col > lo) & (col <= hi), F.lit(lab)).otherwise(out)
    return out


def sharing_profile(df: DataFrame, generic_freq: float = GENERIC_DEVICE_FREQ) -> DataFrame:
    """Fraud rate and volume by cards-sharing bucket over specific rows."""
    sel = df.where(specific_device(df, generic_freq))
    b = sharing_bucket(_num(df, "device_prior_cards"))
    return (sel.groupBy(b.alias("bucket")).agg(F.avg("is_fraud").alias("fraud_rate"),
                                               F.count(F.lit(1)).alias("rows"))
            .where(F.col("bucket").isNotNull()))


def ring_summary(df: DataFrame, device_thr: int = 4, generic_freq: float = GENERIC_DEVICE_FREQ,
                 minor_per_unit: int = 1000) -> DataFrame:
    """Specific fingerprints with >= device_thr cards: rows, fraud rate, fraud value."""
    sel = df.where(specific_device(df, generic_freq) & (_num(df, "device_prior_cards") >= device_thr))
    return sel.agg(F.count(F.lit(1)).alias("rows"), F.avg("is_fraud").alias("fraud_rate"),
                   (F.coalesce(F.sum(F.col("amount_minor") * F.col("is_fraud")), F.lit(0)) / F.lit(float(minor_per_unit)))
                   .alias("fraud_value"))
