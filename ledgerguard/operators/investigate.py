"""Analyst aggregates Q1-Q6 over the tx / joined views (DataFrame form).

LIMIT ties get a key tie-break so the result is deterministic.  The same
questions run as SQL text through ``spark.sql`` over the views of
``sources.readers.register_analyst_views``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fraud_by_product(tx: DataFrame) -> DataFrame:
    """Q1."""
    return tx.groupBy("ProductCD").agg(
        F.count(F.lit(1)).alias("txns"), F.sum("isFraud").cast("long").alias("frauds"),
        F.round(F.avg("isFraud"), 4).alias("fraud_rate")).orderBy(F.desc("fraud_rate"), "ProductCD")


def devices_linking_cards(joined: DataFrame, min_cards: int = 4, top: int = 15) -> DataFrame:
    """Q2: COUNT(DISTINCT card1) per device (Spark plans a partial aggregate on
    (device, card1) first, so a hot device does not collect its cards in one task)."""
    g = joined.where(F.col("DeviceInfo").isNotNull()).groupBy("DeviceInfo").agg(
        F.count(F.lit(1)).alias("txns"), F.countDistinct("card1").alias("distinct_cards"),
        F.sum("isFraud").cast("long").alias("frauds"), F.round(F.avg("isFraud"), 3).alias("fraud_rate"))
    return g.where(F.col("distinct_cards") >= min_cards).orderBy(
        F.desc("distinct_cards"), F.asc("DeviceInfo")).limit(top)


def email_domains(tx: DataFrame, min_txns: int = 20, top: int = 15) -> DataFrame:
    """Q3."""
    g = tx.where(F.col("P_emaildomain").isNotNull()).groupBy("P_emaildomain").agg(
        F.count(F.lit(1)).alias("txns"), F.countDistinct("card1").alias("distinct_cards"),
        F.round(F.avg("isFraud"), 3).alias("fraud_rate"))
    return g.where(F.col("txns") >= min_txns).orderBy(F.desc("fraud_rate"), F.asc("P_emaildomain")).limit(top)


def top_cards(tx: DataFrame, top: int = 15) -> DataFrame:
    """Q4."""
    return tx.groupBy("card1").agg(
        F.count(F.lit(1)).alias("txns"), F.round(F.sum("TransactionAmt"), 2).alias("total_amount"),
        F.sum("isFraud").cast("long").alias("frauds")).orderBy(F.desc("txns"), F.asc("card1")).limit(top)


def round_amounts(tx: DataFrame) -> DataFrame:
    """Q5."""
    t = F.when(F.col("TransactionAmt") == F.floor("TransactionAmt"), F.lit("round")).otherwise(F.lit("has_cents"))
    return tx.groupBy(t.alias("amount_type")).agg(
        F.count(F.lit(1)).alias("txns"), F.round(F.avg("isFraud"), 4).alias("fraud_rate")
    ).orderBy(F.desc("fraud_rate"))


def largest_ring(joined: DataFrame, rows: int = 20) -> DataFrame:
    """Q6: the device with the most distinct cards (1 row, so the join back is a
    broadcast of a one-row side), then its first rows by time."""
    top = (joined.where(F.col("DeviceInfo").isNotNull()).groupBy("DeviceInfo")
           .agg(F.countDistinct("card1").alias("distinct_cards"))
           .orderBy(F.desc("distinct_cards"), F.asc("DeviceInfo")).limit(1).select("DeviceInfo"))
    j = joined.join(F.broadcast(top), "DeviceInfo", "inner")
    return j.select("DeviceInfo", "card1", "TransactionDT", "TransactionAmt", "isFraud", "TransactionID") \
            .orderBy("TransactionDT", "TransactionID").limit(rows)
