"""Column contracts of the transaction table and the wide e-commerce table."""

from __future__ import annotations

from pyspark.sql import types as T

# Card-transaction table (one row per authorisation attempt).
TXN_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.LongType(), False),
    T.StructField("card_id", T.LongType(), False),
    T.StructField("merchant_id", T.LongType(), True),
    T.StructField("mcc", T.IntegerType(), True),
    T.StructField("amount", T.DoubleType(), True),
    T.StructField("ts", T.TimestampNTZType(), True),
    T.StructField("lat", T.DoubleType(), True),
    T.StructField("lon", T.DoubleType(), True),
    T.StructField("channel", T.StringType(), True),
    T.StructField("card_issue_date", T.TimestampNTZType(), True),
    T.StructField("is_fraud", T.IntegerType(), True),
])

TXN_COLS = [f.name for f in TXN_SCHEMA.fields]

# Known columns of the wide transaction file; anything else is read as inferred.
WIDE_TX_KNOWN = {
    "TransactionID": T.LongType(), "isFraud": T.IntegerType(), "TransactionDT": T.LongType(),
    "TransactionAmt": T.DoubleType(), "ProductCD": T.StringType(), "card1": T.LongType(),
    "card2": T.DoubleType(), "card3": T.DoubleType(), "card4": T.StringType(),
    "card5": T.DoubleType(), "card6": T.StringType(), "addr1": T.DoubleType(),
    "addr2": T.DoubleType(), "dist1": T.DoubleType(), "dist2": T.DoubleType(),
    "P_emaildomain": T.StringType(), "R_emaildomain": T.StringType(),
}

WIDE_ID_KNOWN = {
    "TransactionID": T.LongType(), "DeviceType": T.StringType(), "DeviceInfo": T.StringType(),
}

# The feature list of the card pipeline, in order.
CARD_FEATURE_COLS = [
    "amount",
    "txn_count_1h", "amt_sum_1h",
    "txn_count_24h", "amt_sum_24h",
    "amount_z",
    "time_since_last_s",
    "geo_dist_km", "geo_speed_kmh",
    "mcc_novel",
    "hour", "is_night", "is_cnp",
    "card_age_days",
]
