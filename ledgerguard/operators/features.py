"""Card features F1-F11: as-of behaviour per card, in one window plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerguard.functions.geo import haversine_km
from ledgerguard.functions.timecols import US_PER_DAY, US_PER_HOUR
from ledgerguard.operators import asof, hot_windows
from ledgerguard.sources.schemas import CARD_FEATURE_COLS

# Fixed values of the card features.
FIRST_GAP_S = 30 * 86_400.0          # gap given to a card's first transaction
MIN_SPEED_HOURS = 1.0 / 60.0         # floor on elapsed hours in the speed feature
NIGHT_HOURS = (0, 5)                 # inclusive


def add_card_features(txn: DataFrame, key: str = "card_id") -> DataFrame:
    """Add F1-F10 to a card-transaction frame (needs ts_us, issue_us, amount_minor).

    All window columns share partitioning on ``key``: one Exchange, one Sort
    (plus a Sort for the (card, mcc) novelty window, no extra Exchange).
    """
    k = key
    prev_lat = asof.previous("lat", k)
    prev_lon = asof.previous("lon", k)
    gap = asof.gap_seconds(k, None)
    dist = F.coalesce(haversine_km(prev_lat, prev_lon, F.col("lat"), F.col("lon")), F.lit(0.0))
    tsl = F.coalesce(gap, F.lit(FIRST_GAP_S))
    speed = F.when(gap.isNull(), F.lit(0.0)).otherwise(
        dist / F.greatest(tsl / F.lit(3600.0), F.lit(MIN_SPEED_HOURS)))
    hour = F.hour("ts")
    return txn.select(
        "*",
        asof.prior_count_within(k, US_PER_HOUR).alias("txn_count_1h"),
        (asof.prior_sum_within("amount_minor", k, US_PER_HOUR) / F.lit(100.0)).alias("amt_sum_1h"),
        asof.prior_count_within(k, US_PER_DAY).alias("txn_count_24h"),
        (asof.prior_sum_within("amount_minor", k, US_PER_DAY) / F.lit(100.0)).alias("amt_sum_24h"),
        asof.prior_zscore("amount_minor", k).alias("amount_z"),
        tsl.alias("time_since_last_s"),
        dist.alias("geo_dist_km"),
        speed.alias("geo_speed_kmh"),
        asof.first_seen(k, "mcc").alias("mcc_novel"),
        hour.alias("hour"),
        hour.between(*NIGHT_HOURS).cast("int").alias("is_night"),
        (F.col("channel") == "CNP").cast("int").alias("is_cnp"),
        F.floor((F.col("ts_us") - F.col("issue_us")) / F.lit(float(US_PER_DAY))).cast("long")
         .alias("card_age_days"),
    )


def feature_matrix_cols() -> list[str]:
    """the feature-list contract, in order."""
    return list(CARD_FEATURE_COLS)


def select_features(featured: DataFrame, extra: tuple[str, ...] = ("transaction_id", "card_id", "ts_us", "is_fraud")) -> DataFrame:
    return featured.select(*extra, *CARD_FEATURE_COLS)


# Hot-key split.  A key holding a large share of all rows would put its whole history in one
# window partition (one task).  Hot keys take the prefix sums of ``hot_windows`` instead, which
# spread any key over all tasks.  The result is identical to the plain path (tested), so the two
# are unioned.


HOT_MIN_ROWS = 1_000_000


def detect_hot_keys(df: DataFrame, key: str = "card_id", min_rows: int = HOT_MIN_ROWS) -> list:
    """All keys with at least ``min_rows`` rows, the largest first, by a partially aggregated
    count (at most rows / ``min_rows`` of them); NULL is in the list if the rows without a
    key are that many."""
    rows = (df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_rows).collect())
    return [r[key] for r in sorted(rows, key=lambda r: -r["_n"])]


def _card_features_hot(txn: DataFrame, k: str) -> DataFrame:
    c = F.col("amount_minor")
    rows = hot_windows.identified(txn)
    values = {"c": c, "nn": c.isNotNull().cast("long")} | hot_windows.square_parts(c)
    out = hot_windows.with_prior(rows, [k], "ts_us", "transaction_id", values,
                                 {"1h": US_PER_HOUR + 1, "24h": US_PER_DAY + 1}, ["ts_us", "lat", "lon"])
    novel = hot_windows.first_of(rows, [k, "mcc"], "ts_us", "transaction_id").withColumn("_novel", F.lit(1))
    out = out.join(novel, hot_windows.UID, "left")
    z = hot_windows.exact_zscore(c, F.col("_s_nn"), F.col("_s_c"), hot_windows.square_sum(F.col("_s_sq_hi"), F.col("_s_sq_lo")))
    within = lambda w: (F.col("_n") - F.col(f"_n_{w}"), (F.col("_s_c") - F.col(f"_s_c_{w}")) / F.lit(100.0))
    (c1, s1), (c24, s24) = within("1h"), within("24h")
    gap = (F.col("ts_us") - F.col("_prev.ts_us")) / F.lit(1_000_000.0)
    dist = F.coalesce(haversine_km(F.col("_prev.lat"), F.col("_prev.lon"), F.col("lat"), F.col("lon")), F.lit(0.0))
    tsl = F.coalesce(gap, F.lit(FIRST_GAP_S))
    speed = F.when(gap.isNull(), F.lit(0.0)).otherwise(dist / F.greatest(tsl / F.lit(3600.0), F.lit(MIN_SPEED_HOURS)))
    hour = F.hour("ts")
    return out.select(
        *txn.columns, c1.alias("txn_count_1h"), s1.alias("amt_sum_1h"), c24.alias("txn_count_24h"), s24.alias("amt_sum_24h"),
        z.alias("amount_z"), tsl.alias("time_since_last_s"), dist.alias("geo_dist_km"), speed.alias("geo_speed_kmh"),
        F.coalesce("_novel", F.lit(0)).alias("mcc_novel"),
        hour.alias("hour"), hour.between(*NIGHT_HOURS).cast("int").alias("is_night"),
        (F.col("channel") == "CNP").cast("int").alias("is_cnp"),
        F.floor((F.col("ts_us") - F.col("issue_us")) / F.lit(float(US_PER_DAY))).cast("long").alias("card_age_days"))


def add_card_features_skew_safe(txn: DataFrame, key: str = "card_id", hot_keys=None,
                                min_rows: int = HOT_MIN_ROWS) -> DataFrame:
    """F1-F10 with hot keys spread over all tasks.  ``hot_keys``: a list, or None to
    detect keys with at least ``min_rows`` rows."""
    hot = detect_hot_keys(txn, key, min_rows) if hot_keys is None else list(hot_keys)
    if not hot:
        return add_card_features(txn, key)
    hot_rows, other_rows = asof.split_hot(txn, F.col(key), hot)
    plain = add_card_features(other_rows, key)
    split = _card_features_hot(hot_rows, key)
    return plain.unionByName(split.select(*plain.columns))
