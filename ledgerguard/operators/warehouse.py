"""Warehouse models P1-P3: staging view, per-card velocity mart, transaction fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerguard.functions.timecols import US_PER_DAY, US_PER_HOUR
from ledgerguard.operators import asof, hot_windows


def stg_transactions(raw: DataFrame) -> DataFrame:
    """Typed, cleaned rows; keeps amount >= 0 (drops NULL and negative amounts).

    ``raw`` needs the card-transaction columns plus ts_us / issue_us.
    """
    return raw.where(F.col("amount") >= 0).select(
        "transaction_id", "card_id", "merchant_id", "mcc",
        F.col("amount").cast("decimal(12,2)").alias("amount"),
        F.col("ts").alias("event_ts"),
        F.col("ts_us"),
        "lat", "lon",
        F.upper("channel").alias("channel"),
        F.col("card_issue_date"),
        F.col("issue_us"),
        "is_fraud",
    )


#: staging columns that the fact table takes along
_FACT_COLS = ("merchant_id", "mcc", "channel", "is_fraud", "card_issue_date")


def fct_card_velocity(stg: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Counts and sums over RANGE frames that include ALL peers of the current
    timestamp but not the row itself (SQL frame exclusion of the current row), and
    seconds since the previous row (NULL for the first).

    Spark has no frame exclusion, so: count over [now - w, now] minus one, and the
    sum over the same frame minus the row's own amount.  Each frame is written as
    the difference of two unbounded-preceding RANGE frames (rows with ts <= now,
    minus rows with ts < now - w), which Spark evaluates incrementally; a sliding
    frame would re-aggregate every row of the frame for every row.  ``keep``: other columns of
    ``stg`` to take along.
    """
    r = Window.partitionBy("card_id").orderBy("ts_us")
    upto = r.rangeBetween(Window.unboundedPreceding, 0)
    amt = F.col("amount")

    def frame_count(width):
        older = r.rangeBetween(Window.unboundedPreceding, -(width + 1))
        return F.count(F.lit(1)).over(upto) - F.count(F.lit(1)).over(older)

    def frame_sum(width):
        older = r.rangeBetween(Window.unboundedPreceding, -(width + 1))
        return F.sum(amt).over(upto) - F.coalesce(F.sum(amt).over(older), F.lit(0))
    lag_ts = F.lag("ts_us").over(Window.partitionBy("card_id").orderBy("ts_us", "transaction_id"))
    return stg.select(
        "transaction_id", "card_id", "event_ts", "ts_us", "amount", *keep,
        (frame_count(US_PER_HOUR) - 1).cast("long").alias("txn_count_1h"),
        (frame_sum(US_PER_HOUR) - amt).cast("decimal(22,2)").alias("amt_sum_1h"),
        (frame_count(US_PER_DAY) - 1).cast("long").alias("txn_count_24h"),
        (frame_sum(US_PER_DAY) - amt).cast("decimal(22,2)").alias("amt_sum_24h"),
        ((F.col("ts_us") - lag_ts) / F.lit(1_000_000.0)).alias("time_since_last_s"),
    )


def fct_transactions(stg: DataFrame, velocity: DataFrame | None = None) -> DataFrame:
    """Staging LEFT JOIN velocity USING (transaction_id) plus derived flags.

    Without ``velocity`` the mart is computed here and its windows take the other columns along,
    so nothing is joined: both hold each staging row once.  A given (stored) mart is joined on
    the unique transaction key.
    """
    if velocity is None:
        fact = fct_card_velocity_skew_safe(stg, keep=_FACT_COLS)
    else:
        v = velocity.select("transaction_id", "txn_count_1h", "amt_sum_1h", "txn_count_24h",
                            "amt_sum_24h", "time_since_last_s")
        fact = stg.join(v, "transaction_id", "left")
    hour = F.hour("event_ts")
    return fact.select(
        "transaction_id", "card_id", "merchant_id", "mcc", "amount", "event_ts", "ts_us",
        "channel", "is_fraud",
        "txn_count_1h", "amt_sum_1h", "txn_count_24h", "amt_sum_24h", "time_since_last_s",
        hour.alias("event_hour"),
        hour.between(0, 5).cast("int").alias("is_night"),
        (F.col("channel") == "CNP").cast("int").alias("is_cnp"),
        F.datediff(F.to_date("event_ts"), F.to_date("card_issue_date")).alias("card_age_days"),
    )


def _card_velocity_hot(stg: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """P2 for hot cards by prefix sums: a frame with all peers is what came up to the row's own
    time, less what came up to the frame's lower edge."""
    cents = F.round(F.col("amount") * 100).cast("long")
    v = hot_windows.with_prior(hot_windows.identified(stg), ["card_id"], "ts_us", "transaction_id", {"c": cents},
                               {"now": 0, "1h": US_PER_HOUR + 1, "24h": US_PER_DAY + 1}, ["ts_us"])

    def frame(width):
        total = F.col("_s_c_now") - F.col(f"_s_c_{width}") - cents
        return (F.col("_n_now") - F.col(f"_n_{width}") - 1).cast("long"), (
            total.cast("decimal(20,0)") / F.lit(100)).cast("decimal(22,2)")
    (c1, s1), (c24, s24) = frame("1h"), frame("24h")
    return v.select("transaction_id", "card_id", "event_ts", "ts_us", "amount", *keep, c1.alias("txn_count_1h"), s1.alias("amt_sum_1h"),
                    c24.alias("txn_count_24h"), s24.alias("amt_sum_24h"),
                    ((F.col("ts_us") - F.col("_prev.ts_us")) / F.lit(1_000_000.0)).alias("time_since_last_s"))


def fct_card_velocity_skew_safe(stg: DataFrame, hot_keys=None, min_rows: int = 1_000_000,
                                keep: Sequence[str] = ()) -> DataFrame:
    """P2 with hot cards spread over all tasks; identical to ``fct_card_velocity``."""
    from ledgerguard.operators.features import detect_hot_keys
    hot = detect_hot_keys(stg, "card_id", min_rows) if hot_keys is None else list(hot_keys)
    if not hot:
        return fct_card_velocity(stg, keep)
    hot_rows, other_rows = asof.split_hot(stg, F.col("card_id"), hot)
    plain = fct_card_velocity(other_rows, keep)
    return plain.unionByName(_card_velocity_hot(hot_rows, keep).select(*plain.columns))
