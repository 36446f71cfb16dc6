"""Streaming queries X1-X4: the stream runs to completion (availableNow) into
a parquet sink under the checkpoint folder; the query returns that table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerguard.operators.rules import apply_rules
from ledgerguard.plans.common import rnd
from ledgerguard.plans.registry import register
from ledgerguard.plans.sqlparts import FEAT_CTE, RULES_CTE, TXN_CTE, with_
from ledgerguard.streaming import card_stream as cs


def _features(spark, sf):
    path = cs.run_to_parquet(cs.asof_feature_stream(cs.read_event_stream(spark, f"{sf}/events.parquet")), "asof")
    return spark.read.parquet(path)


def _two_batches(spark, sf, files: int = 4):
    """The event stream in two micro-batches of ``files`` files each, in the order written."""
    from ledgerguard.plans.wide_queries import _sink_dir
    root = _sink_dir(spark, "two-batches")
    events = spark.read.parquet(f"{sf}/events.parquet")
    for name, part in (("a", events.where("event_id % 5 <> 0")), ("b", events.where("event_id % 5 = 0"))):
        part.repartition(files, "event_id").write.parquet(f"{root}/{name}")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(f"{root}/*")
    return spark.read.parquet(cs.run_to_parquet(cs.asof_feature_stream(stream), "asof"))


@register("x1_stream_asof_features", with_(FEAT_CTE, """
SELECT transaction_id, CAST(txn_count_1h AS BIGINT) AS txn_count_1h, round(amt_sum_1h, 6) AS amt_sum_1h,
       CAST(txn_count_24h AS BIGINT) AS txn_count_24h, round(amt_sum_24h, 6) AS amt_sum_24h,
       round(amount_z, 6) AS amount_z, round(time_since_last_s, 6) AS time_since_last_s,
       round(geo_dist_km, 3) AS geo_dist_km, mcc_novel FROM feat"""))
def x1_stream_asof_features(spark, sf):
    f = _features(spark, sf)
    on_time, _ = cs.split_late(f)
    return on_time.select("transaction_id", "txn_count_1h", rnd("amt_sum_1h").alias("amt_sum_1h"),
                          "txn_count_24h", rnd("amt_sum_24h").alias("amt_sum_24h"), rnd("amount_z").alias("amount_z"),
                          rnd("time_since_last_s").alias("time_since_last_s"),
                          rnd("geo_dist_km", 3).alias("geo_dist_km"), "mcc_novel")


@register("x2_stream_rules", with_(RULES_CTE, """
SELECT transaction_id, card_testing, velocity_spike, impossible_travel, rule_any FROM ruled"""))
def x2_stream_rules(spark, sf):
    f = _features(spark, sf)
    f = f.withColumns({"is_cnp": (F.col("channel") == "CNP").cast("int"),
                       "card_age_days": F.floor((F.col("ts_us") - F.col("issue_us")) / F.lit(86400e6)).cast("long")})
    r = apply_rules(cs.split_late(f)[0])
    return r.select("transaction_id", "card_testing", "velocity_spike", "impossible_travel", "rule_any")


@register("x3_stream_daily_windows", with_(TXN_CTE, """,
d AS (SELECT card_id, ts_us // 86400000000 AS day, count(*) AS txns, sum(amount_minor) AS m FROM txn GROUP BY ALL),
wm AS (SELECT max(ts_us) - 86400000000 AS watermark FROM txn)
SELECT day * 86400000000 AS window_start_us, card_id, txns, round(m / 100.0, 6) AS amount
FROM d, wm WHERE (day + 1) * 86400000000 <= watermark"""))
def x3_stream_daily_windows(spark, sf):
    path = cs.run_to_parquet(cs.daily_window_stream(cs.read_event_stream(spark, f"{sf}/events.parquet")), "daily")
    return spark.read.parquet(path).select("window_start_us", "card_id", "txns", rnd("amount").alias("amount"))


@register("x4_stream_late_side_output", with_(TXN_CTE, """,
seen AS (SELECT card_id, max(ROW(ts_us, transaction_id)) AS newest FROM txn WHERE transaction_id % 5 <> 0 GROUP BY card_id)
SELECT b.transaction_id, b.card_id, b.ts_us FROM txn b JOIN seen s ON b.card_id = s.card_id
WHERE b.transaction_id % 5 = 0 AND ROW(b.ts_us, b.transaction_id) <= s.newest"""))
def x4_stream_late_side_output(spark, sf):
    """Two batches: every fifth event arrives after all others; those not newer than their
    card's last event are late (state is carried from the first batch to the second)."""
    late = cs.split_late(_two_batches(spark, sf))[1]
    return late.select("transaction_id", "card_id", "ts_us")


@register("x1_stream_two_batches", with_(TXN_CTE, """,
seen AS (SELECT card_id, max(ROW(ts_us, transaction_id)) AS newest FROM txn WHERE transaction_id % 5 <> 0 GROUP BY card_id),
t AS (SELECT txn.* FROM txn LEFT JOIN seen USING (card_id)
      WHERE transaction_id % 5 <> 0 OR newest IS NULL OR ROW(ts_us, transaction_id) > newest)
SELECT a.transaction_id, CAST(count(b.transaction_id) FILTER (WHERE b.ts_us >= a.ts_us - 86400000000) AS BIGINT) AS txn_count_24h,
       round(coalesce(sum(b.amount_minor) FILTER (WHERE b.ts_us >= a.ts_us - 86400000000), 0) / 100.0, 6) AS amt_sum_24h
FROM t a LEFT JOIN t b ON a.card_id = b.card_id AND ROW(b.ts_us, b.transaction_id) < ROW(a.ts_us, a.transaction_id)
GROUP BY a.transaction_id"""))
def x1_stream_two_batches(spark, sf):
    """As-of features when a card's rows come in two batches (late ones take no part)."""
    on_time = cs.split_late(_two_batches(spark, sf))[0]
    return on_time.select("transaction_id", "txn_count_24h", rnd("amt_sum_24h").alias("amt_sum_24h"))


@register("x4_stream_late_rows")
def x4_stream_late_rows(spark, sf):
    """Late rows routed to the side output (none when the file is in time order)."""
    _, late = cs.split_late(_features(spark, sf))
    return late.select("transaction_id", "card_id", "ts_us")
