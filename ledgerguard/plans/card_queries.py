"""Queries over the card-transaction table: F*, P*, R*, K*, V*."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerguard.functions.geo import haversine_km
from ledgerguard.functions.timecols import US_PER_DAY
from ledgerguard.operators import warehouse
from ledgerguard.operators.rules import DEFAULT_RULE_NAMES, Rule, apply_rules, rule_precision
from ledgerguard.plans.common import card_featured, card_rowwise, card_ruled, card_scored, card_txn, rnd
from ledgerguard.plans.registry import register
from ledgerguard.plans.sqlparts import FEAT_CTE, RULES_CTE, TXN_CTE, with_


# ---------------------------------------------------------------- F: features
@register("f1_velocity", with_(FEAT_CTE, """
SELECT transaction_id, CAST(txn_count_1h AS BIGINT) AS txn_count_1h,
       CAST(txn_count_24h AS BIGINT) AS txn_count_24h FROM feat"""))
def f1_velocity(spark, sf):
    return card_featured(spark, sf).select("transaction_id", "txn_count_1h", "txn_count_24h")


@register("f2_amount_sums", with_(FEAT_CTE, """
SELECT transaction_id, round(amt_sum_1h, 6) AS amt_sum_1h, round(amt_sum_24h, 6) AS amt_sum_24h FROM feat"""))
def f2_amount_sums(spark, sf):
    return card_featured(spark, sf).select("transaction_id", rnd("amt_sum_1h").alias("amt_sum_1h"),
                                           rnd("amt_sum_24h").alias("amt_sum_24h"))


@register("f3_amount_z", with_(FEAT_CTE, """
SELECT transaction_id, round(amount_z, 6) AS amount_z FROM feat"""))
def f3_amount_z(spark, sf):
    return card_featured(spark, sf).select("transaction_id", rnd("amount_z").alias("amount_z"))


@register("f4_time_since_last", with_(FEAT_CTE, """
SELECT transaction_id, round(time_since_last_s, 6) AS time_since_last_s FROM feat"""))
def f4_time_since_last(spark, sf):
    return card_featured(spark, sf).select("transaction_id", rnd("time_since_last_s").alias("time_since_last_s"))


@register("f5_haversine", with_(TXN_CTE, """
SELECT transaction_id,
       round(2 * 6371.0 * asin(sqrt(least(greatest(
         pow(sin(radians(lat - 40.6413) / 2), 2)
         + cos(radians(40.6413)) * cos(radians(lat)) * pow(sin(radians(lon - (-73.7781)) / 2), 2),
         0.0), 1.0))), 3) AS dist_to_hub_km
FROM txn"""))
def f5_haversine(spark, sf):
    """Distance of every transaction to a fixed hub (40.6413, -73.7781)."""
    t = card_txn(spark, sf)
    d = haversine_km(F.lit(40.6413), F.lit(-73.7781), F.col("lat"), F.col("lon"))
    return t.select("transaction_id", rnd(d, 3).alias("dist_to_hub_km"))


@register("f6_geo_distance", with_(FEAT_CTE, """
SELECT transaction_id, round(geo_dist_km, 3) AS geo_dist_km FROM feat"""))
def f6_geo_distance(spark, sf):
    return card_featured(spark, sf).select("transaction_id", rnd("geo_dist_km", 3).alias("geo_dist_km"))


@register("f7_geo_speed", with_(FEAT_CTE, """
SELECT transaction_id, round(geo_speed_kmh, 3) AS geo_speed_kmh FROM feat"""))
def f7_geo_speed(spark, sf):
    return card_featured(spark, sf).select("transaction_id", rnd("geo_speed_kmh", 3).alias("geo_speed_kmh"))


@register("f8_mcc_novel", with_(FEAT_CTE, """
SELECT transaction_id, mcc_novel FROM feat"""))
def f8_mcc_novel(spark, sf):
    return card_featured(spark, sf).select("transaction_id", "mcc_novel")


@register("f9_time_flags", with_(FEAT_CTE, """
SELECT transaction_id, hour, is_night, is_cnp FROM feat"""))
def f9_time_flags(spark, sf):
    return card_rowwise(spark, sf).select("transaction_id", "hour", "is_night", "is_cnp")


@register("f10_card_age", with_(FEAT_CTE, """
SELECT transaction_id, CAST(card_age_days AS BIGINT) AS card_age_days FROM feat"""))
def f10_card_age(spark, sf):
    return card_rowwise(spark, sf).select("transaction_id", "card_age_days")


_F11_SQL_COLS = """transaction_id, amount, CAST(txn_count_1h AS BIGINT) AS txn_count_1h,
       round(amt_sum_1h, 6) AS amt_sum_1h, CAST(txn_count_24h AS BIGINT) AS txn_count_24h,
       round(amt_sum_24h, 6) AS amt_sum_24h, round(amount_z, 6) AS amount_z,
       round(time_since_last_s, 6) AS time_since_last_s, round(geo_dist_km, 3) AS geo_dist_km,
       round(geo_speed_kmh, 3) AS geo_speed_kmh, mcc_novel, hour, is_night, is_cnp,
       CAST(card_age_days AS BIGINT) AS card_age_days"""


def _f11_spark(df):
    return df.select(
        "transaction_id", "amount", "txn_count_1h", rnd("amt_sum_1h").alias("amt_sum_1h"),
        "txn_count_24h", rnd("amt_sum_24h").alias("amt_sum_24h"), rnd("amount_z").alias("amount_z"),
        rnd("time_since_last_s").alias("time_since_last_s"), rnd("geo_dist_km", 3).alias("geo_dist_km"),
        rnd("geo_speed_kmh", 3).alias("geo_speed_kmh"), "mcc_novel", "hour", "is_night", "is_cnp",
        "card_age_days")


@register("f11_feature_table", with_(FEAT_CTE, f"SELECT {_F11_SQL_COLS} FROM feat"))
def f11_feature_table(spark, sf):
    return _f11_spark(card_featured(spark, sf))


@register("f12_feature_table_hot_split", with_(FEAT_CTE, f"SELECT {_F11_SQL_COLS} FROM feat"))
def f12_feature_table_hot_split(spark, sf):
    """F1-F11 with the hot-key split exercised: cards with >= 70 rows (the
    busiest cards at every scale of the test tables) take the prefix-sum path."""
    from ledgerguard.operators.features import add_card_features_skew_safe
    return _f11_spark(add_card_features_skew_safe(card_txn(spark, sf), min_rows=70))


# every third row on one card and one day, so that this card is hot within the day
HOT_DAY_CTE = TXN_CTE.replace("txn AS (", "spread AS (", 1) + """,
txn AS (SELECT * REPLACE (CASE WHEN transaction_id % 3 = 0 THEN 1 ELSE card_id END AS card_id,
    CASE WHEN transaction_id % 3 = 0 THEN 1704067200000000 + ts_us % 86400000000 ELSE ts_us END AS ts_us) FROM spread)"""


def hot_day_txn(spark, sf):
    moved = F.col("transaction_id") % 3 == 0
    ts_us = F.when(moved, F.lit(1704067200000000) + F.pmod("ts_us", F.lit(US_PER_DAY))).otherwise(F.col("ts_us"))
    txn = card_txn(spark, sf).withColumns({"card_id": F.when(moved, F.lit(1)).otherwise(F.col("card_id")), "ts_us": ts_us})
    return txn.withColumn("ts", F.timestamp_micros("ts_us"))


@register("f13_feature_table_hot_day", with_(HOT_DAY_CTE + FEAT_CTE[len(TXN_CTE):], f"SELECT {_F11_SQL_COLS} FROM feat"))
def f13_feature_table_hot_day(spark, sf):
    """F1-F11 where a card holds a third of all rows within one day."""
    from ledgerguard.operators.features import add_card_features_skew_safe
    return _f11_spark(add_card_features_skew_safe(hot_day_txn(spark, sf), hot_keys=[1]))


# ------------------------------------------------------- P: warehouse models
STG_SQL = """stg AS (
  SELECT transaction_id, card_id, merchant_id, mcc, CAST(amount AS DECIMAL(12,2)) AS amount, ts_us,
         lat, lon, upper(channel) AS channel, issue_us, is_fraud
  FROM txn WHERE amount >= 0
)"""


@register("p1_stg_transactions", with_(TXN_CTE + "," + STG_SQL, """
SELECT transaction_id, card_id, CAST(amount AS DOUBLE) AS amount, ts_us, channel, is_fraud FROM stg"""))
def p1_stg_transactions(spark, sf):
    s = warehouse.stg_transactions(card_txn(spark, sf))
    return s.select("transaction_id", "card_id", F.col("amount").cast("double").alias("amount"),
                    "ts_us", "channel", "is_fraud")


# brute force: every row meets the other rows of its card
VEL_SQL = """vel AS (
  SELECT a.transaction_id, a.card_id, a.ts_us, a.amount,
    count(b.transaction_id) FILTER (WHERE a.ts_us - b.ts_us BETWEEN 0 AND 3600000000) AS txn_count_1h,
    coalesce(sum(b.amount) FILTER (WHERE a.ts_us - b.ts_us BETWEEN 0 AND 3600000000), 0) AS amt_sum_1h,
    count(b.transaction_id) FILTER (WHERE a.ts_us - b.ts_us BETWEEN 0 AND 86400000000) AS txn_count_24h,
    coalesce(sum(b.amount) FILTER (WHERE a.ts_us - b.ts_us BETWEEN 0 AND 86400000000), 0) AS amt_sum_24h,
    (a.ts_us - max(b.ts_us) FILTER (WHERE b.ts_us < a.ts_us OR (b.ts_us = a.ts_us AND b.transaction_id < a.transaction_id)))
      / 1000000.0 AS time_since_last_s
  FROM stg a LEFT JOIN stg b ON a.card_id IS NOT DISTINCT FROM b.card_id AND a.transaction_id <> b.transaction_id
  GROUP BY a.transaction_id, a.card_id, a.ts_us, a.amount
)"""


@register("p2_card_velocity", with_(TXN_CTE + "," + STG_SQL + "," + VEL_SQL, """
SELECT transaction_id, CAST(txn_count_1h AS BIGINT) AS txn_count_1h, CAST(amt_sum_1h AS DOUBLE) AS amt_sum_1h,
       CAST(txn_count_24h AS BIGINT) AS txn_count_24h, CAST(amt_sum_24h AS DOUBLE) AS amt_sum_24h,
       round(time_since_last_s, 6) AS time_since_last_s
FROM vel"""))
def p2_card_velocity(spark, sf):
    v = warehouse.fct_card_velocity_skew_safe(warehouse.stg_transactions(card_txn(spark, sf)))
    return v.select("transaction_id", "txn_count_1h", F.col("amt_sum_1h").cast("double").alias("amt_sum_1h"),
                    "txn_count_24h", F.col("amt_sum_24h").cast("double").alias("amt_sum_24h"),
                    rnd("time_since_last_s").alias("time_since_last_s"))


@register("p2_card_velocity_hot_split", with_(TXN_CTE + "," + STG_SQL + "," + VEL_SQL, """
SELECT transaction_id, CAST(txn_count_1h AS BIGINT) AS txn_count_1h, CAST(amt_sum_1h AS DOUBLE) AS amt_sum_1h,
       CAST(txn_count_24h AS BIGINT) AS txn_count_24h, CAST(amt_sum_24h AS DOUBLE) AS amt_sum_24h,
       round(time_since_last_s, 6) AS time_since_last_s
FROM vel"""))
def p2_card_velocity_hot_split(spark, sf):
    """P2 with the hot-card split exercised (cards with >= 70 rows)."""
    v = warehouse.fct_card_velocity_skew_safe(warehouse.stg_transactions(card_txn(spark, sf)), min_rows=70)
    return v.select("transaction_id", "txn_count_1h", F.col("amt_sum_1h").cast("double").alias("amt_sum_1h"),
                    "txn_count_24h", F.col("amt_sum_24h").cast("double").alias("amt_sum_24h"),
                    rnd("time_since_last_s").alias("time_since_last_s"))


@register("p2_card_velocity_null_cards", with_(TXN_CTE + "," + STG_SQL.replace(
    "card_id, merchant_id", "CASE WHEN transaction_id % 10 <> 0 THEN card_id END AS card_id, merchant_id", 1) + "," + VEL_SQL, """
SELECT transaction_id, CAST(txn_count_1h AS BIGINT) AS txn_count_1h, CAST(amt_sum_1h AS DOUBLE) AS amt_sum_1h,
       CAST(txn_count_24h AS BIGINT) AS txn_count_24h, CAST(amt_sum_24h AS DOUBLE) AS amt_sum_24h,
       round(time_since_last_s, 6) AS time_since_last_s
FROM vel"""))
def p2_card_velocity_null_cards(spark, sf):
    """P2 with the hot split where every tenth row has no card: the rows without a card are one
    (hot) group, and none of them is lost."""
    txn = card_txn(spark, sf).withColumn("card_id", F.when(F.col("transaction_id") % 10 != 0, F.col("card_id")))
    v = warehouse.fct_card_velocity_skew_safe(warehouse.stg_transactions(txn), min_rows=70)
    return v.select("transaction_id", "txn_count_1h", F.col("amt_sum_1h").cast("double").alias("amt_sum_1h"),
                    "txn_count_24h", F.col("amt_sum_24h").cast("double").alias("amt_sum_24h"),
                    rnd("time_since_last_s").alias("time_since_last_s"))


@register("p2_card_velocity_hot_day", with_(HOT_DAY_CTE + "," + STG_SQL + "," + VEL_SQL, """
SELECT transaction_id, CAST(txn_count_1h AS BIGINT) AS txn_count_1h, CAST(amt_sum_1h AS DOUBLE) AS amt_sum_1h,
       CAST(txn_count_24h AS BIGINT) AS txn_count_24h, CAST(amt_sum_24h AS DOUBLE) AS amt_sum_24h,
       round(time_since_last_s, 6) AS time_since_last_s
FROM vel"""))
def p2_card_velocity_hot_day(spark, sf):
    """P2 where a card holds a third of all rows within one day."""
    v = warehouse.fct_card_velocity_skew_safe(warehouse.stg_transactions(hot_day_txn(spark, sf)), hot_keys=[1])
    return v.select("transaction_id", "txn_count_1h", F.col("amt_sum_1h").cast("double").alias("amt_sum_1h"),
                    "txn_count_24h", F.col("amt_sum_24h").cast("double").alias("amt_sum_24h"),
                    rnd("time_since_last_s").alias("time_since_last_s"))


@register("p3_fct_transactions", with_(TXN_CTE + "," + STG_SQL + "," + VEL_SQL, """
SELECT s.transaction_id, s.card_id, CAST(s.amount AS DOUBLE) AS amount, s.channel,
       CAST(v.txn_count_24h AS BIGINT) AS txn_count_24h,
       CAST((s.ts_us // 3600000000) % 24 AS INTEGER) AS event_hour,
       CAST((s.ts_us // 3600000000) % 24 BETWEEN 0 AND 5 AS INTEGER) AS is_night,
       CAST(s.channel = 'CNP' AS INTEGER) AS is_cnp,
       CAST(s.ts_us // 86400000000 - s.issue_us // 86400000000 AS INTEGER) AS card_age_days
FROM stg s LEFT JOIN vel v USING (transaction_id)"""))
def p3_fct_transactions(spark, sf):
    stg = warehouse.stg_transactions(card_txn(spark, sf))
    fct = warehouse.fct_transactions(stg)
    return fct.select("transaction_id", "card_id", F.col("amount").cast("double").alias("amount"), "channel",
                      "txn_count_24h", "event_hour", "is_night", "is_cnp", "card_age_days")


# --------------------------------------------------------------- R: rules
def _rule_query(name):
    def q(spark, sf):
        return card_ruled(spark, sf).where(F.col(name) == 1).select("transaction_id", "card_id", "amount")
    return q


for _name in DEFAULT_RULE_NAMES:
    _rid = {"card_testing": "r1", "high_amount_new_card": "r2", "impossible_travel": "r3",
            "velocity_spike": "r4"}[_name]
    register(f"{_rid}_{_name}", with_(RULES_CTE, f"""
SELECT transaction_id, card_id, amount FROM ruled WHERE {_name} = 1"""))(_rule_query(_name))


@register("r0_custom_rules", with_(FEAT_CTE, """
SELECT transaction_id, CAST(amount >= 20 AND is_cnp = 1 AS INTEGER) AS big_online,
       CAST(coalesce(mcc_novel = 1 AND time_since_last_s < 600, FALSE) AS INTEGER) AS new_category_fast,
       round((1 * CAST(amount >= 20 AND is_cnp = 1 AS INTEGER)
              + 3 * CAST(coalesce(mcc_novel = 1 AND time_since_last_s < 600, FALSE) AS INTEGER)) / 4.0, 6) AS rule_score
FROM feat"""))
def r0_custom_rules(spark, sf):
    """A catalogue of one's own beside the default one."""
    mine = [Rule("big_online", "large online payment", 1, (F.col("amount") >= 20) & (F.col("is_cnp") == 1)),
            Rule("new_category_fast", "first payment in a category, minutes after the last", 3,
                 (F.col("mcc_novel") == 1) & (F.col("time_since_last_s") < 600))]
    r = apply_rules(card_featured(spark, sf), mine)
    return r.select("transaction_id", "big_online", "new_category_fast", rnd("rule_score").alias("rule_score"))


@register("r5_apply_rules", with_(RULES_CTE, """
SELECT transaction_id, card_testing, high_amount_new_card, impossible_travel, velocity_spike,
       rule_any, round(rule_score, 6) AS rule_score FROM ruled"""))
def r5_apply_rules(spark, sf):
    return card_ruled(spark, sf).select("transaction_id", "card_testing", "high_amount_new_card",
                                        "impossible_travel", "velocity_spike", "rule_any",
                                        rnd("rule_score").alias("rule_score"))


@register("r6_rule_precision", with_(RULES_CTE, """,
tot AS (SELECT sum(is_fraud) AS total_fraud,
          sum(card_testing) AS a0, sum(card_testing * is_fraud) AS t0,
          sum(high_amount_new_card) AS a1, sum(high_amount_new_card * is_fraud) AS t1,
          sum(impossible_travel) AS a2, sum(impossible_travel * is_fraud) AS t2,
          sum(velocity_spike) AS a3, sum(velocity_spike * is_fraud) AS t3 FROM ruled),
longf AS (
  SELECT 0 AS rule_order, 'card_testing' AS rule, a0 AS alerts, t0 AS tp, total_fraud FROM tot UNION ALL
  SELECT 1, 'high_amount_new_card', a1, t1, total_fraud FROM tot UNION ALL
  SELECT 2, 'impossible_travel', a2, t2, total_fraud FROM tot UNION ALL
  SELECT 3, 'velocity_spike', a3, t3, total_fraud FROM tot)
SELECT rule_order, rule, CAST(alerts AS BIGINT) AS alerts, CAST(tp AS BIGINT) AS true_positives,
       round(CASE WHEN alerts > 0 THEN tp / alerts END, 6) AS precision,
       round(CASE WHEN total_fraud > 0 THEN tp / total_fraud END, 6) AS recall_contrib
FROM longf"""))
def r6_rule_precision(spark, sf):
    rp = rule_precision(card_ruled(spark, sf))
    return rp.select("rule_order", "rule", "alerts", "true_positives", rnd("precision").alias("precision"),
                     rnd("recall_contrib").alias("recall_contrib"))


@register("r7_reason_codes", with_(RULES_CTE, """
SELECT transaction_id, reason_codes FROM ruled"""))
def r7_reason_codes(spark, sf):
    return card_ruled(spark, sf).select("transaction_id", "reason_codes")


# ------------------------------------------------------------ flagship entry
def flagship_queue(spark, sf, top: int = 20):
    """As-of features -> rules -> stand-in score -> expected-loss queue head."""
    from ledgerguard.operators.scoring import rank_queue
    q = rank_queue(card_scored(spark, sf), score_col="model_score")
    return (q.select("transaction_id", "card_id", "ts_us", "amount", rnd("risk_score").alias("risk_score"),
                     rnd("expected_loss").alias("expected_loss"), "rule_score", "reason_codes")
            .orderBy(F.desc("expected_loss"), F.asc("transaction_id")).limit(top))
