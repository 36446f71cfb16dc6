"""Queries over the wide e-commerce tables: S*, E*, G*, Q*."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerguard.operators import investigate as inv
from ledgerguard.operators import rings
from ledgerguard.operators.wide_features import RING_INPUTS, add_ring_features, add_row_features, add_wide_features
from ledgerguard.plans.card_queries import STG_SQL, VEL_SQL
from ledgerguard.plans.common import card_txn, rnd
from ledgerguard.plans.registry import register
from ledgerguard.plans.sqlparts import FEAT_CTE, RING_CTE, TXN_CTE, WIDE_CTE, with_
from ledgerguard.session import cut_lineage
from ledgerguard.sources import readers
from ledgerguard.sources.adapters import load_wide


def wide_normalised(spark, sf):
    tx, idn = load_wide(spark, sf)
    return readers.normalise_wide(tx, idn)


def wide_featured(spark, sf, only=None):
    return add_wide_features(wide_normalised(spark, sf), only=only)[0]


def wide_rowwise(spark, sf):
    return add_row_features(wide_normalised(spark, sf))


def ring_featured(spark, sf):
    return add_ring_features(wide_normalised(spark, sf).select(*RING_INPUTS))


@register("e7_device_prior_hot_split", with_(WIDE_CTE, """
SELECT TransactionID, round(coalesce(CAST(device_prior_txn AS DOUBLE), -1.0), 6) AS device_prior_txn,
       round(coalesce(CAST(device_prior_cards AS DOUBLE), -1.0), 6) AS device_prior_cards,
       round(coalesce(CAST(device_fp_freq AS DOUBLE), -1.0), 6) AS device_fp_freq FROM wfeat"""))
def e7_device_prior_hot_split(spark, sf):
    """E7/E8 with the hot-fingerprint path exercised: fingerprints holding at
    least 2 % of the rows (the popular 'Windows' families) take the prefix-sum path."""
    n = wide_normalised(spark, sf)
    f = add_wide_features(n, hot_min_rows=max(1, int(0.02 * n.count())))[0]
    return f.select("TransactionID", *[rnd(c).alias(c) for c in ("device_prior_txn", "device_prior_cards",
                                                                "device_fp_freq")])


def _wide_tx_parts(spark, sf):
    tx, idn = load_wide(spark, sf)
    return tx, idn, readers.analyst_joined(tx, idn)


# ------------------------------------------------------------------ S: sources
@register("s2_identity_semi", with_(WIDE_CTE, """
SELECT TransactionID, DeviceInfo FROM idn WHERE TransactionID IN (SELECT TransactionID FROM tx)"""))
def s2_identity_semi(spark, sf):
    tx, idn = load_wide(spark, sf)
    return readers.restrict_identity(idn, tx).select("TransactionID", "DeviceInfo")


@register("s3_normalise_wide", with_(WIDE_CTE, """
SELECT TransactionID, ts_us, amount, is_fraud, DeviceInfo, id_31 FROM w"""))
def s3_normalise_wide(spark, sf):
    return wide_normalised(spark, sf).select("TransactionID", "ts_us", "amount", "is_fraud", "DeviceInfo", "id_31")


@register("s7_raw_source", with_(TXN_CTE, """
SELECT transaction_id, card_id, mcc, amount, ts_us, channel, is_fraud FROM txn"""))
def s7_raw_source(spark, sf):
    """Read back by the source's name."""
    name = readers.register_raw_source(card_txn(spark, sf))
    return spark.table(name).select("transaction_id", "card_id", "mcc", "amount", "ts_us", "channel", "is_fraud")


@register("s8_joined_view", with_(WIDE_CTE, """
SELECT TransactionID, card1, DeviceInfo, DeviceType, isFraud FROM tx LEFT JOIN idn USING (TransactionID)"""))
def s8_joined_view(spark, sf):
    _, _, joined = _wide_tx_parts(spark, sf)
    return joined.select("TransactionID", "card1", "DeviceInfo", "DeviceType", "isFraud")


# ------------------------------------------------------------------ E: features
def _feat(name, cols, doc="", build=None):
    sql = with_(WIDE_CTE, "SELECT TransactionID, " + ", ".join(
        f"round(coalesce(CAST({c} AS DOUBLE), -1.0), 6) AS {c}" for c in cols) + " FROM wfeat")

    def q(spark, sf):
        f = build(spark, sf) if build else wide_featured(spark, sf, cols)
        return f.select("TransactionID", *[rnd(c).alias(c) for c in cols])
    q.__doc__ = doc
    register(name, sql)(q)


def _str_feat(name, col):
    sql = with_(WIDE_CTE, f"SELECT TransactionID, {col} FROM wfeat")

    def q(spark, sf):
        return wide_rowwise(spark, sf).select("TransactionID", col)
    register(name, sql)(q)


_str_feat("e1_uid", "uid")
_str_feat("e2_device_fp", "device_fp")
_feat("e3_prior_count", ["uid_prior_txn"])
_feat("e4_prior_distinct", ["device_prior_cards"])
_feat("e5_uid_dynamics", ["uid_txn_24h", "uid_amt_24h", "uid_tsl_log", "uid_amount_z"])
_feat("e6_prior_txn", ["uid_prior_txn", "card1_prior_txn"])
_feat("e7_device_prior", ["device_prior_txn", "device_prior_cards"])
_feat("e8_device_fp_freq", ["device_fp_freq"])
_feat("e9_email_domain_freq", ["email_domain_freq"])
_feat("e10_card_freqs", ["card1_freq", "card2_freq", "card3_freq", "card5_freq", "addr1_freq"])
_feat("e11_card1_addr1_freq", ["card1_addr1_freq"])
_str_feat("e12_client_key", "client_key")
_feat("e13_client_counts", ["client_prior_txn", "client_freq"])
_feat("e14_card1_prior_mean", ["card1_prior_amt_mean", "amt_to_card1_mean"])
_feat("e15_amount_transforms", ["amount_log", "amount_cents"], build=wide_rowwise)
_feat("e16_time_parts", ["hour", "dayofweek", "is_night"], build=wide_rowwise)
_feat("e17_has_identity", ["has_identity"], build=wide_rowwise)
_feat("e18_passthrough", ["C1", "C2", "D1", "D2", "dist1", "V1", "V2", "id_01"], build=wide_rowwise)
_feat("e19_d_norm", ["D1_norm", "D2_norm"], build=wide_rowwise)
_feat("e20_product_onehot", ["pcd_W", "pcd_C", "pcd_R", "pcd_H", "pcd_S"], build=wide_rowwise)
_feat("e21_first_appearance_codes", ["card4_code", "card6_code", "DeviceType_code", "M4_code", "M6_code",
                                     "id_31_code", "id_33_code"])
WIDE_FEATURES = ["amount_log", "amount_cents", "hour", "dayofweek", "is_night", "uid_txn_24h", "uid_amt_24h",
                 "uid_tsl_log", "uid_amount_z", "uid_prior_txn", "device_prior_txn", "device_prior_cards",
                 "device_fp_freq", "email_domain_freq", "card1_freq", "card1_prior_txn", "has_identity",
                 "addr1_freq", "client_prior_txn", "client_freq", "card1_prior_amt_mean", "amt_to_card1_mean",
                 "card2_freq", "card3_freq", "card5_freq", "card1_addr1_freq", "C1", "C2", "D1", "D2", "dist1",
                 "V1", "V2", "id_01", "D1_norm", "D2_norm", "pcd_W", "pcd_C", "pcd_R", "pcd_H", "pcd_S",
                 "card4_code", "card6_code", "DeviceType_code", "M4_code", "M6_code", "id_31_code", "id_33_code"]
_feat("e22_wide_feature_table", WIDE_FEATURES)


@register("e22_wide_feature_table_hot_split", with_(WIDE_CTE, "SELECT TransactionID, " + ", ".join(
    f"round(coalesce(CAST({c} AS DOUBLE), -1.0), 6) AS {c}" for c in WIDE_FEATURES) + " FROM wfeat"))
def e22_wide_feature_table_hot_split(spark, sf):
    """E1-E22 with both hot-key paths exercised: card1 values and fingerprints
    holding at least 0.1 % of the rows take the prefix-sum path."""
    n = wide_normalised(spark, sf)
    f = add_wide_features(n, hot_min_rows=max(2, int(0.001 * n.count())))[0]
    return f.select("TransactionID", *[rnd(c).alias(c) for c in WIDE_FEATURES])


# ------------------------------------------------------------------ G: rings
@register("g1_specific_device", with_(RING_CTE, """
SELECT TransactionID, device_prior_cards, round(device_fp_freq, 6) AS device_fp_freq FROM rings WHERE specific"""))
def g1_specific_device(spark, sf):
    f = ring_featured(spark, sf)
    return f.where(rings.specific_device(f)).select("TransactionID", "device_prior_cards",
                                                    rnd("device_fp_freq").alias("device_fp_freq"))


@register("g2_ring_reasons", with_(RING_CTE, """
SELECT TransactionID,
  CASE WHEN concat_ws('; ',
         CASE WHEN specific AND device_prior_cards >= 4 THEN 'device shared by ' || CAST(CAST(device_prior_cards AS BIGINT) AS VARCHAR) || '+ cards' END,
         CASE WHEN uid_txn_24h >= 5 THEN 'account velocity' END) = '' THEN 'model/anomaly only'
       ELSE concat_ws('; ',
         CASE WHEN specific AND device_prior_cards >= 4 THEN 'device shared by ' || CAST(CAST(device_prior_cards AS BIGINT) AS VARCHAR) || '+ cards' END,
         CASE WHEN uid_txn_24h >= 5 THEN 'account velocity' END) END AS ring_reason
FROM rings"""))
def g2_ring_reasons(spark, sf):
    f = ring_featured(spark, sf)
    return f.select("TransactionID", rings.ring_reason_codes(f).alias("ring_reason"))


@register("g3_ring_score", with_(RING_CTE, """
SELECT TransactionID, round(greatest(CASE WHEN specific THEN least(greatest(device_prior_cards / 10.0, 0.0), 1.0) ELSE 0.0 END,
                                     least(greatest(uid_txn_24h / 10.0, 0.0), 1.0)), 6) AS ring_score FROM rings"""))
def g3_ring_score(spark, sf):
    f = ring_featured(spark, sf)
    return f.select("TransactionID", rnd(rings.ring_rule_score(f)).alias("ring_score"))


@register("g4_confound_summary", with_(RING_CTE, """
SELECT count(*) AS rows, round(avg(is_fraud), 6) AS fraud_rate FROM rings WHERE NOT specific AND device_prior_cards >= 7"""))
def g4_confound_summary(spark, sf):
    return rings.confound_summary(ring_featured(spark, sf)).select("rows", rnd("fraud_rate").alias("fraud_rate"))


@register("g5_sharing_profile", with_(RING_CTE, """,
b AS (SELECT is_fraud, CASE WHEN device_prior_cards > -1 AND device_prior_cards <= 0 THEN '0'
                            WHEN device_prior_cards > 0 AND device_prior_cards <= 1 THEN '1'
                            WHEN device_prior_cards > 1 AND device_prior_cards <= 3 THEN '2-3'
                            WHEN device_prior_cards > 3 AND device_prior_cards <= 6 THEN '4-6'
                            WHEN device_prior_cards > 6 AND device_prior_cards <= 10000 THEN '7+' END AS bucket
      FROM rings WHERE specific)
SELECT bucket, round(avg(is_fraud), 6) AS fraud_rate, count(*) AS rows FROM b WHERE bucket IS NOT NULL GROUP BY bucket"""))
def g5_sharing_profile(spark, sf):
    p = rings.sharing_profile(ring_featured(spark, sf))
    return p.select("bucket", rnd("fraud_rate").alias("fraud_rate"), "rows")


@register("g6_ring_summary", with_(RING_CTE, """
SELECT count(*) AS rows, round(avg(is_fraud), 6) AS fraud_rate,
       round(coalesce(sum(amount_minor * is_fraud), 0) / 1000.0, 6) AS fraud_value
FROM rings WHERE specific AND device_prior_cards >= 4"""))
def g6_ring_summary(spark, sf):
    r = rings.ring_summary(ring_featured(spark, sf))
    return r.select("rows", rnd("fraud_rate").alias("fraud_rate"), rnd("fraud_value").alias("fraud_value"))


# ------------------------------------------------------------------ Q: analyst SQL
@register("q1_fraud_by_product", with_(WIDE_CTE, """
SELECT ProductCD, count(*) AS txns, CAST(sum(isFraud) AS BIGINT) AS frauds, round(avg(isFraud), 4) AS fraud_rate
FROM tx GROUP BY ProductCD"""))
def q1_fraud_by_product(spark, sf):
    tx, _, _ = _wide_tx_parts(spark, sf)
    return inv.fraud_by_product(tx)


@register("q2_devices_linking_cards", with_(WIDE_CTE, """
,
per_pair AS (SELECT DeviceInfo AS d, card1 AS c, count(*) AS n, sum(isFraud) AS f FROM joined GROUP BY DeviceInfo, card1),
per_device AS (SELECT d, sum(n) AS n, sum(f) AS f, count(c) AS cards FROM per_pair WHERE d IS NOT NULL GROUP BY d),
placed AS (SELECT *, row_number() OVER (ORDER BY cards DESC, d) AS place FROM per_device WHERE cards > 3)
SELECT d AS DeviceInfo, CAST(n AS BIGINT) AS txns, cards AS distinct_cards, CAST(f AS BIGINT) AS frauds,
       round(f / n, 3) AS fraud_rate FROM placed WHERE place <= 15"""))
def q2_devices_linking_cards(spark, sf):
    _, _, joined = _wide_tx_parts(spark, sf)
    return inv.devices_linking_cards(joined)


@register("q3_email_domains", with_(WIDE_CTE, """
,
per_pair AS (SELECT P_emaildomain AS e, card1 AS c, count(*) AS n, sum(isFraud) AS f FROM tx GROUP BY P_emaildomain, card1),
per_domain AS (SELECT e, sum(n) AS n, count(c) AS cards, round(sum(f) / sum(n), 3) AS rate FROM per_pair
               WHERE e IS NOT NULL GROUP BY e),
placed AS (SELECT *, row_number() OVER (ORDER BY rate DESC, e) AS place FROM per_domain WHERE n > 19)
SELECT e AS P_emaildomain, CAST(n AS BIGINT) AS txns, cards AS distinct_cards, rate AS fraud_rate FROM placed
WHERE place <= 15"""))
def q3_email_domains(spark, sf):
    tx, _, _ = _wide_tx_parts(spark, sf)
    return inv.email_domains(tx)


@register("q4_top_cards", with_(WIDE_CTE, """
,
running AS (SELECT card1, TransactionAmt, isFraud, count(*) OVER (PARTITION BY card1) AS n FROM tx),
placed AS (SELECT *, dense_rank() OVER (ORDER BY n DESC, card1) AS place FROM running)
SELECT card1, any_value(n) AS txns, round(sum(TransactionAmt), 2) AS total_amount, CAST(sum(isFraud) AS BIGINT) AS frauds
FROM placed WHERE place <= 15 GROUP BY card1"""))
def q4_top_cards(spark, sf):
    tx, _, _ = _wide_tx_parts(spark, sf)
    return inv.top_cards(tx)


@register("q5_round_amounts", with_(WIDE_CTE, """
SELECT CASE WHEN TransactionAmt = floor(TransactionAmt) THEN 'round' ELSE 'has_cents' END AS amount_type,
       count(*) AS txns, round(avg(isFraud), 4) AS fraud_rate FROM tx GROUP BY amount_type"""))
def q5_round_amounts(spark, sf):
    tx, _, _ = _wide_tx_parts(spark, sf)
    return inv.round_amounts(tx)


@register("q6_largest_ring", with_(WIDE_CTE, """,
pairs AS (SELECT DISTINCT DeviceInfo AS d, card1 AS c FROM joined WHERE DeviceInfo IS NOT NULL AND card1 IS NOT NULL),
sizes AS (SELECT d, count(*) AS cards FROM pairs GROUP BY d),
widest AS (SELECT min(d) AS d FROM sizes WHERE cards = (SELECT max(cards) FROM sizes)),
mine AS (SELECT *, row_number() OVER (ORDER BY TransactionDT, TransactionID) AS place FROM joined
         WHERE DeviceInfo = (SELECT d FROM widest))
SELECT DeviceInfo, card1, TransactionDT, TransactionAmt, isFraud, TransactionID FROM mine WHERE place <= 20"""))
def q6_largest_ring(spark, sf):
    _, _, joined = _wide_tx_parts(spark, sf)
    return inv.largest_ring(joined)



@register("e23_feature_list", with_(WIDE_CTE, """,
names AS (SELECT * FROM (VALUES """ + ", ".join(f"({i}, '{c}')" for i, c in enumerate(WIDE_FEATURES)) + """) t(position, feature))
SELECT position, feature, (SELECT count(*) FROM wfeat) AS rows FROM names"""))
def e23_feature_list(spark, sf):
    """The feature-list contract returned with the frame, with the row
    count of the featured table it describes."""
    f, cols = add_wide_features(wide_normalised(spark, sf))
    n = f.agg(F.count(F.lit(1)).alias("rows"))
    names = spark.createDataFrame(list(enumerate(cols)), "position int, feature string")
    return names.withColumn("rows", n.select("rows").scalar())


def _sink_dir(spark, name):
    import uuid
    from ledgerguard.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/sinks/{name}-{uuid.uuid4().hex[:12]}"


@register("s1_read_csv", with_(WIDE_CTE, """
SELECT TransactionID, isFraud, TransactionDT, TransactionAmt, card1, card2, P_emaildomain, D1, M4 FROM tx"""))
def s1_read_csv(spark, sf):
    """S5 writes the competition-shaped CSV pair; S1 reads it back with the
    header-driven explicit schema."""
    tx, idn = load_wide(spark, sf)
    root = _sink_dir(spark, "csv")
    readers.write_csv_pair(tx, idn, root)
    back = readers.read_transaction_csv(spark, f"{root}/train_transaction")
    return back.select("TransactionID", "isFraud", "TransactionDT", "TransactionAmt", "card1", "card2",
                       "P_emaildomain", "D1", "M4")


@register("s5_csv_sink", with_(WIDE_CTE, """
SELECT TransactionID, DeviceType, DeviceInfo, id_01, id_31, id_33 FROM idn"""))
def s5_csv_sink(spark, sf):
    tx, idn = load_wide(spark, sf)
    root = _sink_dir(spark, "csv")
    readers.write_csv_pair(tx, idn, root)
    back = readers.read_identity_csv(spark, f"{root}/train_identity")
    return back.select("TransactionID", "DeviceType", "DeviceInfo", F.col("id_01").cast("double").alias("id_01"),
                       "id_31", "id_33")


@register("s6_parquet_sink", with_(FEAT_CTE, """
SELECT transaction_id, strftime(make_timestamp(ts_us), '%Y-%m-%d') AS event_date, amount, is_fraud,
       CAST(txn_count_24h AS BIGINT) AS txn_count_24h, round(amt_sum_24h, 6) AS amt_sum_24h,
       round(amount_z, 6) AS amount_z, round(time_since_last_s, 6) AS time_since_last_s, mcc_novel FROM feat"""))
def s6_parquet_sink(spark, sf):
    """Featured table (all columns) written as parquet partitioned by event date, read back."""
    from ledgerguard.plans.common import card_featured
    root = _sink_dir(spark, "featured")
    readers.write_featured_parquet(card_featured(spark, sf), root)
    back = spark.read.parquet(root)
    return back.select("transaction_id", F.col("event_date").cast("string").alias("event_date"), "amount", "is_fraud",
                       "txn_count_24h", rnd("amt_sum_24h").alias("amt_sum_24h"), rnd("amount_z").alias("amount_z"),
                       rnd("time_since_last_s").alias("time_since_last_s"), "mcc_novel")


@register("s1_capped_csv", with_(WIDE_CTE, """,
first_rows AS (SELECT TransactionID FROM tx ORDER BY TransactionID LIMIT 500)
SELECT t.TransactionID, i.DeviceInfo FROM first_rows t LEFT JOIN idn i USING (TransactionID)"""))
def s1_capped_csv(spark, sf):
    """S1 with its row cap (a feature of the reader) and S2 on the capped rows, from CSV files."""
    tx, idn = load_wide(spark, sf)
    root = _sink_dir(spark, "csv")
    readers.write_csv_pair(tx, idn, root)
    few = readers.cap_rows(readers.read_transaction_csv(spark, f"{root}/train_transaction"), 500)
    own = readers.restrict_identity(readers.read_identity_csv(spark, f"{root}/train_identity"), few)
    return few.select("TransactionID").join(own.select("TransactionID", "DeviceInfo"), "TransactionID", "left")


@register("s8_views_without_identity", with_(WIDE_CTE, """
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS with_device FROM tx"""))
def s8_views_without_identity(spark, sf):
    """S8 through SQL text over the views, without an identity table."""
    tx, _ = load_wide(spark, sf)
    readers.register_analyst_views(spark, tx, None)
    return spark.sql("SELECT count(*) AS rows, count(DeviceInfo) + count(DeviceType) AS with_device FROM joined")


@register("s8_views_sql", with_(WIDE_CTE, """
SELECT ProductCD, CAST(sum(CASE WHEN DeviceInfo IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS with_device
FROM tx LEFT JOIN idn USING (TransactionID) GROUP BY ProductCD"""))
def s8_views_sql(spark, sf):
    """S8 through SQL text over the views."""
    tx, idn = load_wide(spark, sf)
    readers.register_analyst_views(spark, tx, idn)
    return spark.sql("SELECT ProductCD, count(DeviceInfo) AS with_device FROM joined GROUP BY ProductCD")


@register("s9_materialise_mart", with_(TXN_CTE + "," + STG_SQL + "," + VEL_SQL, """
SELECT transaction_id, CAST(txn_count_24h AS BIGINT) AS txn_count_24h FROM vel"""))
def s9_materialise_mart(spark, sf):
    """Staging as a view, the velocity mart as a table (parquet folder) read back."""
    from ledgerguard.operators import warehouse
    from ledgerguard.plans.common import card_txn
    stg = readers.materialise(warehouse.stg_transactions(card_txn(spark, sf)), "lg_stg_transactions", "view")
    mart = readers.materialise(warehouse.fct_card_velocity_skew_safe(stg), "lg_fct_card_velocity", "table",
                               path=_sink_dir(spark, "mart"))
    return mart.select("transaction_id", "txn_count_24h")


@register("s3_identity_key_check", with_(WIDE_CTE, """
SELECT TransactionID, count(*) AS n FROM idn GROUP BY TransactionID HAVING count(*) > 1"""))
def s3_identity_key_check(spark, sf):
    """S3 guard: identity keys that appear more than once would fan out the left
    join (expected: no rows)."""
    _, idn = load_wide(spark, sf)
    return readers.identity_key_duplicates(idn).select("TransactionID", F.col("count").alias("n"))


@register("e10_frequencies_asof", with_(WIDE_CTE, """,
fa AS (SELECT TransactionID,
  CASE WHEN card2 IS NULL THEN -1.0 ELSE row_number() OVER (PARTITION BY card2 ORDER BY ts_us, TransactionID) - 1 END AS card2_freq,
  CASE WHEN card3 IS NULL THEN -1.0 ELSE row_number() OVER (PARTITION BY card3 ORDER BY ts_us, TransactionID) - 1 END AS card3_freq,
  CASE WHEN card5 IS NULL THEN -1.0 ELSE row_number() OVER (PARTITION BY card5 ORDER BY ts_us, TransactionID) - 1 END AS card5_freq,
  CASE WHEN addr1 IS NULL THEN -1.0 ELSE row_number() OVER (PARTITION BY addr1 ORDER BY ts_us, TransactionID) - 1 END AS addr1_freq,
  CASE WHEN NOT email_valid THEN 0.0 ELSE row_number() OVER (PARTITION BY email ORDER BY ts_us, TransactionID) - 1 END AS email_domain_freq,
  row_number() OVER (PARTITION BY coalesce(CAST(card1 AS VARCHAR), 'na') || '_' || coalesce(CAST(addr1 AS VARCHAR), 'na')
                     ORDER BY ts_us, TransactionID) - 1 AS card1_addr1_freq
  FROM wk)
SELECT TransactionID, CAST(card2_freq AS DOUBLE) AS card2_freq, CAST(card3_freq AS DOUBLE) AS card3_freq,
       CAST(card5_freq AS DOUBLE) AS card5_freq, CAST(addr1_freq AS DOUBLE) AS addr1_freq,
       CAST(email_domain_freq AS DOUBLE) AS email_domain_freq, CAST(card1_addr1_freq AS DOUBLE) AS card1_addr1_freq FROM fa"""))
def e10_frequencies_asof(spark, sf):
    """E9-E11 in the leakage-free as-of scope (strictly earlier rows with the key)."""
    f = add_wide_features(wide_normalised(spark, sf), freq_scope="asof")[0]
    return f.select("TransactionID", "card2_freq", "card3_freq", "card5_freq", "addr1_freq", "email_domain_freq",
                    "card1_addr1_freq")


@register("p2_incremental_loads", with_(TXN_CTE + "," + STG_SQL + "," + VEL_SQL, """
SELECT transaction_id, CAST(txn_count_24h AS BIGINT) AS txn_count_24h, CAST(amt_sum_24h AS DOUBLE) AS amt_sum_24h,
       round(time_since_last_s, 6) AS time_since_last_s
FROM vel"""))
def p2_incremental_loads(spark, sf):
    """P2 / S9 in three loads (the later half, late rows, a repeat of the last days): equal to one load."""
    from ledgerguard.operators import incremental, warehouse
    stg = cut_lineage(warehouse.stg_transactions(card_txn(spark, sf)))
    lo, hi = stg.agg(F.min("ts_us"), F.max("ts_us")).first()
    half, late = (lo + hi) // 2, lo + (hi - lo) // 10
    folder = _sink_dir(spark, "mart")
    incremental.load_velocity(stg.where((F.col("ts_us") < half) & (F.col("ts_us") >= late)), folder)
    incremental.load_velocity(stg.where((F.col("ts_us") >= half) | (F.col("ts_us") < late)), folder)
    mart = incremental.load_velocity(stg.where(F.col("ts_us") >= hi - (hi - lo) // 20), folder)
    return mart.select("transaction_id", "txn_count_24h", F.col("amt_sum_24h").cast("double").alias("amt_sum_24h"),
                       rnd("time_since_last_s").alias("time_since_last_s"))


_CODED = ["card4", "card6", "DeviceType", "M4", "M6", "id_31", "id_33"]


@register("e21_growing_codes", with_(WIDE_CTE, """,
cut AS (SELECT (min(ts_us) + max(ts_us)) // 2 AS half FROM w),
v AS (""" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, ts_us, TransactionID FROM w" for c in _CODED) + """),
seen AS (SELECT column_name, value, CASE WHEN max(ts_us) >= (SELECT half FROM cut) THEN 1 ELSE 2 END AS load,
           min(ROW(ts_us, TransactionID)) FILTER (WHERE ts_us >= (SELECT half FROM cut)) AS late, min(ROW(ts_us, TransactionID)) AS early
         FROM v WHERE value IS NOT NULL GROUP BY column_name, value)
SELECT column_name, value, CAST(load AS INTEGER) AS load, row_number() OVER (PARTITION BY column_name ORDER BY load,
         CASE WHEN load = 1 THEN late ELSE early END, value) - 1 AS code FROM seen"""))
def e21_growing_codes(spark, sf):
    """E21 as a dictionary over two loads, the later half of the rows first: codes given once stay."""
    from ledgerguard.operators import incremental
    rows = cut_lineage(wide_normalised(spark, sf).select("TransactionID", "ts_us", *_CODED))
    lo, hi = rows.agg(F.min("ts_us"), F.max("ts_us")).first()
    folder, half = _sink_dir(spark, "codes"), (lo + hi) // 2
    incremental.grow_codes(rows.where(F.col("ts_us") >= half), _CODED, folder)
    return incremental.grow_codes(rows.where(F.col("ts_us") < half), _CODED, folder)


@register("s9_bucketed_mart", with_(TXN_CTE + "," + STG_SQL + "," + VEL_SQL, """
SELECT transaction_id, CAST(txn_count_1h AS BIGINT) AS txn_count_1h, CAST(txn_count_24h AS BIGINT) AS txn_count_24h FROM vel"""))
def s9_bucketed_mart(spark, sf):
    """P2 over staging rows stored in buckets of the card: no Exchange before the windows."""
    from ledgerguard.operators import warehouse
    stg = readers.write_bucketed(warehouse.stg_transactions(card_txn(spark, sf)), "lg_stg_by_card", _sink_dir(spark, "buckets"),
                                 "card_id", ("ts_us", "transaction_id"), 8)
    return warehouse.fct_card_velocity(stg).select("transaction_id", "txn_count_1h", "txn_count_24h")
