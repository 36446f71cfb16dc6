"""DuckDB text of the adapters, used as leading CTEs by every oracle.

Oracles see only the raw parquet views, so each inlines its adapter.
"""

TXN_CTE = """
ev AS (
  SELECT event_id, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         epoch_us(ts) AS raw_us,
         CASE WHEN user_id % 10 = 0 THEN 60 ELSE 4 END AS q
  FROM events
),
txn AS (
  SELECT event_id AS transaction_id,
         user_id AS card_id,
         CAST(k + 1 AS BIGINT) AS merchant_id,
         CASE event_type WHEN 'click' THEN 5411 WHEN 'view' THEN 5812 WHEN 'signup' THEN 5999
                         WHEN 'purchase' THEN 5967 WHEN 'error' THEN 4829 END AS mcc,
         value AS amount,
         CAST(round(value * 100) AS BIGINT) AS amount_minor,
         1704067200000000 + (raw_us - 1704067200000000) // q AS ts_us,
         25 + (user_id * 31 % 2000) / 100 + (k % 20) / 100 + CASE WHEN k >= 95 THEN 8 ELSE 0 END AS lat,
         -120 + (user_id * 53 % 5000) / 100 - (k % 20) / 100 AS lon,
         CASE WHEN event_type IN ('click', 'purchase', 'error') THEN 'CNP' ELSE 'CP' END AS channel,
         1704067200000000 - (user_id * 37 % 900 + 5) * 86400000000 AS issue_us,
         CAST(event_type = 'error' AND k < 12 AS INTEGER) AS is_fraud
  FROM ev
)"""

# Card features computed independently of the Spark formulation: prior-window
# counts and sums by a brute-force self-join over each card's earlier rows.
FEAT_CTE = TXN_CTE + """,
pairs AS (
  SELECT a.transaction_id,
         count(b.transaction_id) AS n_prior,
         count(b.transaction_id) FILTER (WHERE b.ts_us >= a.ts_us - 3600000000) AS c1,
         coalesce(sum(b.amount_minor) FILTER (WHERE b.ts_us >= a.ts_us - 3600000000), 0) AS s1,
         count(b.transaction_id) FILTER (WHERE b.ts_us >= a.ts_us - 86400000000) AS c24,
         coalesce(sum(b.amount_minor) FILTER (WHERE b.ts_us >= a.ts_us - 86400000000), 0) AS s24,
         CAST(coalesce(sum(b.amount_minor), 0) AS HUGEINT) AS s_all,
         CAST(coalesce(sum(CAST(b.amount_minor AS HUGEINT) * b.amount_minor), 0) AS HUGEINT) AS q_all,
         count(b.transaction_id) FILTER (WHERE b.mcc = a.mcc) AS same_mcc
  FROM txn a LEFT JOIN txn b
    ON a.card_id = b.card_id
   AND (b.ts_us < a.ts_us OR (b.ts_us = a.ts_us AND b.transaction_id < a.transaction_id))
  GROUP BY a.transaction_id
),
prevrow AS (
  SELECT transaction_id,
         lag(ts_us) OVER (PARTITION BY card_id ORDER BY ts_us, transaction_id) AS prev_ts,
         lag(lat) OVER (PARTITION BY card_id ORDER BY ts_us, transaction_id) AS prev_lat,
         lag(lon) OVER (PARTITION BY card_id ORDER BY ts_us, transaction_id) AS prev_lon
  FROM txn
),
feat0 AS (
  SELECT t.*, p.n_prior, p.c1, p.s1, p.c24, p.s24, p.s_all, p.q_all, p.same_mcc,
         v.prev_ts, v.prev_lat, v.prev_lon,
         CASE WHEN v.prev_ts IS NULL THEN 2592000.0 ELSE (t.ts_us - v.prev_ts) / 1000000.0 END AS tsl,
         CASE WHEN v.prev_ts IS NULL THEN 0.0 ELSE
           2 * 6371.0 * asin(sqrt(least(greatest(
             pow(sin(radians(t.lat - v.prev_lat) / 2), 2)
             + cos(radians(v.prev_lat)) * cos(radians(t.lat)) * pow(sin(radians(t.lon - v.prev_lon) / 2), 2),
             0.0), 1.0))) END AS dist
  FROM txn t JOIN pairs p USING (transaction_id) JOIN prevrow v USING (transaction_id)
),
feat AS (
  SELECT transaction_id, card_id, merchant_id, mcc, amount, amount_minor, ts_us, lat, lon, channel,
         issue_us, is_fraud,
         c1 AS txn_count_1h, s1 / 100.0 AS amt_sum_1h,
         c24 AS txn_count_24h, s24 / 100.0 AS amt_sum_24h,
         CASE WHEN n_prior >= 2 AND n_prior * q_all - s_all * s_all > 0
              THEN CAST(n_prior * amount_minor - s_all AS DOUBLE) / sqrt(CAST(n_prior * q_all - s_all * s_all AS DOUBLE))
              ELSE 0.0 END AS amount_z,
         tsl AS time_since_last_s,
         dist AS geo_dist_km,
         CASE WHEN prev_ts IS NULL THEN 0.0 ELSE dist / greatest(tsl / 3600.0, 1.0 / 60.0) END AS geo_speed_kmh,
         CAST(same_mcc = 0 AS INTEGER) AS mcc_novel,
         CAST((ts_us // 3600000000) % 24 AS INTEGER) AS hour,
         CAST((ts_us // 3600000000) % 24 BETWEEN 0 AND 5 AS INTEGER) AS is_night,
         CAST(channel = 'CNP' AS INTEGER) AS is_cnp,
         (ts_us - issue_us) // 86400000000 AS card_age_days
  FROM feat0
)"""

RULES_CTE = FEAT_CTE + """,
hits AS (
  SELECT f.*,
         CAST(coalesce(txn_count_1h >= 5 AND amount <= 5.0 AND is_cnp = 1, false) AS INTEGER) AS card_testing,
         CAST(coalesce(amount >= 200.0 AND is_cnp = 1 AND card_age_days <= 60, false) AS INTEGER) AS high_amount_new_card,
         CAST(coalesce(geo_speed_kmh >= 900.0, false) AS INTEGER) AS impossible_travel,
         CAST(coalesce(txn_count_24h >= 20, false) AS INTEGER) AS velocity_spike
  FROM feat f
),
ruled AS (
  SELECT h.*,
         greatest(card_testing, high_amount_new_card, impossible_travel, velocity_spike) AS rule_any,
         (card_testing * 3 + high_amount_new_card * 2 + impossible_travel * 3 + velocity_spike * 2) / 10.0 AS rule_score,
         CASE WHEN concat_ws(', ',
                CASE WHEN card_testing = 1 THEN 'card_testing' END,
                CASE WHEN high_amount_new_card = 1 THEN 'high_amount_new_card' END,
                CASE WHEN impossible_travel = 1 THEN 'impossible_travel' END,
                CASE WHEN velocity_spike = 1 THEN 'velocity_spike' END) = ''
              THEN 'model/anomaly only'
              ELSE concat_ws(', ',
                CASE WHEN card_testing = 1 THEN 'card_testing' END,
                CASE WHEN high_amount_new_card = 1 THEN 'high_amount_new_card' END,
                CASE WHEN impossible_travel = 1 THEN 'impossible_travel' END,
                CASE WHEN velocity_spike = 1 THEN 'velocity_spike' END) END AS reason_codes
  FROM hits h
)"""

# Deterministic stand-in model score used wherever a learned score is needed.
SCORED_CTE = RULES_CTE + """,
scored AS (
  SELECT r.*, (amount_minor % 9973) / 9973.0 AS model_score
  FROM ruled r
)"""


def with_(cte: str, body: str) -> str:
    return "WITH " + cte.strip() + "\n" + body

WIDE_CTE = """
tx AS (
  SELECT o_orderkey AS TransactionID,
         CAST((o_orderkey * 7919) % 1000 < 35 AS INTEGER) AS isFraud,
         (epoch_us(o_orderdate) - 788918400000000) // 1000000 AS TransactionDT,
         o_totalprice AS TransactionAmt,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'W' WHEN '2' THEN 'C' WHEN '3' THEN 'R'
              WHEN '4' THEN 'H' WHEN '5' THEN 'S' END AS ProductCD,
         o_custkey AS card1, CAST(c_nationkey AS DOUBLE) AS card2, 150.0 AS card3,
         ['visa', 'mastercard', 'american express', 'discover'][o_custkey % 4 + 1] AS card4,
         CAST(100 + c_nationkey % 4 AS DOUBLE) AS card5,
         CASE WHEN o_custkey % 3 = 0 THEN 'debit' ELSE 'credit' END AS card6,
         CAST(c_nationkey AS DOUBLE) AS addr1,
         CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderkey % 500 AS DOUBLE) END AS dist1,
         lower(c_mktsegment) || '.com' AS P_emaildomain,
         CAST(o_custkey % 13 AS DOUBLE) AS C1, CAST(c_nationkey * 3 % 11 AS DOUBLE) AS C2,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey % 200 AS DOUBLE) END AS D1,
         CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE CAST(o_custkey % 30 AS DOUBLE) END AS D2,
         CAST(o_orderkey % 17 AS DOUBLE) AS V1, CAST(o_orderkey % 5 AS DOUBLE) AS V2,
         o_orderstatus AS M4, CASE WHEN o_orderkey % 2 = 0 THEN 'T' ELSE 'F' END AS M6
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
),
idn AS (
  SELECT l_orderkey AS TransactionID,
         CASE WHEN p % 2 = 0 THEN 'mobile' ELSE 'desktop' END AS DeviceType,
         CASE WHEN p % 4 = 0 THEN 'Windows' ELSE 'dev' || CAST(p AS VARCHAR) END AS DeviceInfo,
         CAST((p % 50) * -5 AS DOUBLE) AS id_01, id_31, id_33
  FROM (SELECT l_orderkey, min(l_partkey) AS p, min(l_returnflag) AS id_31, min(l_linestatus) AS id_33
        FROM lineitem GROUP BY l_orderkey)
  WHERE p % 3 <> 0
),
joined AS (SELECT tx.*, idn.DeviceType, idn.DeviceInfo, idn.id_01, idn.id_31, idn.id_33
           FROM tx LEFT JOIN idn USING (TransactionID)),
w AS (SELECT j.*, 1512086400000000 + TransactionDT * 1000000 AS ts_us, TransactionAmt AS amount,
             isFraud AS is_fraud, CAST(round(TransactionAmt * 1000) AS BIGINT) AS amount_minor,
             TransactionDT // 86400 AS day
      FROM joined j),
wk AS (
  SELECT w.*,
    concat_ws('-', coalesce(CAST(card1 AS VARCHAR), 'na'), coalesce(CAST(card2 AS VARCHAR), 'na'),
              coalesce(CAST(card3 AS VARCHAR), 'na'), coalesce(CAST(card5 AS VARCHAR), 'na'),
              coalesce(CAST(addr1 AS VARCHAR), 'na')) AS uid,
    coalesce(DeviceInfo, 'na') || '|' || coalesce(id_31, 'na') || '|' || coalesce(id_33, 'na') AS device_fp,
    coalesce(P_emaildomain, 'missing') AS email,
    DeviceInfo IS NOT NULL AS device_valid,
    P_emaildomain IS NOT NULL AS email_valid,
    coalesce(CAST(card1 AS VARCHAR), 'na') || '_' || coalesce(CAST(addr1 AS VARCHAR), 'na') || '_'
      || CAST(round_even(D1 - floor(TransactionDT / 86400), 0) + 0.0 AS VARCHAR) AS client_key
  FROM w
),
upairs AS (
  SELECT a.TransactionID,
    count(b.TransactionID) FILTER (WHERE b.ts_us >= a.ts_us - 86400000000) AS c24,
    coalesce(sum(b.amount_minor) FILTER (WHERE b.ts_us >= a.ts_us - 86400000000), 0) AS s24,
    count(b.TransactionID) AS n_prior,
    CAST(coalesce(sum(b.amount_minor), 0) AS HUGEINT) AS s_all,
    CAST(coalesce(sum(CAST(b.amount_minor AS HUGEINT) * b.amount_minor), 0) AS HUGEINT) AS q_all
  FROM wk a LEFT JOIN wk b ON a.uid = b.uid
   AND (b.ts_us < a.ts_us OR (b.ts_us = a.ts_us AND b.TransactionID < a.TransactionID))
  GROUP BY a.TransactionID
),
dpairs AS (
  SELECT a.TransactionID, count(DISTINCT b.card1) AS prior_cards
  FROM wk a LEFT JOIN wk b ON a.device_fp = b.device_fp AND b.device_valid
   AND (b.ts_us < a.ts_us OR (b.ts_us = a.ts_us AND b.TransactionID < a.TransactionID))
  WHERE a.device_valid
  GROUP BY a.TransactionID
),
firsts AS (
  SELECT col, value, row_number() OVER (PARTITION BY col ORDER BY ft, fi) - 1 AS code FROM (
    SELECT col, value, arg_min(ts_us, struct_pack(t := ts_us, i := TransactionID)) AS ft,
           arg_min(TransactionID, struct_pack(t := ts_us, i := TransactionID)) AS fi
    FROM (SELECT ts_us, TransactionID, 'card4' AS col, card4 AS value FROM wk UNION ALL
          SELECT ts_us, TransactionID, 'card6', card6 FROM wk UNION ALL
          SELECT ts_us, TransactionID, 'DeviceType', DeviceType FROM wk UNION ALL
          SELECT ts_us, TransactionID, 'M4', M4 FROM wk UNION ALL
          SELECT ts_us, TransactionID, 'M6', M6 FROM wk UNION ALL
          SELECT ts_us, TransactionID, 'id_31', id_31 FROM wk UNION ALL
          SELECT ts_us, TransactionID, 'id_33', id_33 FROM wk)
    WHERE value IS NOT NULL GROUP BY col, value)
),
wf AS (
  SELECT k.*,
    ln(1 + amount) AS amount_log,
    amount % 1.0 AS amount_cents,
    CAST((ts_us // 3600000000) % 24 AS INTEGER) AS hour,
    isodow(make_timestamp(ts_us)) - 1 AS dayofweek,
    CAST((ts_us // 3600000000) % 24 BETWEEN 0 AND 5 AS INTEGER) AS is_night,
    CAST(u.c24 AS DOUBLE) AS uid_txn_24h,
    u.s24 / 1000.0 AS uid_amt_24h,
    ln(1 + coalesce((ts_us - lag(ts_us) OVER (PARTITION BY uid ORDER BY ts_us, TransactionID)) / 1000000.0, 2592000.0)) AS uid_tsl_log,
    CASE WHEN u.n_prior >= 2 AND u.n_prior * u.q_all - u.s_all * u.s_all > 0
         THEN CAST(u.n_prior * amount_minor - u.s_all AS DOUBLE) / sqrt(CAST(u.n_prior * u.q_all - u.s_all * u.s_all AS DOUBLE))
         ELSE 0.0 END AS uid_amount_z,
    CAST(u.n_prior AS DOUBLE) AS uid_prior_txn,
    CASE WHEN device_valid THEN CAST(row_number() OVER (PARTITION BY device_fp, device_valid ORDER BY ts_us, TransactionID) - 1 AS DOUBLE) ELSE 0.0 END AS device_prior_txn,
    CASE WHEN device_valid THEN CAST(d.prior_cards AS DOUBLE) ELSE 0.0 END AS device_prior_cards,
    CASE WHEN device_valid THEN (count(*) OVER (PARTITION BY device_fp, device_valid)) / (count(*) OVER ()) ELSE 0.0 END AS device_fp_freq,
    CASE WHEN email_valid THEN CAST(count(*) OVER (PARTITION BY email) AS DOUBLE) ELSE 0.0 END AS email_domain_freq,
    CAST(count(*) OVER (PARTITION BY card1) AS DOUBLE) AS card1_freq,
    CAST(row_number() OVER (PARTITION BY card1 ORDER BY ts_us, TransactionID) - 1 AS DOUBLE) AS card1_prior_txn,
    CAST(device_valid AS INTEGER) AS has_identity,
    CASE WHEN addr1 IS NULL THEN -1.0 ELSE CAST(count(*) OVER (PARTITION BY addr1) AS DOUBLE) END AS addr1_freq,
    CASE WHEN client_key IS NULL THEN -1.0 ELSE CAST(row_number() OVER (PARTITION BY client_key ORDER BY ts_us, TransactionID) - 1 AS DOUBLE) END AS client_prior_txn,
    CASE WHEN client_key IS NULL THEN -1.0 ELSE CAST(count(*) OVER (PARTITION BY client_key) AS DOUBLE) END AS client_freq,
    (sum(amount_minor) OVER (PARTITION BY card1 ORDER BY ts_us, TransactionID ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
      / (row_number() OVER (PARTITION BY card1 ORDER BY ts_us, TransactionID) - 1) / 1000.0 AS _mean,
    CASE WHEN card2 IS NULL THEN -1.0 ELSE CAST(count(*) OVER (PARTITION BY card2) AS DOUBLE) END AS card2_freq,
    CASE WHEN card3 IS NULL THEN -1.0 ELSE CAST(count(*) OVER (PARTITION BY card3) AS DOUBLE) END AS card3_freq,
    CASE WHEN card5 IS NULL THEN -1.0 ELSE CAST(count(*) OVER (PARTITION BY card5) AS DOUBLE) END AS card5_freq,
    CAST(count(*) OVER (PARTITION BY coalesce(CAST(card1 AS VARCHAR), 'na') || '_' || coalesce(CAST(addr1 AS VARCHAR), 'na')) AS DOUBLE) AS card1_addr1_freq,
    coalesce(D1 - day, -1.0) AS D1_norm,
    coalesce(D2 - day, -1.0) AS D2_norm,
    CAST(coalesce(ProductCD = 'W', false) AS INTEGER) AS pcd_W, CAST(coalesce(ProductCD = 'C', false) AS INTEGER) AS pcd_C,
    CAST(coalesce(ProductCD = 'R', false) AS INTEGER) AS pcd_R, CAST(coalesce(ProductCD = 'H', false) AS INTEGER) AS pcd_H,
    CAST(coalesce(ProductCD = 'S', false) AS INTEGER) AS pcd_S,
    coalesce((SELECT code FROM firsts f WHERE f.col = 'card4' AND f.value = k.card4), -1) AS card4_code,
    coalesce((SELECT code FROM firsts f WHERE f.col = 'card6' AND f.value = k.card6), -1) AS card6_code,
    coalesce((SELECT code FROM firsts f WHERE f.col = 'DeviceType' AND f.value = k.DeviceType), -1) AS DeviceType_code,
    coalesce((SELECT code FROM firsts f WHERE f.col = 'M4' AND f.value = k.M4), -1) AS M4_code,
    coalesce((SELECT code FROM firsts f WHERE f.col = 'M6' AND f.value = k.M6), -1) AS M6_code,
    coalesce((SELECT code FROM firsts f WHERE f.col = 'id_31' AND f.value = k.id_31), -1) AS id_31_code,
    coalesce((SELECT code FROM firsts f WHERE f.col = 'id_33' AND f.value = k.id_33), -1) AS id_33_code
  FROM wk k JOIN upairs u USING (TransactionID) LEFT JOIN dpairs d USING (TransactionID)
),
wfeat AS (
  SELECT wf.*, coalesce(_mean, -1.0) AS card1_prior_amt_mean,
         CASE WHEN _mean > 0 THEN amount / _mean ELSE 1.0 END AS amt_to_card1_mean
  FROM wf
)"""

RING_CTE = WIDE_CTE + """,
rings AS (
  SELECT wfeat.*,
    (device_prior_cards > 0 AND device_fp_freq > 0 AND device_fp_freq < 0.002) AS specific
  FROM wfeat
)"""
