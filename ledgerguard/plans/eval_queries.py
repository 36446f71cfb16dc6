"""Queries over scored card transactions: K*, M6/M7, T1, A*, D*, V*.

The learned score is replaced by the deterministic stand-in (amount_minor %
9973) / 9973 so an exact oracle exists; the operators take any score column.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ledgerguard.operators import drift, evaluation as ev, quality, scoring, split
from ledgerguard.operators.ordering import POS, global_cumulative
from ledgerguard.plans.common import card_featured, card_scored, card_txn, rnd
from ledgerguard.plans.registry import register
from ledgerguard.plans.sqlparts import FEAT_CTE, SCORED_CTE, TXN_CTE, with_
from ledgerguard.session import cut_lineage

K_ALERTS = 100
CAPACITY = 50
BLEND_CANDIDATES = [(0.65, 0.25, 0.10), (0.8, 0.2, 0.0), (0.5, 0.5, 0.0), (0.9, 0.1, 0.0)]
FRESHNESS_NOW_US = 1_706_745_600_000_000      # 2024-02-01 00:00:00
DRIFT_FEATURES = ["amount", "txn_count_1h", "txn_count_24h", "amt_sum_24h", "amount_z",
                  "time_since_last_s", "hour", "card_age_days"]


def _scored(spark, sf):
    return card_scored(spark, sf).withColumn("score", F.col("model_score"))


# ------------------------------------------------------------------ K: queue
@register("k1_expected_loss", with_(SCORED_CTE, """
SELECT transaction_id, round(model_score, 6) AS risk_score, round(model_score * amount, 6) AS expected_loss
FROM scored"""))
def k1_expected_loss(spark, sf):
    s = _scored(spark, sf)
    return s.select("transaction_id", rnd("score").alias("risk_score"),
                    rnd(scoring.expected_loss("score")).alias("expected_loss"))


@register("k2_rank_queue", with_(SCORED_CTE, """
SELECT transaction_id, round(model_score * amount, 6) AS expected_loss, reason_codes,
       row_number() OVER (ORDER BY model_score * amount DESC, transaction_id) AS queue_rank
FROM scored"""))
def k2_rank_queue(spark, sf):
    q = scoring.rank_queue(_scored(spark, sf), "score")
    ranked = global_cumulative(q, [F.desc("expected_loss"), F.asc("transaction_id")],
                               keep=["transaction_id", "expected_loss", "reason_codes"])
    return ranked.select("transaction_id", rnd("expected_loss").alias("expected_loss"), "reason_codes",
                         F.col(POS).alias("queue_rank"))


@register("k3_queue_head", with_(SCORED_CTE, """
SELECT transaction_id, card_id, amount, round(model_score, 6) AS risk_score,
       round(model_score * amount, 6) AS expected_loss, reason_codes
FROM scored ORDER BY model_score * amount DESC, transaction_id LIMIT 10"""))
def k3_queue_head(spark, sf):
    q = scoring.rank_queue(_scored(spark, sf), "score")
    h = scoring.queue_head(q, 10)
    return h.select("transaction_id", "card_id", "amount", rnd("risk_score").alias("risk_score"),
                    rnd("expected_loss").alias("expected_loss"), "reason_codes")


@register("k4_top_k", with_(SCORED_CTE, f"""
SELECT transaction_id, round(model_score, 6) AS score
FROM scored ORDER BY model_score DESC, ts_us, transaction_id LIMIT {K_ALERTS}"""))
def k4_top_k(spark, sf):
    t = ev.top_k(_scored(spark, sf), K_ALERTS)
    return t.select("transaction_id", rnd("score").alias("score"))


@register("k5_capacity_threshold", with_(SCORED_CTE, f""",
top AS (SELECT model_score FROM scored ORDER BY model_score DESC LIMIT {K_ALERTS})
SELECT round(min(model_score), 6) AS threshold FROM top"""))
def k5_capacity_threshold(spark, sf):
    return ev.threshold_for_capacity(_scored(spark, sf), K_ALERTS).select(rnd("threshold").alias("threshold"))


_AP_SQL = """
g AS (SELECT model_score, count(*) AS n, sum(is_fraud) AS pos FROM scored GROUP BY model_score),
c AS (SELECT pos, sum(n) OVER (ORDER BY model_score DESC) AS cn, sum(pos) OVER (ORDER BY model_score DESC) AS cp FROM g),
ap AS (SELECT CASE WHEN (SELECT sum(is_fraud) FROM scored) > 0
             THEN sum(pos * (cp / cn)) / (SELECT sum(is_fraud) FROM scored) END AS pr_auc FROM c)"""

_ATK_SQL = f"""
topk AS (SELECT * FROM scored ORDER BY model_score DESC, ts_us, transaction_id LIMIT {{k}}),
atk AS (SELECT count(*) AS n_top, sum(is_fraud) AS hits, sum(amount_minor * is_fraud) AS hit_value,
               (SELECT sum(is_fraud) FROM scored) AS frauds,
               (SELECT sum(amount_minor * is_fraud) FROM scored) AS fraud_value FROM topk),
atk2 AS (SELECT {{k}} AS k,
  CASE WHEN n_top > 0 THEN coalesce(hits, 0) / n_top END AS precision_at_k,
  CASE WHEN frauds > 0 THEN coalesce(hits, 0) / frauds END AS recall_at_k,
  CASE WHEN fraud_value > 0 THEN coalesce(hit_value, 0) / fraud_value END AS value_recall_at_k FROM atk)"""


@register("k6_triage", with_(SCORED_CTE + "," + _ATK_SQL.format(k=CAPACITY) + "," + _AP_SQL, f"""
SELECT {CAPACITY} AS alerts, round(precision_at_k, 6) AS precision_at_cap,
       round(value_recall_at_k, 6) AS value_recall_at_cap, round(pr_auc, 6) AS pr_auc
FROM atk2, ap"""))
def k6_triage(spark, sf):
    _, kpi = scoring.triage(_scored(spark, sf), CAPACITY)
    return kpi.select("alerts", rnd("precision_at_cap").alias("precision_at_cap"),
                      rnd("value_recall_at_cap").alias("value_recall_at_cap"), rnd("pr_auc").alias("pr_auc"))


@register("k6_triage_queue", with_(SCORED_CTE, f"""
SELECT transaction_id, card_id, round(model_score, 6) AS risk_score, round(model_score * amount, 6) AS expected_loss,
       reason_codes FROM scored ORDER BY model_score * amount DESC, transaction_id LIMIT {CAPACITY}"""))
def k6_triage_queue(spark, sf):
    """K6: the queue slice that goes with the KPI row."""
    head, _ = scoring.triage(_scored(spark, sf), CAPACITY)
    return head.select("transaction_id", "card_id", rnd("risk_score").alias("risk_score"),
                       rnd("expected_loss").alias("expected_loss"), "reason_codes")


# ------------------------------------------------------------------ T1: split
_CUTS_SQL = """
cuts AS (SELECT quantile_cont(CAST(ts_us AS DOUBLE), 0.6) AS t1, quantile_cont(CAST(ts_us AS DOUBLE), 0.8) AS t2 FROM txn),
lab AS (SELECT t.*, CASE WHEN ts_us <= t1 THEN 'train' WHEN ts_us <= t2 THEN 'valid' ELSE 'test' END AS split
        FROM txn t, cuts)"""


@register("t1_time_split", with_(TXN_CTE + "," + _CUTS_SQL, """
SELECT split, count(*) AS rows, CAST(sum(is_fraud) AS BIGINT) AS frauds, min(ts_us) AS min_ts_us, max(ts_us) AS max_ts_us,
       CAST(floor(any_value(t1)) AS BIGINT) AS cut_train, CAST(floor(any_value(t2)) AS BIGINT) AS cut_valid
FROM lab, cuts GROUP BY split"""))
def t1_time_split(spark, sf):
    t = card_txn(spark, sf)
    t1, t2 = split.time_cuts(t)
    lab = split.label_split(t, t1, t2)
    return lab.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("is_fraud").cast("long").alias("frauds"),
        F.min("ts_us").alias("min_ts_us"), F.max("ts_us").alias("max_ts_us")).select(
        "*", F.lit(int(np.floor(t1))).cast("long").alias("cut_train"),
        F.lit(int(np.floor(t2))).cast("long").alias("cut_valid"))


# ------------------------------------------------------------------ M6 / M7
@register("m6_blend", with_(SCORED_CTE, """
SELECT transaction_id, round((0.0 + 0.65 * model_score + 0.25 * rule_score) / 0.9, 6) AS blend_score FROM scored"""))
def m6_blend(spark, sf):
    s = _scored(spark, sf)
    return s.select("transaction_id", rnd(scoring.blend("model_score", "rule_score")).alias("blend_score"))


# a deterministic third signal for the oracles (as the model score's stand-in)
_ODD = "(amount_minor % 97) / 97.0"


def _three_signals(spark, sf):
    return _scored(spark, sf).withColumn("anomaly_score", (F.col("amount_minor") % 97) / F.lit(97.0))


@register("m6_blend_three_signals", with_(SCORED_CTE, f"""
SELECT transaction_id, round((0.65 * model_score + 0.25 * rule_score + 0.10 * {_ODD}) / (0.65 + 0.25 + 0.10), 6)
       AS blend_score FROM scored"""))
def m6_blend_three_signals(spark, sf):
    s = _three_signals(spark, sf)
    return s.select("transaction_id", rnd(scoring.blend("model_score", "rule_score", "anomaly_score")).alias("blend_score"))


@register("m7_blend_select_three_signals", with_(SCORED_CTE, f""",
w AS (SELECT * FROM (VALUES {", ".join(f"({i}, {a}, {b}, {c})" for i, (a, b, c) in enumerate(BLEND_CANDIDATES))})
      t(cand, w_model, w_rule, w_anomaly)),
s AS (SELECT w.*, amount_minor * is_fraud AS v, row_number() OVER (PARTITION BY cand ORDER BY
        (w_model * model_score + w_rule * rule_score + w_anomaly * {_ODD}) / (w_model + w_rule + w_anomaly) DESC,
        ts_us, transaction_id) AS place FROM scored, w),
per AS (SELECT cand, w_model, w_rule, w_anomaly, sum(v) FILTER (WHERE place <= {K_ALERTS}) / sum(v) AS value_recall
        FROM s GROUP BY ALL)
SELECT cand, CAST(w_model AS DOUBLE) AS w_model, CAST(w_rule AS DOUBLE) AS w_rule, CAST(w_anomaly AS DOUBLE) AS w_anomaly,
       round(value_recall, 6) AS value_recall FROM per ORDER BY value_recall DESC, cand LIMIT 1"""))
def m7_blend_select_three_signals(spark, sf):
    sel = scoring.select_blend(_three_signals(spark, sf), BLEND_CANDIDATES, K_ALERTS, anomaly="anomaly_score")
    return sel.select("cand", "w_model", "w_rule", "w_anomaly", rnd("value_recall").alias("value_recall"))


def _cand_sql():
    rows = []
    for i, (a, b, c) in enumerate(BLEND_CANDIDATES):
        rows.append(f"SELECT {i} AS cand, {a} AS w_model, {b} AS w_rule, {c} AS w_anomaly, "
                    f"transaction_id, ts_us, is_fraud, amount_minor, "
                    f"(0.0 + {a} * model_score + {b} * rule_score) / {a + b!r} AS s FROM scored")
    return "\nUNION ALL\n".join(rows)


@register("m7_blend_select", with_(SCORED_CTE, f""",
cand AS ({_cand_sql()}),
r AS (SELECT *, row_number() OVER (PARTITION BY cand ORDER BY s DESC, ts_us, transaction_id) AS rn FROM cand),
per AS (SELECT cand, any_value(w_model) AS w_model, any_value(w_rule) AS w_rule, any_value(w_anomaly) AS w_anomaly,
               sum(CASE WHEN rn <= {K_ALERTS} THEN amount_minor * is_fraud ELSE 0 END) AS hit_v FROM r GROUP BY cand),
res AS (SELECT per.*, CASE WHEN tv > 0 THEN hit_v / tv END AS value_recall
        FROM per, (SELECT sum(amount_minor * is_fraud) AS tv FROM scored))
SELECT cand, w_model, w_rule, w_anomaly, round(value_recall, 6) AS value_recall
FROM res ORDER BY coalesce(value_recall, -1) DESC, cand LIMIT 1"""))
def m7_blend_select(spark, sf):
    s = _scored(spark, sf)
    sel = scoring.select_blend(s, BLEND_CANDIDATES, K_ALERTS)
    return sel.select("cand", "w_model", "w_rule", "w_anomaly", rnd("value_recall").alias("value_recall"))


# ------------------------------------------------------------------ A: metrics
@register("a1_pr_auc", with_(SCORED_CTE + "," + _AP_SQL, "SELECT round(pr_auc, 6) AS pr_auc FROM ap"))
def a1_pr_auc(spark, sf):
    return ev.average_precision(_scored(spark, sf)).select(rnd("pr_auc").alias("pr_auc"))


for _id, _col in (("a2", "precision_at_k"), ("a3", "recall_at_k"), ("a4", "value_recall_at_k")):
    def _mk(col):
        def q(spark, sf):
            return ev.at_k(_scored(spark, sf), K_ALERTS).select("k", rnd(col).alias(col))
        return q
    register(f"{_id}_{_col}", with_(SCORED_CTE + "," + _ATK_SQL.format(k=K_ALERTS),
                                    f"SELECT k, round({_col}, 6) AS {_col} FROM atk2"))(_mk(_col))


_OP_COLS = ("round(threshold, 6) AS threshold, CAST(alerts AS BIGINT) AS alerts, round(precision, 6) AS precision, "
            "round(recall, 6) AS recall, round(caught_value, 6) AS caught_value, "
            "round(missed_value, 6) AS missed_value, round(cost, 6) AS cost")


def _op_spark(df):
    return df.select(rnd("threshold").alias("threshold"), "alerts", rnd("precision").alias("precision"),
                     rnd("recall").alias("recall"), rnd("caught_value").alias("caught_value"),
                     rnd("missed_value").alias("missed_value"), rnd("cost").alias("cost"))


def _op_sql(thr_expr: str, review: float, friction: float, src: str = "scored") -> str:
    return f"""(SELECT {thr_expr} AS threshold,
  count(*) FILTER (WHERE model_score >= {thr_expr}) AS alerts,
  CASE WHEN count(*) FILTER (WHERE model_score >= {thr_expr}) > 0 THEN
    count(*) FILTER (WHERE model_score >= {thr_expr} AND is_fraud = 1) / count(*) FILTER (WHERE model_score >= {thr_expr}) END AS precision,
  count(*) FILTER (WHERE model_score >= {thr_expr} AND is_fraud = 1) / greatest(count(*) FILTER (WHERE is_fraud = 1), 1) AS recall,
  coalesce(sum(amount_minor) FILTER (WHERE model_score >= {thr_expr} AND is_fraud = 1), 0) / 100.0 AS caught_value,
  coalesce(sum(amount_minor) FILTER (WHERE model_score < {thr_expr} AND is_fraud = 1), 0) / 100.0 AS missed_value,
  coalesce(sum(amount_minor) FILTER (WHERE model_score < {thr_expr} AND is_fraud = 1), 0) / 100.0
    + {review} * count(*) FILTER (WHERE model_score >= {thr_expr})
    + {friction} * count(*) FILTER (WHERE model_score >= {thr_expr} AND is_fraud = 0) AS cost
  FROM {src})"""


@register("a5_operating_point", with_(SCORED_CTE, f"SELECT {_OP_COLS} FROM {_op_sql('0.5', 4.0, 12.0)}"))
def a5_operating_point(spark, sf):
    return _op_spark(ev.operating_point(_scored(spark, sf), 0.5))


_GRID_PROBS = "[" + ", ".join(repr(float(p)) for p in np.linspace(0.0, 1.0, 200)) + "]"


def _grid_curve_sql(review, friction, rounded=True):
    g = "round(t, 6)" if rounded else "t"
    return f""",
grid AS (SELECT DISTINCT {g} AS thr FROM (SELECT unnest(quantile_cont(model_score, {_GRID_PROBS})) AS t FROM scored)),
curve AS (
  SELECT thr AS threshold,
    count(*) FILTER (WHERE s.model_score >= thr) AS alerts,
    count(*) FILTER (WHERE s.model_score >= thr AND s.is_fraud = 1) AS tp,
    count(*) FILTER (WHERE s.model_score >= thr AND s.is_fraud = 0) AS fp,
    count(*) FILTER (WHERE s.is_fraud = 1) AS frauds,
    coalesce(sum(s.amount_minor) FILTER (WHERE s.model_score >= thr AND s.is_fraud = 1), 0) AS caught_minor,
    coalesce(sum(s.amount_minor) FILTER (WHERE s.model_score < thr AND s.is_fraud = 1), 0) AS missed_minor
  FROM grid, scored s GROUP BY thr),
curve2 AS (
  SELECT threshold, alerts,
    CASE WHEN alerts > 0 THEN tp / alerts END AS precision,
    tp / greatest(frauds, 1) AS recall,
    caught_minor / 100.0 AS caught_value, missed_minor / 100.0 AS missed_value,
    missed_minor / 100.0 + {review} * alerts + {friction} * fp AS cost
  FROM curve)"""


@register("a6_best_threshold", with_(SCORED_CTE + _grid_curve_sql(4.0, 12.0), f"""
SELECT {_OP_COLS} FROM curve2 ORDER BY cost, threshold LIMIT 1"""))
def a6_best_threshold(spark, sf):
    return _op_spark(ev.best_threshold_by_cost(_scored(spark, sf)))


@register("a6_best_threshold_scaled", with_(SCORED_CTE + _grid_curve_sql(0.25, 0.5), f"""
SELECT {_OP_COLS} FROM curve2 ORDER BY cost, threshold LIMIT 1"""))
def a6_best_threshold_scaled(spark, sf):
    """A6 with unit costs scaled to the small test amounts (interior optimum)."""
    return _op_spark(ev.best_threshold_by_cost(_scored(spark, sf), review_cost=0.25, friction_cost=0.5))


@register("a7_do_nothing_cost", with_(TXN_CTE, """
SELECT round(coalesce(sum(amount_minor * is_fraud), 0) / 100.0, 6) AS do_nothing_cost FROM txn"""))
def a7_do_nothing_cost(spark, sf):
    return ev.summary(card_txn(spark, sf)).select(rnd("fraud_value").alias("do_nothing_cost"))


@register("a8_summary", with_(TXN_CTE, """
SELECT count(*) AS rows, round(avg(is_fraud), 6) AS fraud_rate,
       round(coalesce(sum(amount_minor * is_fraud), 0) / 100.0, 6) AS fraud_value FROM txn"""))
def a8_summary(spark, sf):
    return ev.summary(card_txn(spark, sf)).select("rows", rnd("fraud_rate").alias("fraud_rate"),
                                                  rnd("fraud_value").alias("fraud_value"))


_RANKED_SQL = """
rk AS (SELECT *, row_number() OVER (ORDER BY model_score DESC, ts_us, transaction_id) AS pos,
              sum(amount_minor * is_fraud) OVER (ORDER BY model_score DESC, ts_us, transaction_id
                                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_v
       FROM scored),
tot AS (SELECT count(*) AS n, avg(amount) AS mean_amt, sum(amount_minor * is_fraud) AS total_v FROM scored)"""


def _budget_sql(budgets_sql: str) -> str:
    return f""",
b AS ({budgets_sql}),
curve AS (
  SELECT b.k,
    CASE WHEN total_v > 0 THEN (CASE WHEN b.k <= n THEN rk.cum_v ELSE total_v END) / total_v END AS value_share,
    CASE WHEN total_v > 0 THEN least(b.k * mean_amt, total_v / 100.0) / (total_v / 100.0) END AS random_reference,
    least(b.k / n, 1.0) AS random_fair
  FROM b CROSS JOIN tot LEFT JOIN rk ON rk.pos = b.k)"""


@register("a9_value_budget_curve", with_(SCORED_CTE + "," + _RANKED_SQL + _budget_sql(
    "SELECT range AS k FROM range(1, 601)"), """
SELECT k, round(value_share, 6) AS value_share, round(random_reference, 6) AS random_reference,
       round(random_fair, 6) AS random_fair FROM curve"""))
def a9_value_budget_curve(spark, sf):
    c = ev.value_budget_curve(_scored(spark, sf), range(1, 601))
    return c.select("k", rnd("value_share").alias("value_share"),
                    rnd("random_reference").alias("random_reference"), rnd("random_fair").alias("random_fair"))


@register("a9_value_budget_two_scores", with_(SCORED_CTE + """,
scores AS (SELECT 'model' AS which, transaction_id, ts_us, amount_minor * is_fraud AS v, model_score AS s FROM scored
         UNION ALL SELECT 'blend', transaction_id, ts_us, amount_minor * is_fraud,
                          (0.0 + 0.65 * model_score + 0.25 * rule_score) / 0.9 FROM scored),
walked AS (SELECT which, row_number() OVER o AS k, sum(v) OVER (o ROWS UNBOUNDED PRECEDING) AS got,
                  sum(v) OVER (PARTITION BY which) AS tv FROM scores
           WINDOW o AS (PARTITION BY which ORDER BY s DESC, ts_us, transaction_id))""", """
SELECT which, k, round(got / tv, 6) AS value_share FROM walked WHERE k <= 600"""))
def a9_value_budget_two_scores(spark, sf):
    """A9 for the model score and the blend."""
    s = _scored(spark, sf).withColumn("blend_score", scoring.blend("model_score", "rule_score"))
    curves = [ev.value_budget_curve(s, range(1, 601), c).select(F.lit(c.removesuffix("_score")).alias("which"), "k",
                                                                rnd("value_share").alias("value_share"))
              for c in ("model_score", "blend_score")]
    return curves[0].unionByName(curves[1])


_A10_GRID_SQL = """SELECT DISTINCT least(greatest(CAST(trunc(CASE WHEN i = 59 THEN top
       ELSE i * ((top - lowest) / 59) + lowest END) AS BIGINT), 1), n) AS k
     FROM range(0, 60) r(i), (SELECT n, top, greatest(1, top // 60) AS lowest
       FROM (SELECT count(*) AS n, greatest(50, CAST(trunc(count(*) * 0.12) AS BIGINT)) AS top FROM scored))"""


@register("a10_value_budget_grid", with_(SCORED_CTE + "," + _RANKED_SQL + _budget_sql(_A10_GRID_SQL), """
SELECT k, round(value_share, 6) AS value_share, round(random_fair, 6) AS random_fair FROM curve WHERE k >= 1"""))
def a10_value_budget_grid(spark, sf):
    s = _scored(spark, sf)
    n = s.count()
    c = ev.value_budget_curve(s, ev.budget_grid(n))
    return c.select("k", rnd("value_share").alias("value_share"), rnd("random_fair").alias("random_fair"))


@register("a10_half_value_budget", with_(SCORED_CTE + "," + _RANKED_SQL + _budget_sql(_A10_GRID_SQL), """
SELECT coalesce(min(k) FILTER (WHERE value_share >= 0.5), max(k)) AS half_value_budget FROM curve WHERE k >= 1"""))
def a10_half_value_budget(spark, sf):
    s = _scored(spark, sf)
    c = ev.value_budget_curve(s, ev.budget_grid(s.count()))
    return ev.half_value_budget(c)


@register("a11_pr_curve", with_(SCORED_CTE, """,
g AS (SELECT model_score, count(*) AS n, sum(is_fraud) AS pos FROM scored GROUP BY model_score),
c AS (SELECT model_score, sum(n) OVER (ORDER BY model_score DESC) AS cn, sum(pos) OVER (ORDER BY model_score DESC) AS cp FROM g),
t AS (SELECT sum(is_fraud) AS P, count(*) AS N FROM scored)
SELECT round(model_score, 6) AS threshold, round(cp / cn, 6) AS precision,
       round(CASE WHEN P > 0 THEN cp / P END, 6) AS recall, round(P / N, 6) AS prevalence FROM c, t"""))
def a11_pr_curve(spark, sf):
    c = ev.pr_curve(_scored(spark, sf))
    return c.select(rnd("threshold").alias("threshold"), rnd("precision").alias("precision"),
                    rnd("recall").alias("recall"), rnd("prevalence").alias("prevalence"))


@register("a12_cost_curve", with_(SCORED_CTE + _grid_curve_sql(4.0, 12.0, rounded=False),
                                  f"SELECT {_OP_COLS} FROM curve2"))
def a12_cost_curve(spark, sf):
    s = _scored(spark, sf)
    grid = ev.quantile_grid(s, "score", 200, decimals=None)
    return _op_spark(ev.cost_curve(s, grid))


_CAL_PROBS = "[" + ", ".join(repr(float(p)) for p in np.linspace(0.0, 1.0, 9)) + "]"


@register("a13_calibration_curve", with_(SCORED_CTE, f""",
e AS (SELECT DISTINCT unnest(quantile_cont(model_score, {_CAL_PROBS})) AS edge FROM scored),
inner_e AS (SELECT edge FROM e WHERE edge > (SELECT min(edge) FROM e) AND edge < (SELECT max(edge) FROM e)),
b AS (SELECT s.model_score, s.is_fraud, (SELECT count(*) FROM inner_e WHERE edge < s.model_score) AS bin FROM scored s)
SELECT CAST(bin AS INTEGER) AS bin, round(avg(model_score), 6) AS mean_pred, round(avg(is_fraud), 6) AS observed_rate,
       count(*) AS n FROM b GROUP BY bin"""))
def a13_calibration_curve(spark, sf):
    c = ev.calibration_curve(_scored(spark, sf))
    return c.select("bin", rnd("mean_pred").alias("mean_pred"), rnd("observed_rate").alias("observed_rate"), "n")


# ------------------------------------------------------------------ D: drift
def _drift_inputs(spark, sf):
    # read by the time cuts and by both slices: computed once
    f = cut_lineage(card_featured(spark, sf).select("ts_us", *DRIFT_FEATURES))
    t1, t2 = split.time_cuts(f)
    lab = split.label_split(f, t1, t2)
    return lab.where("split = 'train'"), lab.where("split = 'test'")


def _drift_sql_long(src_filter: str) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x FROM featlab WHERE {src_filter}" for c in DRIFT_FEATURES)
    return parts


_DRIFT_PROBS = "[" + ", ".join(repr(float(p)) for p in np.linspace(0.0, 1.0, 11)) + "]"
_DRIFT_CTE = FEAT_CTE + """,
cuts AS (SELECT quantile_cont(CAST(ts_us AS DOUBLE), 0.6) AS t1, quantile_cont(CAST(ts_us AS DOUBLE), 0.8) AS t2 FROM feat),
featlab AS (SELECT f.*, CASE WHEN ts_us <= t1 THEN 'train' WHEN ts_us <= t2 THEN 'valid' ELSE 'test' END AS split
            FROM feat f, cuts),
ref AS (""" + _drift_sql_long("split = 'train'") + """),
act AS (""" + _drift_sql_long("split = 'test'") + """),
q AS (SELECT feature, quantile_cont(x, """ + _DRIFT_PROBS + """) AS qs FROM ref GROUP BY feature),
edges2 AS (SELECT feature, list_sort(list_distinct(qs[2:10])) AS inner_e FROM q),
nb AS (SELECT feature, inner_e, len(inner_e) + 1 AS nbins FROM edges2),
allbins AS (SELECT feature, unnest(range(0, nbins)) AS bin FROM nb),
rc AS (SELECT r.feature, len(list_filter(nb.inner_e, lambda t: t <= r.x)) AS bin, count(*) AS c
       FROM ref r JOIN nb USING (feature) GROUP BY ALL),
ac AS (SELECT a.feature, len(list_filter(nb.inner_e, lambda t: t <= a.x)) AS bin, count(*) AS c
       FROM act a JOIN nb USING (feature) GROUP BY ALL),
rn AS (SELECT feature, count(*) AS n FROM ref GROUP BY feature),
an AS (SELECT feature, count(*) AS n FROM act GROUP BY feature),
shares AS (
  SELECT b.feature, b.bin,
         greatest(coalesce(rc.c / rn.n, 0.0), 1e-6) AS r, greatest(coalesce(ac.c / an.n, 0.0), 1e-6) AS a
  FROM allbins b LEFT JOIN rc USING (feature, bin) LEFT JOIN ac USING (feature, bin)
       JOIN rn USING (feature) JOIN an USING (feature)),
psi AS (SELECT s.feature, CASE WHEN any_value(nb.nbins) < 2 THEN 0.0 ELSE sum((a - r) * ln(a / r)) END AS psi
        FROM shares s JOIN nb USING (feature) GROUP BY s.feature),
u AS (SELECT feature, x, 1 AS nr, 0 AS na FROM ref UNION ALL SELECT feature, x, 0, 1 FROM act),
vc AS (SELECT feature, x, sum(nr) AS nr, sum(na) AS na FROM u GROUP BY feature, x),
cum AS (SELECT feature, sum(nr) OVER (PARTITION BY feature ORDER BY x) AS cr,
               sum(na) OVER (PARTITION BY feature ORDER BY x) AS ca FROM vc),
ks AS (SELECT c.feature, max(abs(cr / rn.n - ca / an.n)) AS ks FROM cum c JOIN rn USING (feature) JOIN an USING (feature)
       GROUP BY c.feature),
rep AS (SELECT p.feature, p.psi, k.ks,
               CASE WHEN p.psi < 0.10 THEN 'stable' WHEN p.psi <= 0.25 THEN 'moderate' ELSE 'large' END AS severity
        FROM psi p JOIN ks k USING (feature))"""


@register("d1_psi", with_(_DRIFT_CTE, "SELECT feature, round(psi, 6) AS psi FROM rep"))
def d1_psi(spark, sf):
    ref, act = _drift_inputs(spark, sf)
    return drift.psi(ref, act, DRIFT_FEATURES).select("feature", rnd("psi").alias("psi"))


@register("d2_ks", with_(_DRIFT_CTE, "SELECT feature, round(ks, 6) AS ks FROM rep"))
def d2_ks(spark, sf):
    ref, act = _drift_inputs(spark, sf)
    return drift.ks(ref, act, DRIFT_FEATURES).select("feature", rnd("ks").alias("ks"))


@register("d3_drift_report", with_(_DRIFT_CTE, """
SELECT feature, round(psi, 6) AS psi, round(ks, 6) AS ks, severity,
       row_number() OVER (ORDER BY psi DESC, feature) AS report_rank FROM rep"""))
def d3_drift_report(spark, sf):
    ref, act = _drift_inputs(spark, sf)
    rep = drift.drift_report(ref, act, DRIFT_FEATURES)
    rows = rep.select("feature", rnd("psi").alias("psi"), rnd("ks").alias("ks"), "severity").collect()  # a row a feature
    return spark.createDataFrame([(*r, k) for k, r in enumerate(rows, 1)],
                                 "feature string, psi double, ks double, severity string, report_rank long")


@register("d3_drift_by_days", with_(_DRIFT_CTE, "SELECT feature, round(psi, 6) AS psi, round(ks, 6) AS ks, severity FROM rep"))
def d3_drift_by_days(spark, sf):
    """D3 on a schedule: every day's value counts stored once (in two loads, one of them repeated),
    merged over all days against the frozen reference."""
    from ledgerguard.plans.wide_queries import _sink_dir
    ref, act = _drift_inputs(spark, sf)
    folder = _sink_dir(spark, "drift")
    drift.freeze_reference(ref, DRIFT_FEATURES, folder)
    day = F.floor(F.col("ts_us") / 86_400_000_000)
    for part in (day % 2 == 0, day % 2 == 1, day % 2 == 0):
        drift.add_days(act.where(part), DRIFT_FEATURES, folder)
    rep = drift.window_report(spark, folder, DRIFT_FEATURES)
    return rep.select("feature", rnd("psi").alias("psi"), rnd("ks").alias("ks"), "severity")


@register("d4_severity", with_(_DRIFT_CTE, "SELECT feature, severity FROM rep"))
def d4_severity(spark, sf):
    ref, act = _drift_inputs(spark, sf)
    return drift.psi(ref, act, DRIFT_FEATURES).select("feature", drift.severity("psi").alias("severity"))


# ------------------------------------------------------------------ V: quality
@register("v1_not_null", with_(FEAT_CTE, """
SELECT * FROM (VALUES ('transaction_id', (SELECT count(*) FILTER (WHERE transaction_id IS NULL) FROM feat)),
                      ('card_id', (SELECT count(*) FILTER (WHERE card_id IS NULL) FROM feat)),
                      ('amount', (SELECT count(*) FILTER (WHERE amount IS NULL) FROM feat)),
                      ('txn_count_1h', (SELECT count(*) FILTER (WHERE txn_count_1h IS NULL) FROM feat)))
       t(column_name, null_rows)"""))
def v1_not_null(spark, sf):
    r = quality.not_null(card_featured(spark, sf), ["transaction_id", "card_id", "amount", "txn_count_1h"])
    return r.select("column_name", "null_rows")


@register("v2_unique", with_(TXN_CTE, """,
d AS (SELECT transaction_id, count(*) AS n FROM txn GROUP BY transaction_id HAVING count(*) > 1)
SELECT 'transaction_id' AS column_name, count(*) AS duplicate_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows FROM d"""))
def v2_unique(spark, sf):
    return quality.unique_summary(card_txn(spark, sf), "transaction_id").select(
        "column_name", "duplicate_keys", "duplicate_rows")


@register("v3_accepted_values", with_(FEAT_CTE, """
SELECT * FROM (VALUES
  ('channel', (SELECT count(*) FILTER (WHERE channel IS NOT NULL AND channel NOT IN ('CP', 'CNP')) FROM feat)),
  ('is_fraud', (SELECT count(*) FILTER (WHERE is_fraud IS NOT NULL AND is_fraud NOT IN (0, 1)) FROM feat)),
  ('is_cnp', (SELECT count(*) FILTER (WHERE is_cnp IS NOT NULL AND is_cnp NOT IN (0, 1)) FROM feat)),
  ('is_night', (SELECT count(*) FILTER (WHERE is_night IS NOT NULL AND is_night NOT IN (0, 1)) FROM feat)))
  t(column_name, bad_rows)"""))
def v3_accepted_values(spark, sf):
    r = quality.accepted_values(card_featured(spark, sf), {"channel": ["CP", "CNP"], "is_fraud": [0, 1],
                                                          "is_cnp": [0, 1], "is_night": [0, 1]})
    return r.select("column_name", "bad_rows")


@register("v4_freshness", with_(TXN_CTE, f""",
m AS (SELECT max(ts_us) AS newest_us FROM txn)
SELECT newest_us, round(({FRESHNESS_NOW_US} - newest_us) / 3600000000.0, 6) AS age_hours,
       CASE WHEN newest_us IS NULL THEN 'error'
            WHEN ({FRESHNESS_NOW_US} - newest_us) / 3600000000.0 > 72 THEN 'error'
            WHEN ({FRESHNESS_NOW_US} - newest_us) / 3600000000.0 > 24 THEN 'warn' ELSE 'pass' END AS status FROM m"""))
def v4_freshness(spark, sf):
    r = quality.freshness(card_txn(spark, sf), FRESHNESS_NOW_US)
    return r.select("newest_us", rnd("age_hours").alias("age_hours"), "status")


def _leak_sql() -> str:
    """Brute-force features on the whole table and, through a renamed copy of
    the same CTEs, on the table truncated at the median time; the symmetric
    difference of the rows at or before the cut must be empty."""
    import re
    from ledgerguard.plans.sqlparts import FEAT_CTE, TXN_CTE
    body = FEAT_CTE[len(TXN_CTE):]
    body_t = body
    for name in ("txn", "pairs", "prevrow", "feat0", "feat"):
        body_t = re.sub(rf"\b{name}\b", f"{name}_t", body_t)
    cols = ("transaction_id, txn_count_1h, amt_sum_1h, txn_count_24h, amt_sum_24h, amount_z, "
            "time_since_last_s, geo_dist_km, geo_speed_kmh, mcc_novel, card_age_days")
    return ("WITH " + TXN_CTE.strip() + """,
cut AS (SELECT CAST(floor(quantile_cont(CAST(ts_us AS DOUBLE), 0.5)) AS BIGINT) AS c FROM txn),
txn_t AS (SELECT * FROM txn WHERE ts_us <= (SELECT c FROM cut))""" + body + body_t + f"""
SELECT * FROM (
  (SELECT {cols} FROM feat WHERE ts_us <= (SELECT c FROM cut) EXCEPT ALL SELECT {cols} FROM feat_t)
  UNION ALL
  (SELECT {cols} FROM feat_t EXCEPT ALL SELECT {cols} FROM feat WHERE ts_us <= (SELECT c FROM cut)))""")


@register("v5_leakage", _leak_sql())
def v5_leakage(spark, sf):
    """Rows whose features change when every later row is removed (expected: none)."""
    from ledgerguard.operators.features import add_card_features
    t = card_txn(spark, sf)
    t1, _ = split.time_cuts(t, 0.5, 0.0)
    cols = ["txn_count_1h", "amt_sum_1h", "txn_count_24h", "amt_sum_24h", "amount_z", "time_since_last_s",
            "geo_dist_km", "geo_speed_kmh", "mcc_novel", "card_age_days"]
    return quality.leakage_check(t, add_card_features, int(np.floor(t1)), cols=cols)


@register("a10_random_baseline", with_(SCORED_CTE, f""",
b AS (SELECT DISTINCT k FROM ({_A10_GRID_SQL})),
o AS (SELECT rep, amount_minor * is_fraud AS v, row_number() OVER (PARTITION BY rep ORDER BY
        CAST('0x' || md5('0:' || rep || ':' || transaction_id)[1:15] AS BIGINT), transaction_id) AS place
      FROM scored, (SELECT unnest(range(10)) AS rep))
SELECT k, sum(v) FILTER (WHERE place <= k) / 10.0 / nullif((SELECT sum(amount_minor * is_fraud) FROM scored), 0) AS random_share
FROM o, b GROUP BY k"""))
def a10_random_baseline(spark, sf):
    """A10: value share at the 60-point budget grid under 10 seeded random orders (averaged)."""
    s = _scored(spark, sf)
    return ev.random_order_baseline(s, ev.budget_grid(s.count()), reps=10)
