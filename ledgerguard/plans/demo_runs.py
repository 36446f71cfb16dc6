"""End-to-end review runs composed from the operators.

Discipline kept from the reference: blend weights and the operating threshold
are chosen on the validation slice and only then measured on the test slice.
Everything stays a lazy DataFrame except the small decisions (weights, cuts,
threshold), which are one-row results read on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerguard.operators import anomaly, drift, evaluation as ev, model, rings, scoring, split
from ledgerguard.operators.rules import apply_rules, reason_codes
from ledgerguard.plans.registry import register
from ledgerguard.session import cut_lineage
from ledgerguard.sources.schemas import CARD_FEATURE_COLS

# Fixed values of the card review run (alert budget, unit costs, blend candidates).
CARD_BUDGET = 100
CARD_REVIEW_COST, CARD_FRICTION_COST = 4.0, 12.0
CARD_CANDIDATES = [(1.00, 0.00, 0.00), (0.80, 0.20, 0.00), (0.70, 0.30, 0.00),
                   (0.70, 0.20, 0.10), (0.60, 0.25, 0.15), (0.50, 0.30, 0.20)]
# Fixed values of the e-commerce review run.
WIDE_BUDGET = 200
WIDE_REVIEW_COST, WIDE_FRICTION_COST = 4.0, 20.0
WIDE_CANDIDATES = [(1.00, 0.00, 0.00), (0.80, 0.20, 0.00), (0.70, 0.20, 0.10),
                   (0.60, 0.25, 0.15), (0.50, 0.30, 0.20)]
WIDE_TRAINING = dict(max_depth=None, max_leaves=63, step_size=0.05, min_instances=50)
# Boosting rounds of the e-commerce model, as the reference trains them (the card model's are model_queries').
WIDE_MAX_ITER = 300


def frame_cols(df):
    return set(df.columns)


rule_names = ("card_testing", "high_amount_new_card", "impossible_travel", "velocity_spike")


def _signals(scorer, forest, train: DataFrame, frame: DataFrame, feature_cols, rule_col: str,
             id_col: str) -> DataFrame:
    scored = scorer.transform(frame)
    anom = anomaly.anomaly_scores(train, frame, feature_cols, keep=(id_col,), nodes=forest)
    return scored.join(anom.select(id_col, "anomaly_score"), id_col, "left") \
                 .withColumn("rule_signal", F.col(rule_col).cast("double"))


def _review(scorer, train, valid, test, feature_cols, rule_col, id_col, budget, review, friction, candidates,
            minor_per_unit, extra=()):
    forest = anomaly.fit_isolation_forest(train, feature_cols, id_col=id_col)     # fitted once, bounded node table
    v = _signals(scorer, forest, train, valid, feature_cols, rule_col, id_col)
    t = _signals(scorer, forest, train, test, feature_cols, rule_col, id_col)
    ren = {id_col: "transaction_id"} if id_col != "transaction_id" else {}
    keep = ["transaction_id", "ts_us", "amount", "amount_minor", "is_fraud", "model_score", "rule_signal",
            "anomaly_score"] + [c for c in ("card_id", *rule_names, *extra) if c in frame_cols(v)]
    # the scored slices feed blend selection, thresholds and every metric: cut lineage once
    v = cut_lineage(v.withColumnsRenamed(ren).select(*keep))
    t = cut_lineage(t.withColumnsRenamed(ren).select(*keep))
    choice = scoring.select_blend(v, candidates, budget, "model_score", "rule_signal", "anomaly_score").first()
    w = (choice["w_model"], choice["w_rule"], choice["w_anomaly"])
    b = lambda df: df.withColumn("score", scoring.blend("model_score", "rule_signal", "anomaly_score", *w))
    vb, tb = b(v), b(t)
    chosen = ev.best_threshold_by_cost(vb, review_cost=review, friction_cost=friction,
                                       minor_per_unit=minor_per_unit).first()["threshold"]
    op = ev.operating_point(tb, chosen, review_cost=review, friction_cost=friction, minor_per_unit=minor_per_unit)
    cap_thr = ev.threshold_for_capacity(tb, budget).first()["threshold"]
    cap = ev.operating_point(tb, cap_thr, review_cost=review, friction_cost=friction, minor_per_unit=minor_per_unit)
    model_only = tb.withColumn("score", F.col("model_score"))
    parts = [
        tb.agg(F.lit(w[0]).alias("w_model"), F.lit(w[1]).alias("w_rule"), F.lit(w[2]).alias("w_anomaly"),
               F.count(F.lit(1)).alias("test_rows")),
        ev.average_precision(model_only).withColumnRenamed("pr_auc", "pr_auc_model"),
        ev.average_precision(tb).withColumnRenamed("pr_auc", "pr_auc_blend"),
        ev.at_k(model_only, budget).select(F.col("value_recall_at_k").alias("value_recall_model")),
        ev.at_k(tb, budget).select(F.col("precision_at_k").alias("precision_at_budget"),
                                   F.col("value_recall_at_k").alias("value_recall_blend")),
        op.select(F.col("threshold").alias("cost_threshold"), F.col("precision").alias("cost_precision"),
                  F.col("recall").alias("cost_recall"), F.col("caught_value").alias("cost_caught_value"),
                  F.col("cost").alias("cost_total")),
        ev.summary(tb, minor_per_unit=minor_per_unit).select(F.col("fraud_value").alias("do_nothing_cost")),
        cap.select(F.col("threshold").alias("budget_threshold"), F.col("caught_value").alias("budget_caught_value")),
    ]
    report = parts[0]
    for p in parts[1:]:
        report = ev._one_row_join(report, p)
    return report, tb


#: (report, scored test slice) per run, session and data set: frames over checkpointed slices
_REVIEWS: dict[tuple[str, str, str], tuple[DataFrame, DataFrame]] = {}


def card_review(spark, sf) -> tuple[DataFrame, DataFrame]:
    """§3.1: (report row, test frame with blended score)."""
    from ledgerguard.plans.common import card_featured
    from ledgerguard.plans.model_queries import card_scorer
    at = ("card", spark.sparkContext.applicationId, sf)
    if at not in _REVIEWS:
        f = cut_lineage(apply_rules(card_featured(spark, sf)))       # feeds split, model, signals
        train, valid, test, _ = split.time_split(f)
        _REVIEWS[at] = _review(card_scorer(spark, sf, train), train, valid, test, CARD_FEATURE_COLS, "rule_score",
                               "transaction_id", CARD_BUDGET, CARD_REVIEW_COST, CARD_FRICTION_COST, CARD_CANDIDATES, 100)
    return _REVIEWS[at]


@register("run_card_review")
def run_card_review(spark, sf):
    """Card review run: chosen weights, ranking quality, cost-chosen and
    fixed-budget operating points on the test slice (one row)."""
    return card_review(spark, sf)[0]


@register("run_card_queue")
def run_card_queue(spark, sf):
    """Card review run: reason-coded investigator queue head on the test slice."""
    _, tb = card_review(spark, sf)
    q = scoring.rank_queue(tb.withColumn("reason_codes", reason_codes()), "score")
    return scoring.queue_head(q, 10, ["transaction_id", "card_id", "amount", "risk_score", "expected_loss",
                                      "reason_codes", "is_fraud"])


@register("run_card_drift")
def run_card_drift(spark, sf):
    """Card review run: drift of every feature from the train to the test slice."""
    from ledgerguard.plans.common import card_featured
    train, _, test, _ = split.time_split(card_featured(spark, sf))
    return drift.drift_report(train, test, CARD_FEATURE_COLS)


@register("run_card_rules")
def run_card_rules(spark, sf):
    """Card review run: the rule report on the test slice."""
    from ledgerguard.operators.rules import rule_precision
    from ledgerguard.plans.common import card_featured
    _, _, test, _ = split.time_split(cut_lineage(apply_rules(card_featured(spark, sf))))
    return rule_precision(test)


RING_COLS = ("device_prior_cards", "device_fp_freq", "uid_txn_24h")


def wide_review(spark, sf) -> tuple[DataFrame, DataFrame]:
    """§3.2: (report row, scored test slice with the ring columns)."""
    from ledgerguard.operators.wide_features import add_wide_features
    from ledgerguard.plans.wide_queries import wide_normalised
    at = ("wide", spark.sparkContext.applicationId, sf)
    if at not in _REVIEWS:
        f, cols = add_wide_features(wide_normalised(spark, sf))
        f = f.withColumn("ring_score", rings.ring_rule_score(f))
        f = cut_lineage(f.select("TransactionID", "ts_us", "amount", "amount_minor", "is_fraud", "ring_score", *cols))
        train, valid, test, _ = split.time_split(f)
        scorer = model.train_scorer(train, cols, id_col="TransactionID", max_iter=WIDE_MAX_ITER, **WIDE_TRAINING)
        _REVIEWS[at] = _review(scorer, train, valid, test, cols, "ring_score", "TransactionID", WIDE_BUDGET,
                               WIDE_REVIEW_COST, WIDE_FRICTION_COST, WIDE_CANDIDATES, 1000, extra=RING_COLS)
    return _REVIEWS[at]


@register("run_wide_review")
def run_wide_review(spark, sf):
    """§3.2: e-commerce review with the ring score as the rule signal (one row)."""
    return wide_review(spark, sf)[0]


@register("run_wide_queue")
def run_wide_queue(spark, sf):
    """E-commerce review run: queue head of the test slice with ring reasons."""
    _, tb = wide_review(spark, sf)
    q = scoring.rank_queue(tb.withColumn("reason_codes", rings.ring_reason_codes(tb)), "score")
    return scoring.queue_head(q, 10, ["transaction_id", "amount", "risk_score", "expected_loss", "reason_codes",
                                      "is_fraud"])


def _wide_test(spark, sf):
    from ledgerguard.plans.wide_queries import ring_featured
    return split.time_split(cut_lineage(ring_featured(spark, sf)))[2]


@register("run_wide_rings")
def run_wide_rings(spark, sf):
    """E-commerce review run: G4, G5 and G6 on the test slice, one row per figure."""
    test = _wide_test(spark, sf)
    g4 = rings.confound_summary(test).select(F.lit("confound").alias("part"), F.lit(None).cast("string").alias("bucket"),
                                             "rows", "fraud_rate", F.lit(None).cast("double").alias("fraud_value"))
    g5 = rings.sharing_profile(test).select(F.lit("sharing").alias("part"), "bucket", "rows", "fraud_rate",
                                            F.lit(None).cast("double").alias("fraud_value"))
    g6 = rings.ring_summary(test).select(F.lit("rings").alias("part"), F.lit(None).cast("string").alias("bucket"), "rows",
                                         "fraud_rate", F.col("fraud_value").cast("double"))
    return g4.unionByName(g5).unionByName(g6)


@register("run_wide_random_baseline")
def run_wide_random_baseline(spark, sf):
    """A10 on the e-commerce test slice: value recovered by account velocity (a fixed stand-in
    for the learned order) and by random orders, on the budget grid."""
    test = _wide_test(spark, sf).withColumnRenamed("TransactionID", "transaction_id").withColumn(
        "score", F.col("uid_txn_24h").cast("double"))
    budgets = ev.budget_grid(test.count())
    curve = ev.value_budget_curve(test, budgets, minor_per_unit=1000).select("k", "value_share", "random_reference")
    return curve.join(ev.random_order_baseline(test, budgets), "k")
