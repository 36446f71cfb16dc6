"""Blend, expected loss and the investigator queue (M6, M7, K1-K3, K6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerguard.operators import evaluation as ev

# Default blend weights (model, rule, anomaly) and the candidates
# the blend selection tries.
DEFAULT_WEIGHTS = (0.65, 0.25, 0.10)


def blend(model: str | Column, rule: str | Column, anomaly: str | Column | None = None,
          w_model: float = 0.65, w_rule: float = 0.25, w_anomaly: float = 0.10) -> Column:
    """M6: weighted mean of the present signals, renormalised by their total weight."""
    c = lambda x: F.col(x) if isinstance(x, str) else x
    parts = [(w_model, c(model)), (w_rule, c(rule))]
    if anomaly is not None:
        parts.append((w_anomaly, c(anomaly)))
    total = sum(w for w, _ in parts)
    return sum((F.lit(float(w)) * s for w, s in parts), F.lit(0.0)) / F.lit(float(total))


def expected_loss(score: str | Column, amount: str | Column = "amount") -> Column:
    """K1: P(fraud) x amount."""
    s = F.col(score) if isinstance(score, str) else score
    a = F.col(amount) if isinstance(amount, str) else amount
    return s.cast("double") * a.cast("double")


def rank_queue(df: DataFrame, score_col: str = "score", reason_col: str | None = None) -> DataFrame:
    """K2: add risk_score and expected_loss; ordered by expected loss descending
    (ties by transaction_id).  The sort is Spark's distributed range sort."""
    q = df.withColumn("risk_score", F.col(score_col).cast("double")) \
          .withColumn("expected_loss", expected_loss("risk_score"))
    if reason_col and reason_col != "reason_codes":
        q = q.withColumnRenamed(reason_col, "reason_codes")
    return q.orderBy(F.desc("expected_loss"), F.asc("transaction_id"))


def queue_head(queue: DataFrame, n: int = 10, cols: Sequence[str] | None = None) -> DataFrame:
    """K3: the first n queue rows (TakeOrderedAndProject)."""
    out = queue.orderBy(F.desc("expected_loss"), F.asc("transaction_id")).limit(int(n))
    return out.select(*cols) if cols else out


def select_blend(df: DataFrame, candidates: Sequence[tuple[float, float, float]], budget: int,
                 model="model_score", rule="rule_score", anomaly: str | None = None,
                 label="is_fraud", amount_minor="amount_minor") -> DataFrame:
    """M7: pick the candidate weights with the strictly highest fraud-value recall
    at ``budget`` (first candidate wins ties; an all-NULL recall gives candidate 0).

    Each candidate's top-``budget`` is found per candidate with a row_number
    window partitioned by candidate (Spark plans a WindowGroupLimit, so every
    task keeps at most ``budget`` rows per candidate before the shuffle).  The
    candidate list is small by construction, so candidate scores are computed
    as one column per candidate and unpivoted, not by a join.
    """
    cols = [F.col(model), F.col(rule)] + ([F.col(anomaly)] if anomaly else [])
    scored = df.select("ts_us", "transaction_id", label, amount_minor, *cols)
    exprs = []
    for i, (wm, wr, wa) in enumerate(candidates):
        s = blend(model, rule, anomaly, wm, wr, wa) if anomaly else blend(model, rule, None, wm, wr)
        exprs.append(F.struct(F.lit(i).alias("cand"), s.alias("s")))
    long = scored.select("ts_us", "transaction_id", label, amount_minor,
                         F.explode(F.array(*exprs)).alias("c")).select(
        "ts_us", "transaction_id", label, amount_minor, F.col("c.cand").alias("cand"), F.col("c.s").alias("s"))
    w = Window.partitionBy("cand").orderBy(F.col("s").desc(), F.col("ts_us"), F.col("transaction_id"))
    top = long.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= int(budget))
    y = F.col(label)
    per = top.groupBy("cand").agg(F.sum(F.col(amount_minor) * y).alias("hit_v"))
    tot = df.agg(F.sum(F.col(amount_minor) * F.col(label)).alias("tv"))
    spark = df.sparkSession
    cdf = spark.createDataFrame([(i, float(a), float(b), float(c)) for i, (a, b, c) in enumerate(candidates)],
                                "cand int, w_model double, w_rule double, w_anomaly double")
    res = F.broadcast(cdf).join(per, "cand", "left")
    res = ev._one_row_join(res, tot).select(
        "cand", "w_model", "w_rule", "w_anomaly",
        F.when(F.col("tv") > 0, F.coalesce("hit_v", F.lit(0)) / F.col("tv")).alias("value_recall"))
    # strictly highest recall; NULL recall counts as -1 so candidate 0 wins when all are NULL
    key = F.coalesce(F.col("value_recall"), F.lit(-1.0))
    return res.orderBy(key.desc(), F.col("cand").asc()).limit(1)


def triage(df: DataFrame, cap: int, score="score", label="is_fraud", amount_minor="amount_minor"):
    """K6: (queue head of ``cap`` rows, one-row KPI frame) for a review capacity."""
    q = rank_queue(df, score)
    head = queue_head(q, cap)
    kpi = ev._one_row_join(ev.at_k(df, cap, score, label, amount_minor),
                           ev.average_precision(df, score, label))
    kpi = kpi.select(F.lit(int(cap)).alias("alerts"), F.col("precision_at_k").alias("precision_at_cap"),
                     F.col("value_recall_at_k").alias("value_recall_at_cap"), "pr_auc")
    return head, kpi
