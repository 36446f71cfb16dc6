"""Evaluation aggregates A1-A13 and top-k operators K4/K5.

Top-k ties are broken by (ts_us, transaction_id).  The first k rows, their sums and the sums at
many budgets come from ``radix.first_sums``: histogram passes over narrow rows, without a sort.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerguard.operators import radix
from ledgerguard.operators.ordering import exact_quantiles, global_cumulative, quantile_sketch, sketch_quantiles

_ORDER_KEYS = ["_k_score", "_k_ts", "_k_id"]


def _with_order(df: DataFrame, score: str, ts: str = "ts_us", tie: str = "transaction_id") -> DataFrame:
    return df.withColumns(dict(zip(_ORDER_KEYS, (radix.descending(F.col(score)), F.col(ts).cast("long"),
                                                 F.col(tie).cast("long")), strict=True)))


def _first_sums(df: DataFrame, ks: Sequence[int], score: str, measures: dict[str, Column] | None = None) -> tuple[dict, dict]:
    """Sums over the first k rows by score for every k, and where each k ends."""
    measures = dict(measures or {})
    narrow = _with_order(df, score).select(*_ORDER_KEYS, *[m.alias(n) for n, m in measures.items()])
    narrow = narrow.persist(StorageLevel.MEMORY_AND_DISK)        # read by every pass
    try:
        return radix.first_sums(narrow, _ORDER_KEYS, ks, list(measures))
    finally:
        narrow.unpersist()


def score_order(score: str = "score", ts: str = "ts_us", tie: str = "transaction_id") -> list[Column]:
    return [F.col(score).desc(), F.col(ts).asc(), F.col(tie).asc()]


def top_k(df: DataFrame, k: int, score: str = "score", ts: str = "ts_us", tie: str = "transaction_id") -> DataFrame:
    """K4: the k highest scores (ties by ts, id); empty when k <= 0."""
    keyed = _with_order(df, score, ts, tie)
    cut = radix.first_sums(keyed, _ORDER_KEYS, [k])[1].get(k)
    return keyed.where(cut.holds() if cut else F.lit(False)).drop(*_ORDER_KEYS)


def at_k(df: DataFrame, k: int, score="score", label="is_fraud", amount_minor="amount_minor") -> DataFrame:
    """A2-A4 in one row: precision@k, recall@k, value-weighted recall@k.

    precision NULL when the top k is empty; recall NULL without fraud; value
    recall NULL when the fraud value is not positive.
    """
    first = _first_sums(df, [k], score, {"hits": F.col(label), "value": F.col(amount_minor) * F.col(label)})[0]
    top = df.sparkSession.createDataFrame([first.get(k, (0, None, None))], "n_top long, hits long, hit_value long")
    tot = df.select(F.sum(label).alias("frauds"), F.sum(F.col(amount_minor) * F.col(label)).alias("fraud_value"))
    j = _one_row_join(top, tot)
    return j.select(
        F.lit(int(k)).alias("k"),
        F.when(F.col("n_top") > 0, F.coalesce("hits", F.lit(0)) / F.col("n_top")).alias("precision_at_k"),
        F.when(F.col("frauds") > 0, F.coalesce("hits", F.lit(0)) / F.col("frauds")).alias("recall_at_k"),
        F.when(F.col("fraud_value") > 0, F.coalesce("hit_value", F.lit(0)) / F.col("fraud_value"))
         .alias("value_recall_at_k"),
    )


def _one_row_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """Attach the columns of the single-row aggregate ``b`` to every row of ``a``.

    ``b`` becomes one uncorrelated scalar subquery (run once, reused for every
    field) instead of a join, so no cross product is ever planned."""
    cols = b.columns
    s = b.select(F.struct(*[F.col(c) for c in cols]).alias("_s")).scalar()
    return a.select("*", *[s.getField(c).alias(c) for c in cols])


def average_precision(df: DataFrame, score="score", label="is_fraud") -> DataFrame:
    """A1: average precision = sum over distinct thresholds (descending) of
    (recall step) x (precision at that threshold).  Ties are collapsed by a
    grouped aggregate first, then ordered globally without a single partition."""
    g = df.groupBy(score).agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("pos"))
    cum = global_cumulative(g, [F.col(score).desc()], {"n": F.col("n"), "pos": F.col("pos")},
                            keep=[score, "n", "pos"])
    total = df.select(F.sum(label).alias("P"))
    contrib = cum.select((F.col("pos") * (F.col("cum_pos") / F.col("cum_n"))).alias("c"))
    s = contrib.agg(F.sum("c").alias("s"))
    return _one_row_join(s, total).select(
        F.when(F.col("P") > 0, F.col("s") / F.col("P")).alias("pr_auc"))


def pr_curve(df: DataFrame, score="score", label="is_fraud") -> DataFrame:
    """(threshold, precision, recall) per distinct score, plus prevalence."""
    g = df.groupBy(score).agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("pos"))
    cum = global_cumulative(g, [F.col(score).desc()], {"n": F.col("n"), "pos": F.col("pos")},
                            keep=[score])
    tot = df.select(F.sum(label).alias("P"), F.count(F.lit(1)).alias("N"))
    return _one_row_join(cum, tot).select(
        F.col(score).alias("threshold"),
        (F.col("cum_pos") / F.col("cum_n")).alias("precision"),
        F.when(F.col("P") > 0, F.col("cum_pos") / F.col("P")).alias("recall"),
        (F.col("P") / F.col("N")).alias("prevalence"))


def operating_point(df: DataFrame, threshold: float, score="score", label="is_fraud",
                    amount_minor="amount_minor", review_cost: float = 4.0,
                    friction_cost: float = 12.0, minor_per_unit: int = 100) -> DataFrame:
    """A5: alerts, precision, recall, caught / missed value and cost at score >= t."""
    flag = F.col(score) >= F.lit(float(threshold))
    y = F.col(label) == 1
    a = df.agg(
        F.count(F.when(flag, 1)).alias("alerts"),
        F.count(F.when(flag & y, 1)).alias("tp"),
        F.count(F.when(flag & ~y, 1)).alias("fp"),
        F.count(F.when(y, 1)).alias("frauds"),
        F.coalesce(F.sum(F.when(flag & y, F.col(amount_minor))), F.lit(0)).alias("caught_minor"),
        F.coalesce(F.sum(F.when(~flag & y, F.col(amount_minor))), F.lit(0)).alias("missed_minor"),
    )
    return _cost_columns(a, F.lit(float(threshold)), review_cost, friction_cost, minor_per_unit)


def _cost_columns(a: DataFrame, thr: Column, review_cost, friction_cost, minor_per_unit) -> DataFrame:
    missed = F.col("missed_minor") / F.lit(float(minor_per_unit))
    return a.select(
        thr.alias("threshold"),
        F.col("alerts").cast("long").alias("alerts"),
        F.when(F.col("alerts") > 0, F.col("tp") / F.col("alerts")).alias("precision"),
        (F.col("tp") / F.greatest(F.col("frauds"), F.lit(1))).alias("recall"),
        (F.col("caught_minor") / F.lit(float(minor_per_unit))).alias("caught_value"),
        missed.alias("missed_value"),
        (missed + F.lit(float(review_cost)) * F.col("alerts") + F.lit(float(friction_cost)) * F.col("fp"))
        .alias("cost"),
    )


def _quantiles(df: DataFrame, col: str, probs: Sequence[float], approx: bool) -> dict:
    return sketch_quantiles(quantile_sketch(df, col), probs) if approx else exact_quantiles(df, col, probs)


def quantile_grid(df: DataFrame, score: str, n_grid: int = 200, decimals: int | None = 6, approx: bool = False) -> list[float]:
    """The reference's threshold grid: n quantiles on [0, 1], rounded, distinct (``approx``: from a
    quantile sketch)."""
    probs = [float(p) for p in np.linspace(0.0, 1.0, n_grid)]
    q = _quantiles(df, score, probs, approx)
    vals = [q[p] for p in probs]
    if decimals is not None:
        vals = [float(v) for v in np.round(np.asarray(vals), decimals)]
    return sorted(set(vals))


def cost_curve(df: DataFrame, grid: Sequence[float], score="score", label="is_fraud",
               amount_minor="amount_minor", review_cost: float = 4.0, friction_cost: float = 12.0,
               minor_per_unit: int = 100) -> DataFrame:
    """A5 at every grid threshold in ONE pass over the rows.

    Each row is bucketed by how many thresholds it reaches (binary search in a
    Bucketizer), counts are aggregated per bucket (<= len(grid)+1 rows), and
    suffix sums over the buckets give every threshold's operating point.
    """
    grid = sorted(set(float(g) for g in grid))
    splits = [-float("inf")] + grid + [float("inf")]
    b = Bucketizer(splits=splits, inputCol="_s", outputCol="_b", handleInvalid="keep")
    y = F.col(label) == 1
    rows = b.transform(df.select(F.col(score).cast("double").alias("_s"), F.col(label), F.col(amount_minor)))
    per = rows.groupBy(F.col("_b").cast("int").alias("b")).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(y, 1)).alias("pos"),
        F.coalesce(F.sum(F.when(y, F.col(amount_minor))), F.lit(0)).alias("val"))
    # threshold j (0-based) flags rows whose bucket >= j + 1; the grid table is
    # bounded by the grid size, so it is broadcast.
    spark = df.sparkSession
    gdf = spark.createDataFrame([(j, t) for j, t in enumerate(grid)], "j int, threshold double")
    tot = per.agg(F.sum("pos").alias("frauds"), F.sum("val").alias("fraud_val"))
    joined = F.broadcast(gdf).join(per, F.col("b") >= F.col("j") + 1, "left")
    a = joined.groupBy("j", "threshold").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("alerts"),
        F.coalesce(F.sum("pos"), F.lit(0)).alias("tp"),
        F.coalesce(F.sum("val"), F.lit(0)).alias("caught_minor"))
    a = _one_row_join(a, tot).select(
        "threshold", "alerts", "tp", (F.col("alerts") - F.col("tp")).alias("fp"), "frauds",
        "caught_minor", (F.col("fraud_val") - F.col("caught_minor")).alias("missed_minor"))
    return _cost_columns(a, F.col("threshold"), review_cost, friction_cost, minor_per_unit)


def best_threshold_by_cost(df: DataFrame, score="score", n_grid: int = 200, approx: bool = False, **kw) -> DataFrame:
    """The minimum-cost point of the rounded quantile grid; the lowest
    threshold wins among equal costs."""
    curve = cost_curve(df, quantile_grid(df, score, n_grid, approx=approx), score=score, **kw)
    return curve.orderBy(F.col("cost").asc(), F.col("threshold").asc()).limit(1)


def threshold_for_capacity(df: DataFrame, k: int, score="score") -> DataFrame:
    """K5: the k-th highest score, k clipped to [1, n]."""
    k = max(int(k), 1)
    return top_k(df, k, score).agg(F.min(score).alias("threshold"))


def summary(df: DataFrame, label="is_fraud", amount_minor="amount_minor", minor_per_unit: int = 100) -> DataFrame:
    """Rows, fraud rate, fraud value (= the do-nothing cost)."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(label).alias("fraud_rate"),
        (F.coalesce(F.sum(F.col(amount_minor) * F.col(label)), F.lit(0)) / F.lit(float(minor_per_unit)))
        .alias("fraud_value"))


def value_budget_curve(df: DataFrame, budgets: Sequence[int], score="score", label="is_fraud",
                       amount_minor="amount_minor", amount="amount", minor_per_unit: int = 100) -> DataFrame:
    """Share of fraud value recovered at each review budget k, with the
    reference's random-order baseline min(k * mean(amount), total) / total and a
    fair random baseline k / n.
    """
    budgets = sorted({int(b) for b in budgets if b > 0})
    value = (F.col(amount_minor) * F.col(label)).alias("v")
    at = _first_sums(df, budgets, score, {"v": value})[0]
    curve = df.sparkSession.createDataFrame([(b, at[b][1] if b in at else None) for b in budgets], "k long, cum_v long")
    tot = df.agg(F.count(F.lit(1)).alias("n"), F.avg(amount).alias("mean_amt"), F.sum(value).alias("total_v"))
    out = _one_row_join(curve, tot)
    v = F.col("cum_v")
    total = F.col("total_v") / F.lit(float(minor_per_unit))
    return out.select(
        "k",
        F.when(F.col("total_v") > 0, v / F.col("total_v")).alias("value_share"),
        F.when(F.col("total_v") > 0, F.least(F.col("k") * F.col("mean_amt"), total) / total)
         .alias("random_reference"),
        F.least(F.col("k") / F.col("n"), F.lit(1.0)).alias("random_fair"))


def budget_grid(n: int, share: float = 0.12, points: int = 60, least: int = 50) -> list[int]:
    """A10 budgets: ``points`` even steps up to ``share`` of the rows (``least`` at least),
    whole numbers from 1 to n."""
    top = max(least, int(n * share))
    steps = np.linspace(max(1, top // points), top, points).astype(int)
    return sorted({int(v) for v in np.minimum(np.maximum(steps, 1), max(n, 1))})


def half_value_budget(curve: DataFrame) -> DataFrame:
    """A10 half-value point: smallest budget whose share >= 0.5, else the last."""
    hit = curve.where(F.col("value_share") >= 0.5).agg(F.min("k").alias("k_half"))
    last = curve.agg(F.max("k").alias("k_last"))
    return _one_row_join(hit, last).select(F.coalesce("k_half", "k_last").alias("half_value_budget"))


def calibration_curve(df: DataFrame, score="score", label="is_fraud", n_bins: int = 8, approx: bool = False) -> DataFrame:
    """Quantile bins of the prediction -> mean prediction, observed rate, count.

    Bin edges are the exact quantiles at 0, 1/n, ..., 1 (distinct); a score's bin is the
    number of inner edges below it, so a score equal to an edge belongs to the bin under
    that edge.  Bins without rows are not returned.
    """
    probs = [float(p) for p in np.linspace(0.0, 1.0, n_bins + 1)]
    q = _quantiles(df, score, probs, approx)
    edges = sorted(set(q[p] for p in probs))
    below = [F.when(F.col("_s") > e, 1).otherwise(0) for e in edges[1:-1]]
    rows = df.select(F.col(score).cast("double").alias("_s"), F.col(label)).where(F.col("_s").isNotNull())
    return rows.groupBy(sum(below, F.lit(0)).cast("int").alias("bin")).agg(
        F.avg("_s").alias("mean_pred"), F.avg(label).alias("observed_rate"),
        F.count(F.lit(1)).alias("n"))


def random_order_baseline(df: DataFrame, budgets: Sequence[int], reps: int = 10, seed: int = 0,
                          label="is_fraud", amount_minor="amount_minor", id_col="transaction_id") -> DataFrame:
    """A10 random baseline: fraud-value share recovered at each budget when the
    queue is in a random order, averaged over ``reps`` seeded permutations.

    Every permutation orders rows by 60 bits of a seeded digest of the id (then the id).  A pass
    of the radix select counts all repetitions in the tasks that read the narrow rows; only the
    few rows around each budget are looked at further.
    """
    budgets = sorted({int(b) for b in budgets if b > 0})
    spark = df.sparkSession
    narrow = df.select(F.col(id_col).cast("long").alias("id"), (F.col(amount_minor) * F.col(label)).alias("v"))
    narrow = narrow.persist(StorageLevel.MEMORY_AND_DISK)
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("rep").cast("string"), F.col("id").cast("string")).cast("binary"))
    orders = narrow.withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(reps - 1)))).withColumn(
        "place", F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"))
    try:
        found = radix.first_sums(orders, ["place", "id"], budgets, ["v"], group="rep")[0]
        total = narrow.agg(F.sum("v").alias("tv")).first()["tv"]
    finally:
        narrow.unpersist()
    mean = lambda b: sum(f[b][1] for f in found.values()) / len(found)
    return spark.createDataFrame([(b, mean(b) / total if found and total and total > 0 else None) for b in budgets],
                                 "k long, random_share double")
