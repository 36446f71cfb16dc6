"""Drift monitoring D1-D4: PSI and KS per feature, worst first, severity bands."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerguard.operators.ordering import (exact_quantiles, global_cumulative, quantile_sketch,
                                           quantiles_from_running, sketch_quantiles)

PSI_EPS = 1e-6
# PSI rule-of-thumb bands.
PSI_MODERATE, PSI_LARGE = 0.10, 0.25


def _long(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Unpivot to (feature, x) with one stack expression (no per-feature scans)."""
    pairs = ", ".join(f"'{f}', CAST(`{f}` AS DOUBLE)" for f in features)
    return df.selectExpr(f"stack({len(features)}, {pairs}) AS (feature, x)")


def value_counts(reference: DataFrame, actual: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, x, nr, na): how often each value occurs in the reference and the
    actual sample -- the one pass over the data that PSI and KS both use.  It is
    checkpointed to the shared folder because three consumers read it."""
    from ledgerguard.session import cut_lineage
    r = _long(reference, features).where(F.col("x").isNotNull()).withColumn("src", F.lit(0))
    a = _long(actual, features).where(F.col("x").isNotNull()).withColumn("src", F.lit(1))
    vc = r.unionByName(a).groupBy("feature", "x").agg(F.sum(1 - F.col("src")).cast("long").alias("nr"),
                                                      F.sum("src").cast("long").alias("na"))
    return cut_lineage(vc)


def psi_from_counts(vc: DataFrame, features: Sequence[str], bins: int = 10, q: dict | None = None) -> DataFrame:
    """D1 on value counts (``q``: the reference quantiles, if known).  Edges are the distinct reference quantiles at 0,
    1/bins, ..., 1 with the ends opened to +-inf (fewer than 3 edges -> PSI 0);
    bins are [lo, hi); shares are floored at 1e-6."""
    probs = [float(p) for p in np.linspace(0.0, 1.0, bins + 1)]
    q = exact_quantiles(vc, "x", probs, group="feature", weight="nr") if q is None else q
    spark = vc.sparkSession
    edge_rows, degenerate = [], []
    for f in features:
        e = [q[f][p] for p in probs] if f in q else []
        e = sorted(set([-math.inf] + e[1:-1] + [math.inf])) if e else []
        if len(e) < 3:
            degenerate.append(f)
            continue
        edge_rows.append((f, [float(v) for v in e[1:-1]], len(e) - 1))
    out = []
    if edge_rows:
        # bounded: one row per feature, at most bins - 1 edges each
        edges = spark.createDataFrame(edge_rows, "feature string, inner array<double>, nbins int")
        b = F.size(F.filter(F.col("inner"), lambda t: t <= F.col("x")))
        per_bin = (vc.join(F.broadcast(edges), "feature")
                   .groupBy("feature", b.alias("bin")).agg(F.sum("nr").alias("cr"), F.sum("na").alias("ca")))
        tot = vc.groupBy("feature").agg(F.sum("nr").alias("Nr"), F.sum("na").alias("Na"))
        allbins = edges.select("feature", F.explode(F.sequence(F.lit(0), F.col("nbins") - 1)).alias("bin"))
        full = allbins.join(per_bin, ["feature", "bin"], "left").join(tot, "feature")
        r = F.greatest(F.coalesce(F.col("cr"), F.lit(0)) / F.col("Nr"), F.lit(PSI_EPS))
        a = F.greatest(F.coalesce(F.col("ca"), F.lit(0)) / F.col("Na"), F.lit(PSI_EPS))
        out.append(full.groupBy("feature").agg(F.sum((a - r) * F.log(a / r)).alias("psi")))
    if degenerate:
        out.append(spark.createDataFrame([(f, 0.0) for f in degenerate], "feature string, psi double"))
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    return res


def running_counts(vc: DataFrame) -> tuple[DataFrame, dict]:
    """(value counts with running sums per feature, {feature: (Nr, Na)}): one distributed sort
    that serves the quantiles and the distribution gap."""
    totals: dict = {}
    cum = global_cumulative(vc, [F.col("feature"), F.col("x")], {"r": F.col("nr"), "a": F.col("na")},
                            keep=["feature", "x", "nr", "na"], group="feature", totals_out=totals)
    return cum, {f: (int(v[1]), int(v[2])) for f, v in totals.items()}


def ks_from_running(cum: DataFrame, totals: dict) -> DataFrame:
    """Max |ECDF_ref - ECDF_act| per feature."""
    tot = cum.sparkSession.createDataFrame([(f, r, a) for f, (r, a) in totals.items()],
                                           "feature string, all_r long, all_a long")     # one row per feature
    gap = cum.join(F.broadcast(tot), "feature").select(
        "feature", F.abs(F.col("cum_r") / F.col("all_r") - F.col("cum_a") / F.col("all_a")).alias("g"))
    return gap.groupBy("feature").agg(F.max("g").alias("ks"))


def ks_from_counts(vc: DataFrame) -> DataFrame:
    """D2 on value counts."""
    return ks_from_running(*running_counts(vc))


def psi(reference: DataFrame, actual: DataFrame, features: Sequence[str], bins: int = 10, approx: bool = False) -> DataFrame:
    """Population stability index per feature (``approx``: edges from a quantile sketch of each
    feature's reference)."""
    q = None
    if approx:
        probs = [float(p) for p in np.linspace(0.0, 1.0, bins + 1)]
        q = sketch_quantiles(quantile_sketch(_long(reference, features), "x", ["feature"]), probs, "feature")
    return psi_from_counts(value_counts(reference, actual, features), features, bins, q)


def ks(reference: DataFrame, actual: DataFrame, features: Sequence[str]) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic per feature."""
    return ks_from_counts(value_counts(reference, actual, features))


def severity(psi_col: str | Column = "psi") -> Column:
    """< 0.10 stable, 0.10-0.25 moderate, > 0.25 large."""
    p = F.col(psi_col) if isinstance(psi_col, str) else psi_col
    return (F.when(p < PSI_MODERATE, F.lit("stable")).when(p <= PSI_LARGE, F.lit("moderate"))
            .otherwise(F.lit("large")))


def drift_report(reference: DataFrame, actual: DataFrame, features: Sequence[str], bins: int = 10) -> DataFrame:
    """D3: PSI and KS per feature, worst PSI first."""
    return report_from_counts(value_counts(reference, actual, features), features, bins)


def report_from_counts(vc: DataFrame, features: Sequence[str], bins: int = 10) -> DataFrame:
    """D3 on value counts (stored: they are read three times)."""
    cum, totals = running_counts(vc)
    probs = [float(p) for p in np.linspace(0.0, 1.0, bins + 1)]
    known = {f: r for f, (r, _) in totals.items() if r}
    q = quantiles_from_running(cum, "x", "nr", "cum_r", known, probs, "feature") if known else {}
    rep = psi_from_counts(vc, features, bins, q).join(ks_from_running(cum, totals), "feature")
    return rep.withColumn("severity", severity("psi")).orderBy(F.desc("psi"), F.asc("feature"))


# --------------------------------------------------------------------------
# Drift on a schedule.  Value counts add up, so a day is counted once, when it arrives, and the
# report of any window of days is that of one pass over the reference and the window's rows.
# --------------------------------------------------------------------------


def freeze_reference(reference: DataFrame, features: Sequence[str], folder: str) -> None:
    """Store the reference sample's value counts; later windows are held against them."""
    counts = _long(reference, features).where(F.col("x").isNotNull()).groupBy("feature", "x").agg(F.count("*").alias("nr"))
    counts.write.mode("overwrite").parquet(f"{folder}/reference")


def add_days(df: DataFrame, features: Sequence[str], folder: str, ts: str = "ts_us") -> None:
    """Store the value counts of the days in ``df``; a day that is there is replaced, so ``df``
    holds whole days."""
    day = F.to_date(F.timestamp_micros(F.col(ts).cast("long"))).alias("event_date")
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x")) for f in features]))
    counts = (df.select(day, pairs.alias("v")).where(F.col("v.x").isNotNull())
              .groupBy("event_date", "v.feature", "v.x").agg(F.count("*").alias("n")))
    (counts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date")
     .parquet(f"{folder}/days"))


def window_report(spark: SparkSession, folder: str, features: Sequence[str], first: str | None = None,
                  last: str | None = None, bins: int = 10) -> DataFrame:
    """D3 of the stored days from ``first`` to ``last`` (dates, both included; None: open) against
    the frozen reference; only the partitions of these days are read."""
    from ledgerguard.session import cut_lineage
    days = spark.read.schema("feature string, x double, n long, event_date date").parquet(f"{folder}/days")
    if first is not None:
        days = days.where(F.col("event_date") >= F.lit(first).cast("date"))
    if last is not None:
        days = days.where(F.col("event_date") <= F.lit(last).cast("date"))
    zero = F.lit(0).cast("long")
    ref = spark.read.schema("feature string, x double, nr long").parquet(f"{folder}/reference")
    both = ref.select("feature", "x", "nr", zero.alias("na")).unionByName(
        days.select("feature", "x", zero.alias("nr"), F.col("n").alias("na")))
    vc = both.where(F.col("feature").isin(*features)).groupBy("feature", "x").agg(F.sum("nr").alias("nr"), F.sum("na").alias("na"))
    return report_from_counts(cut_lineage(vc), features, bins)
