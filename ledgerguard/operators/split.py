"""Chronological split at linear-interpolated time quantiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerguard.operators.ordering import exact_quantiles, quantile_sketch, sketch_quantiles


def time_cuts(df: DataFrame, train_frac: float = 0.6, valid_frac: float = 0.2, ts: str = "ts_us",
              approx: bool = False) -> tuple[float, float]:
    """The two cut points (in ts units).  Exact by default (distributed order
    statistics); ``approx=True`` takes them from a quantile sketch (rank error 0.3 %)."""
    p1, p2 = train_frac, train_frac + valid_frac
    if approx:
        q = sketch_quantiles(quantile_sketch(df, ts), [p1, p2])
        return q[p1], q[p2]
    q = exact_quantiles(df, ts, [p1, p2])
    return q[p1], q[p2]


def label_split(df: DataFrame, t1: float, t2: float, ts: str = "ts_us") -> DataFrame:
    """One ``split`` column (train <= t1 < valid <= t2 < test) so features are
    computed once and the three slices are lazy filters of one frame."""
    c = F.col(ts)
    return df.withColumn("split", F.when(c <= F.lit(t1), F.lit("train"))
                         .when(c <= F.lit(t2), F.lit("valid")).otherwise(F.lit("test")))


def time_split(df: DataFrame, train_frac: float = 0.6, valid_frac: float = 0.2, ts: str = "ts_us"):
    """Returns (train, valid, test, (t1, t2))."""
    t1, t2 = time_cuts(df, train_frac, valid_frac, ts)
    lab = label_split(df, t1, t2, ts)
    return (lab.where("split = 'train'").drop("split"), lab.where("split = 'valid'").drop("split"),
            lab.where("split = 'test'").drop("split"), (t1, t2))
