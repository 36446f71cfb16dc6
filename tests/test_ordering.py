"""Distributed global order and exact quantiles against numpy / pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerguard.operators import ordering as O
from ledgerguard.operators.ordering import POS, exact_quantiles, global_cumulative


def test_global_cumulative_matches_pandas(spark):
    rng = np.random.default_rng(5)
    n = 3000
    pdf = pd.DataFrame({"id": np.arange(n), "s": rng.integers(0, 50, n).astype(float), "v": rng.integers(0, 9, n)})
    df = spark.createDataFrame(pdf).repartition(7)
    out = global_cumulative(df, [F.col("s").desc(), F.col("id")], {"v": F.col("v")}, keep=["id"]).toPandas()
    want = pdf.sort_values(["s", "id"], ascending=[False, True]).reset_index(drop=True)
    want["pos"] = np.arange(1, n + 1)
    want["cum"] = want["v"].cumsum()
    got = out.set_index("id").loc[want["id"]]
    assert (got[POS].to_numpy() == want["pos"].to_numpy()).all()
    assert (got["cum_v"].to_numpy() == want["cum"].to_numpy()).all()


def test_grouped_cumulative_restarts(spark):
    pdf = pd.DataFrame({"g": ["a"] * 5 + ["b"] * 4, "x": [5, 1, 3, 2, 4, 9, 7, 8, 6], "v": [1] * 9})
    df = spark.createDataFrame(pdf).repartition(3)
    out = global_cumulative(df, [F.col("g"), F.col("x")], {"v": F.col("v")}, keep=["g", "x"], group="g").toPandas()
    for g, sub in out.groupby("g"):
        sub = sub.sort_values("x")
        assert sub[POS].tolist() == list(range(1, len(sub) + 1))
        assert sub["cum_v"].tolist() == list(range(1, len(sub) + 1))


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(0, 1, 1001), 3)
    df = spark.createDataFrame([(float(v),) for v in x], "x double").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.6, 0.8, 0.999, 1.0]
    q = exact_quantiles(df, "x", probs)
    for p in probs:
        assert q[p] == pytest.approx(float(np.quantile(x, p)), abs=1e-12)


def test_exact_quantiles_distributed_path(spark, monkeypatch):
    import ledgerguard.operators.ordering as O
    monkeypatch.setattr(O, "SMALL_VALUE_COUNTS", 10)
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(0, 1, 801), 2)
    g = np.where(np.arange(801) % 3 == 0, "a", "b")
    df = spark.createDataFrame([(str(a), float(v)) for a, v in zip(g, x)], "g string, x double").repartition(4)
    probs = [0.0, 0.3, 0.5, 0.9, 1.0]
    q = O.exact_quantiles(df, "x", probs, group="g")
    for name in ("a", "b"):
        for p in probs:
            assert q[name][p] == pytest.approx(float(np.quantile(x[g == name], p)), abs=1e-12)


def test_sketch_quantiles_stay_within_the_stated_rank_error(spark):
    """One sketch, and sketches of days merged; several groups, nulls, no rows."""
    from ledgerguard.operators import evaluation, split
    n = 60_000
    df = spark.range(n).select(F.col("id"), (F.xxhash64("id") % 1_000_003).cast("double").alias("x"), (F.col("id") % 4).alias("day"),
                               F.when(F.col("id") % 10 > 0, F.lit("a")).otherwise("b").alias("g"))
    df = df.withColumn("x", F.when(F.col("id") % 97 > 0, F.col("x")))
    values = {g: np.sort(df.where(F"g = '{g}' and x is not null").select("x").toPandas()["x"].to_numpy()) for g in "ab"}
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    whole = O.sketch_quantiles(O.quantile_sketch(df, "x", ["g"], k=400), probs, "g")
    days = O.sketch_quantiles(O.merge_sketches(O.quantile_sketch(df, "x", ["g", "day"], k=400), ["g"]), probs, "g")
    for got in (whole, days):
        for g, q in got.items():
            for p, v in q.items():
                rank = np.searchsorted(values[g], v, side="right") / len(values[g])
                assert abs(rank - p) <= 2 * O.sketch_rank_error(400)
    none = O.sketch_quantiles(O.quantile_sketch(df.where("false"), "x"), [0.5])
    assert none == {0.5: None}
    exact, near = split.time_cuts(df, ts="id"), split.time_cuts(df, ts="id", approx=True)
    assert all(abs(a - b) <= 2 * O.sketch_rank_error(1024) * n for a, b in zip(exact, near, strict=True))
    assert len(evaluation.quantile_grid(df, "x", 20, approx=True)) == 20
