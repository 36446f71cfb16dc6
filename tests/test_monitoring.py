"""Drift: PSI and KS on samples with known behaviour."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerguard.operators import drift


def frame(spark, **cols):
    names = list(cols)
    rows = list(zip(*[np.asarray(v, dtype=float).tolist() for v in cols.values()]))
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))


def test_psi_same_and_shifted(spark):
    rng = np.random.default_rng(0)
    ref = frame(spark, x=rng.normal(0, 1, 4000))
    same = frame(spark, x=rng.normal(0, 1, 4000))
    shifted = frame(spark, x=rng.normal(1.5, 1, 4000))
    assert drift.psi(ref, same, ["x"]).first()["psi"] < 0.05
    assert drift.psi(ref, shifted, ["x"]).first()["psi"] > 0.25


def test_psi_matches_numpy_definition(spark):
    rng = np.random.default_rng(3)
    r, a = rng.normal(0, 1, 1000), rng.normal(0.3, 1.2, 700)
    edges = np.quantile(r, np.linspace(0, 1, 11))
    edges[0], edges[-1] = -np.inf, np.inf
    edges = np.unique(edges)
    rp = np.clip(np.histogram(r, edges)[0] / len(r), 1e-6, None)
    ap = np.clip(np.histogram(a, edges)[0] / len(a), 1e-6, None)
    want = float(np.sum((ap - rp) * np.log(ap / rp)))
    got = drift.psi(frame(spark, x=r), frame(spark, x=a), ["x"]).first()["psi"]
    assert got == pytest.approx(want, rel=1e-9)


def test_constant_reference_keeps_one_interior_edge(spark):
    # edges (-inf, 1, inf): reference all in the upper bin, actual 1/20 below
    got = drift.psi(frame(spark, x=[1.0] * 20), frame(spark, x=list(range(20))), ["x"]).first()["psi"]
    want = (0.05 - 1e-6) * np.log(0.05 / 1e-6) + (0.95 - 1.0) * np.log(0.95)
    assert got == pytest.approx(want)


def test_ks_identical_and_disjoint(spark):
    rng = np.random.default_rng(0)
    a = rng.normal(0, 1, 2000)
    assert drift.ks(frame(spark, x=a), frame(spark, x=a), ["x"]).first()["ks"] == 0.0
    assert drift.ks(frame(spark, x=a), frame(spark, x=a + 100), ["x"]).first()["ks"] > 0.99


def test_report_worst_first(spark):
    rng = np.random.default_rng(0)
    ref = frame(spark, stable=rng.normal(0, 1, 3000), drifting=rng.normal(0, 1, 3000))
    act = frame(spark, stable=rng.normal(0, 1, 3000), drifting=rng.normal(2, 1, 3000))
    rep = drift.drift_report(ref, act, ["stable", "drifting"]).collect()
    assert [r["feature"] for r in rep] == ["drifting", "stable"]
    assert rep[0]["severity"] == "large" and rep[1]["severity"] == "stable"


def test_drift_of_stored_days_equals_the_full_pass(spark):
    import random

    from ledgerguard.session import ensure_checkpoint_dir
    rng = random.Random(4)
    day = 86_400_000_000
    rows = [(rng.randrange(6 * day), rng.choice([None, 1.0, 2.0, 3.5]), rng.random()) for _ in range(900)]
    df = spark.createDataFrame(rows, "ts_us long, a double, b double")
    ref, act = df.where(F.col("ts_us") < 2 * day), df.where(F.col("ts_us") >= 2 * day)
    folder = f"{ensure_checkpoint_dir(spark)}/drift-{rng.random()}"
    drift.freeze_reference(ref, ["a", "b"], folder)
    for lo, hi in ((2, 4), (4, 6), (3, 5)):                     # the last load repeats two days
        drift.add_days(act.where((F.col("ts_us") >= lo * day) & (F.col("ts_us") < hi * day)), ["a", "b"], folder)
    rows_of = lambda d: [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in d.collect()]
    assert rows_of(drift.window_report(spark, folder, ["a", "b"])) == rows_of(drift.drift_report(ref, act, ["a", "b"]))
    two = act.where((F.col("ts_us") >= 3 * day) & (F.col("ts_us") < 5 * day))
    assert rows_of(drift.window_report(spark, folder, ["a", "b"], "1970-01-04", "1970-01-05")) == \
        rows_of(drift.drift_report(ref, two, ["a", "b"]))
