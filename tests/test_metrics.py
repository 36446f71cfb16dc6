"""Metrics on small hand-checkable score vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerguard.operators import evaluation as ev


def scores(spark, y, s, amount=None):
    amount = amount if amount is not None else [1.0] * len(y)
    rows = [(i, i, int(a), float(b), float(c), int(round(c * 100))) for i, (a, b, c) in enumerate(zip(y, s, amount))]
    return spark.createDataFrame(rows, "transaction_id long, ts_us long, is_fraud int, score double, amount double, amount_minor long")


def test_precision_recall_at_k(spark):
    df = scores(spark, [1, 0, 1, 0, 1], [0.9, 0.8, 0.7, 0.2, 0.1])
    r = ev.at_k(df, 3).first()
    assert r["precision_at_k"] == pytest.approx(2 / 3) and r["recall_at_k"] == pytest.approx(2 / 3)


def test_k_edge_cases(spark):
    df = scores(spark, [1, 0, 1], [0.5, 0.5, 0.1])
    assert ev.at_k(df, 0).first()["precision_at_k"] is None
    assert ev.at_k(df, 10).first()["recall_at_k"] == 1.0
    # tied scores: earlier ts wins
    assert [r["transaction_id"] for r in ev.top_k(df, 1).collect()] == [0]
    none = scores(spark, [0, 0], [0.2, 0.1])
    assert ev.at_k(none, 1).first()["recall_at_k"] is None


def test_value_weighted_recall(spark):
    df = scores(spark, [1, 1, 0], [0.9, 0.1, 0.5], [1000.0, 10.0, 50.0])
    assert ev.at_k(df, 1).first()["value_recall_at_k"] == pytest.approx(1000 / 1010)


def test_average_precision_perfect_and_known(spark):
    assert ev.average_precision(scores(spark, [0, 0, 1, 1], [0.1, 0.2, 0.8, 0.9])).first()["pr_auc"] == 1.0
    # ranking 1,0,1: AP = 1/2 * 1 + 1/2 * 2/3
    ap = ev.average_precision(scores(spark, [1, 0, 1], [0.9, 0.8, 0.7])).first()["pr_auc"]
    assert ap == pytest.approx(0.5 + 1 / 3)


def test_operating_cost(spark):
    df = scores(spark, [1, 0, 1], [0.9, 0.9, 0.1], [100.0, 100.0, 200.0])
    op = ev.operating_point(df, 0.5, review_cost=5.0, friction_cost=20.0).first()
    assert op["cost"] == 230.0 and op["alerts"] == 2
    assert op["caught_value"] == 100.0 and op["missed_value"] == 200.0


def test_threshold_for_capacity(spark):
    df = scores(spark, [0] * 5, [0.1, 0.5, 0.9, 0.3, 0.7])
    assert ev.threshold_for_capacity(df, 2).first()["threshold"] == 0.7


def test_best_threshold_beats_extremes(spark):
    rng = np.random.default_rng(0)
    y = (rng.random(500) < 0.05).astype(int)
    amount = np.round(rng.uniform(10, 500, 500), 2)
    s = np.clip(y * 0.6 + rng.random(500) * 0.4, 0, 1)
    df = scores(spark, y.tolist(), s.tolist(), amount.tolist())
    best = ev.best_threshold_by_cost(df).first()["cost"]
    assert best <= ev.operating_point(df, 0.0).first()["cost"]
    assert best <= ev.operating_point(df, 1.01).first()["cost"]
    # the one-pass curve equals brute force at every grid threshold
    grid = ev.quantile_grid(df, "score")
    curve = {round(r["threshold"], 9): r["cost"] for r in ev.cost_curve(df, grid).collect()}
    for t in grid[::20]:
        assert curve[round(t, 9)] == pytest.approx(ev.operating_point(df, t).first()["cost"])


def test_quantile_grid_matches_numpy(spark):
    rng = np.random.default_rng(1)
    s = rng.random(777)
    df = scores(spark, [0] * 777, s.tolist())
    g = ev.quantile_grid(df, "score", 200)
    assert g == sorted(set(np.round(np.quantile(s, np.linspace(0, 1, 200)), 6).tolist()))


def test_random_order_baseline(spark):
    rng = np.random.default_rng(7)
    y = (rng.random(300) < 0.2).astype(int)
    df = scores(spark, y.tolist(), rng.random(300).tolist(), np.round(rng.uniform(1, 100, 300), 2).tolist())
    r = {x["k"]: x["random_share"] for x in ev.random_order_baseline(df, [1, 50, 150, 300, 400], reps=4).collect()}
    assert r[300] == pytest.approx(1.0) and r[400] == pytest.approx(1.0)
    assert r[1] <= r[50] <= r[150] <= r[300]


def test_value_budget_curve_matches_pandas(spark):
    rng = np.random.default_rng(8)
    y = (rng.random(400) < 0.1).astype(int)
    s = np.round(rng.random(400), 2)             # ties broken by ts (= row index)
    amt = np.round(rng.uniform(1, 50, 400), 2)
    df = scores(spark, y.tolist(), s.tolist(), amt.tolist())
    got = {r["k"]: r["value_share"] for r in ev.value_budget_curve(df, [5, 40, 400, 500]).collect()}
    order = np.lexsort((np.arange(400), -s))
    v = np.round(amt * 100).astype(int) * y
    cum = np.cumsum(v[order])
    for k in (5, 40, 400):
        assert got[k] == pytest.approx(cum[k - 1] / v.sum())
    assert got[500] == pytest.approx(1.0)
