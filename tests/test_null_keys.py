"""Rows without a key survive the hot-key split; statistics are exact at any size or setting."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerguard.operators import radix, anomaly, asof, evaluation, model, warehouse
from ledgerguard.operators.features import add_card_features, add_card_features_skew_safe, detect_hot_keys
from ledgerguard.operators.ordering import global_cumulative
from ledgerguard.operators.wide_features import add_wide_features
from ledgerguard.sources.adapters import load_card_transactions, load_wide
from ledgerguard.sources.readers import normalise_wide

SF = "/root/testdata/sf0.001"


def same(a, b):
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def holes(spark):
    t = load_card_transactions(spark, SF)
    return t.withColumn("card_id", F.when(F.col("transaction_id") % 10 != 0, F.col("card_id")))


@pytest.mark.parametrize("hot", ["one", "null", "found"])
def test_card_features_keep_rows_without_a_card(holes, hot):
    cols = ["transaction_id", "txn_count_1h", "amt_sum_24h", "amount_z", "time_since_last_s", "mcc_novel"]
    some = holes.where("card_id is not null").first()["card_id"]
    keys = {"one": [some], "null": [None, some], "found": None}[hot]
    got = add_card_features_skew_safe(holes, hot_keys=keys, min_rows=30).select(cols)
    same(add_card_features(holes).select(cols), got)


def test_null_is_found_as_a_hot_key(holes):
    assert None in detect_hot_keys(holes, min_rows=30)


@pytest.mark.parametrize("keys", [[3], [None, 3], None])
def test_velocity_keeps_rows_without_a_card(holes, keys):
    stg = warehouse.stg_transactions(holes)
    same(warehouse.fct_card_velocity(stg), warehouse.fct_card_velocity_skew_safe(stg, hot_keys=keys, min_rows=30))


def test_split_hot_is_a_partition(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    for hot in ([1], [None], [1, None], [9], [1, 1, 2]):
        a, b = asof.split_hot(df, F.col("k"), hot)
        assert sorted(r["k"] or 0 for r in a.unionByName(b).collect()) == [0, 0, 1, 1, 2]
        assert {r["k"] for r in a.collect()} == set(hot) & {1, 2, None}


def test_wide_features_keep_rows_without_card1(spark):
    n = normalise_wide(*load_wide(spark, SF))
    n = n.withColumn("card1", F.when(F.col("TransactionID") % 10 != 0, F.col("card1")))
    cols = ["TransactionID", "card1_prior_txn", "card1_prior_amt_mean", "amt_to_card1_mean", "uid_prior_txn",
            "uid_txn_24h", "client_prior_txn", "card1_freq", "device_prior_cards"]
    plain = add_wide_features(n)[0].select(cols)
    same(plain, add_wide_features(n, hot_min_rows=20)[0].select(cols))
    without = plain.where("TransactionID % 10 = 0")
    assert {(r["card1_prior_txn"], r["card1_prior_amt_mean"], r["amt_to_card1_mean"], r["card1_freq"])
            for r in without.collect()} == {(-1.0, -1.0, 1.0, -1.0)}


def test_nan_is_missing(spark):
    tx, idn = load_wide(spark, SF)
    nan = F.when(F.col("TransactionID") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("D1").cast("double"))
    null = F.when(F.col("TransactionID") % 3 == 0, F.lit(None).cast("double")).otherwise(F.col("D1").cast("double"))
    cols = ["TransactionID", "D1", "D1_norm", "client_prior_txn", "uid"]
    a = add_wide_features(normalise_wide(tx.withColumn("D1", nan), idn))[0].select(cols)
    b = add_wide_features(normalise_wide(tx.withColumn("D1", null), idn))[0].select(cols)
    same(a, b)
    assert a.where(F.isnan("D1")).count() == 0


def test_permutation_importance_does_not_depend_on_partitions(spark):
    rng = np.random.default_rng(0)
    rows = [(i, int(y), float(y) + 0.01 * i / 400, float(rng.random())) for i, y in
            enumerate(rng.integers(0, 2, 400))]
    df = spark.createDataFrame(rows, "transaction_id long, is_fraud int, good double, noise double").repartition(3)
    score = lambda d: d.withColumn("model_score", F.col("good"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    try:
        for parts in ("4", "300"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            out = model.permutation_importance(score, df, ["good", "noise"], repeats=2).collect()
            got.append({r["feature"]: (round(r["importance_mean"], 9), round(r["importance_std"], 9)) for r in out})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got[0] == got[1] and got[0]["good"][0] > 0.3 and got[0]["noise"][0] == 0.0


def test_calibration_bins_close_at_their_upper_edge(spark):
    df = spark.createDataFrame([(s, 0) for s in (0.1, 0.2, 0.3, 0.3, 0.3, 0.4)], "score double, is_fraud int")
    assert sorted((r["bin"], r["n"]) for r in evaluation.calibration_curve(df, n_bins=2).collect()) == [(0, 5), (1, 1)]


def test_budget_grid():
    for n in (10, 400, 10_000):
        top = max(50, int(n * 0.12))
        want = np.unique(np.clip(np.linspace(max(1, top // 60), top, 60).astype(int), 1, n)).tolist()
        assert evaluation.budget_grid(n) == want


def test_value_curve_and_top_k_equal_a_sort(spark, monkeypatch):
    monkeypatch.setattr(radix, "REST", 5)          # several passes on a small table too
    rows = [(i, (i * 7 % 50) / 50, float(i), i % 3 == 0, 100 * i, float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "transaction_id long, score double, ts_us double, is_fraud boolean, amount_minor long, "
                                     "amount double").withColumn("is_fraud", F.col("is_fraud").cast("int"))
    budgets = [1, 7, 50, 199, 200, 400]
    order = sorted(rows, key=lambda r: (-r[1], r[2], r[0]))
    total = sum(r[4] for r in rows if r[3])
    got = {r["k"]: r["value_share"] for r in evaluation.value_budget_curve(df, budgets).collect()}
    assert got == {k: sum(r[4] for r in order[:k] if r[3]) / total for k in budgets}
    for k in (0, 20, 199, 500):
        assert {r["transaction_id"] for r in evaluation.top_k(df, k).collect()} == {r[0] for r in order[:k]}


def test_integer_running_sums_are_exact(spark):
    big = 9_007_199_254_740_993
    df = spark.createDataFrame([(i, big if i else None) for i in range(4)], "i int, v long")
    got = {r["i"]: r["cum_v"] for r in global_cumulative(df, [F.col("i")], {"v": F.col("v")}, keep=["i"]).collect()}
    assert got == {0: 0, 1: big, 2: 2 * big, 3: 3 * big}


def test_random_reference_uses_the_money_scale(spark):
    df = spark.createDataFrame([(i, float(i), 0.5, 1, 1000 * 2, 2.0) for i in range(10)],
                               "transaction_id long, score double, ts_us double, is_fraud int, amount_minor long, amount double")
    out = evaluation.value_budget_curve(df, [2], minor_per_unit=1000).first()
    assert out["random_reference"] == pytest.approx(0.2)


def test_forest_samples_do_not_favour_ids(spark):
    df = spark.range(4000).select(F.col("id").alias("transaction_id"), F.col("id").cast("double").alias("x"))
    nodes = anomaly.fit_isolation_forest(df, ["x"], n_trees=40, sample_size=64)
    roots = nodes[nodes["node"] == 0]
    assert len(roots) == 40 and (roots["size"] == 64).all()
    assert 1600 < roots["split"].mean() < 2400          # the first splits lie all over the range
