"""Entity resolution, device rings and gating on small wide fixtures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerguard.operators import rings
from ledgerguard.operators.wide_features import add_wide_features
from ledgerguard.sources.readers import normalise_identity_names, normalise_wide

TX = ("TransactionID long, isFraud int, TransactionDT long, TransactionAmt double, card1 long, card2 double, "
      "card3 double, card5 double, addr1 double, P_emaildomain string")
IDN = "TransactionID long, DeviceInfo string"


def ring_small(spark):
    tx = spark.createDataFrame([
        (1, 0, 3600, 10.0, 1, 100.0, 150.0, 226.0, 300.0, "a"),
        (2, 0, 7200, 20.0, 1, 100.0, 150.0, 226.0, 300.0, "a"),
        (3, 1, 10800, 30.0, 2, 200.0, 150.0, 226.0, 310.0, "a"),
        (4, 1, 14400, 40.0, 3, 300.0, 150.0, 226.0, 320.0, "b"),
        (5, 0, 18000, 50.0, 9, 900.0, 150.0, 226.0, None, "a"),
    ], TX)
    idn = spark.createDataFrame([(1, "ringdev"), (2, "ringdev"), (3, "ringdev"), (4, "ringdev"), (5, None)], IDN)
    return add_wide_features(normalise_wide(tx, idn))


def rows(df):
    return {r["TransactionID"]: r for r in df.collect()}


def test_uid_groups_and_prior_distinct(spark):
    f, cols = ring_small(spark)
    r = rows(f)
    assert r[1]["uid"] == r[2]["uid"] == "1-100.0-150.0-226.0-300.0"
    assert r[5]["uid"].endswith("-na")
    assert [r[i]["device_prior_cards"] for i in (1, 2, 3, 4, 5)] == [0, 1, 1, 2, 0]
    assert r[5]["device_prior_txn"] == 0 and r[5]["has_identity"] == 0 and r[5]["device_fp_freq"] == 0
    assert [r[i]["uid_txn_24h"] for i in (1, 2)] == [0, 1]
    assert r[1]["email_domain_freq"] == 4 and r[4]["email_domain_freq"] == 1
    assert r[5]["addr1_freq"] == -1.0


def test_no_nulls_in_features(spark):
    f, cols = ring_small(spark)
    nulls = f.select([F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first().asDict()
    assert all(v == 0 for v in nulls.values())
    assert "device_prior_cards" in cols and len(cols) == len(set(cols))


def test_fingerprint_splits_browsers(spark):
    tx = spark.createDataFrame([(1, 0, 0, 1.0, 1, 1.0, 1.0, 1.0, 1.0, "a"), (2, 0, 1, 1.0, 1, 1.0, 1.0, 1.0, 1.0, "a")], TX)
    idn = spark.createDataFrame([(1, "Windows", "chrome", "1920x1080"), (2, "Windows", "firefox", "1920x1080")],
                                "TransactionID long, DeviceInfo string, `id-31` string, id_33 string")
    f, _ = add_wide_features(normalise_wide(tx, idn))
    fps = {r["TransactionID"]: r["device_fp"] for r in f.collect()}
    assert fps[1] != fps[2] and fps[1] == "Windows|chrome|1920x1080"


def test_identity_names_normalised(spark):
    idn = spark.createDataFrame([(1, "x")], "TransactionID long, `id-31` string")
    assert normalise_identity_names(idn).columns == ["TransactionID", "id_31"]


def test_gating(spark):
    g = spark.createDataFrame([(1, 8.0, 0.0001, 0.0), (2, 8.0, 0.20, 0.0), (3, 0.0, 0.0001, 0.0),
                               (4, 10.0, 0.0001, 0.0), (5, 10.0, 0.20, 0.0), (6, 8.0, 0.002, 0.0)],
                              "id long, device_prior_cards double, device_fp_freq double, uid_txn_24h double")
    r = {x["id"]: x for x in g.select("id", rings.ring_reason_codes(g).alias("why"),
                                      rings.ring_rule_score(g).alias("score")).collect()}
    assert r[1]["why"] == "device shared by 8+ cards"
    assert r[2]["why"] == "model/anomaly only" and r[3]["why"] == "model/anomaly only"
    assert r[6]["why"] == "model/anomaly only"          # frequency equal to the limit is excluded
    assert r[4]["score"] == pytest.approx(1.0) and r[5]["score"] == 0.0


def test_code_map_fallback_equals_inline(spark, monkeypatch):
    import ledgerguard.operators.wide_features as WF
    from ledgerguard.sources.adapters import load_wide
    tx, idn = load_wide(spark, "/root/testdata/sf0.001")
    n = normalise_wide(tx, idn)
    cols = ["TransactionID", "card4_code", "DeviceType_code", "M4_code", "id_31_code"]
    inline = WF.add_wide_features(n)[0].select(cols)
    monkeypatch.setattr(WF, "CODE_MAP_MAX", 2)
    joined = WF.add_wide_features(n)[0].select(cols)
    assert inline.exceptAll(joined).count() == 0 and joined.exceptAll(inline).count() == 0


def test_device_hot_split_equals_window_path(spark):
    from ledgerguard.sources.adapters import load_wide
    tx, idn = load_wide(spark, "/root/testdata/sf0.001")
    n = normalise_wide(tx, idn)
    cols = ["TransactionID", "device_prior_txn", "device_prior_cards", "device_fp_freq"]
    plain = add_wide_features(n)[0].select(cols)
    hot = add_wide_features(n, hot_min_rows=20)[0].select(cols)
    assert plain.exceptAll(hot).count() == 0 and hot.exceptAll(plain).count() == 0


def test_card1_hot_split_equals_window_path(spark):
    from ledgerguard.sources.adapters import load_wide
    tx, idn = load_wide(spark, "/root/testdata/sf0.001")
    n = normalise_wide(tx, idn)
    cols = ["TransactionID", "card1_prior_txn", "card1_prior_amt_mean", "amt_to_card1_mean", "card1_freq",
            "uid_txn_24h", "uid_amt_24h", "uid_tsl_log", "uid_amount_z", "uid_prior_txn",
            "client_prior_txn", "client_freq"]
    plain = add_wide_features(n)[0].select(cols)
    every = [r[0] for r in tx.select("card1").distinct().collect()]
    split = add_wide_features(n, hot_card1=every)[0].select(cols)
    assert split.count() == plain.count()
    assert plain.exceptAll(split).count() == 0 and split.exceptAll(plain).count() == 0


def test_card1_hot_split_null_keys(spark):
    """Hot path with NULL addr1 / NULL D1 rows (NULL keys group together)."""
    tx = spark.createDataFrame([
        (1, 0, 0, 10.0, 1, 1.0, 150.0, 226.0, None, "a"),
        (2, 0, 3600, 20.0, 1, 1.0, 150.0, 226.0, None, "a"),
        (3, 1, 90000, 30.0, 1, 1.0, 150.0, 226.0, None, "a"),
        (4, 0, 400000, 40.0, 1, 1.0, 150.0, 226.0, 5.0, "a"),
        (5, 0, 400000, 40.0, 1, 1.0, 150.0, 226.0, 5.0, "a"),
    ], TX)
    n = normalise_wide(tx, None)
    cols = ["TransactionID", "card1_prior_txn", "uid_txn_24h", "uid_amt_24h", "uid_tsl_log", "uid_prior_txn",
            "client_prior_txn", "client_freq"]
    a = add_wide_features(n)[0].select(cols)
    b = add_wide_features(n, hot_card1=[1])[0].select(cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_frequency_scopes(spark):
    tx = spark.createDataFrame([
        (1, 0, 0, 10.0, 1, 1.0, 150.0, 226.0, 300.0, "a"),
        (2, 0, 3600, 20.0, 2, 1.0, 150.0, 226.0, 300.0, "a"),
        (3, 1, 7200, 30.0, 3, 2.0, 150.0, 226.0, 310.0, "b"),
        (4, 1, 7200, 40.0, 4, 1.0, 150.0, 226.0, 300.0, "a"),
        (5, 0, 400000, 50.0, 5, 1.0, 150.0, 226.0, None, None),
    ], TX)
    n = normalise_wide(tx, None)
    asof_rows = rows(add_wide_features(n, freq_scope="asof")[0])
    # strictly earlier rows with the same key, ties by TransactionID
    assert [asof_rows[i]["card2_freq"] for i in (1, 2, 3, 4, 5)] == [0, 1, 0, 2, 3]
    assert [asof_rows[i]["card3_freq"] for i in (1, 2, 3, 4, 5)] == [0, 1, 2, 3, 4]
    assert asof_rows[5]["addr1_freq"] == -1.0 and asof_rows[5]["email_domain_freq"] == 0.0
    assert [asof_rows[i]["email_domain_freq"] for i in (1, 2, 3, 4)] == [0, 1, 0, 2]
    train = n.where("TransactionID <= 2")
    tr = rows(add_wide_features(n, freq_scope="train", freq_reference=train)[0])
    assert [tr[i]["card2_freq"] for i in (1, 3, 5)] == [2, -1.0, 2]
    table = rows(add_wide_features(n)[0])
    assert table[1]["card2_freq"] == 4


def test_wide_asof_features_do_not_leak(spark):
    import numpy as np
    from ledgerguard.operators.quality import leakage_check
    from ledgerguard.sources.adapters import load_wide
    tx, idn = load_wide(spark, "/root/testdata/sf0.001")
    n = normalise_wide(tx, idn)
    cols = ["uid_txn_24h", "uid_amt_24h", "uid_tsl_log", "uid_amount_z", "uid_prior_txn", "device_prior_txn",
            "device_prior_cards", "card1_prior_txn", "card1_prior_amt_mean", "client_prior_txn",
            "card2_freq", "email_domain_freq", "card1_addr1_freq"]
    build = lambda d: add_wide_features(d, freq_scope="asof")[0]
    lo, hi = n.agg(__import__("pyspark.sql.functions", fromlist=["min"]).min("ts_us"),
                   __import__("pyspark.sql.functions", fromlist=["max"]).max("ts_us")).first()
    for cut in np.random.default_rng(3).integers(lo, hi, 2):
        assert leakage_check(n, build, int(cut), key="TransactionID", cols=cols).count() == 0


def test_codes_of_values_first_seen_together_and_hash_aggregates(spark):
    """Values first seen at one time are coded by their ids; the statistics need no sort of unpivoted rows."""
    from ledgerguard.operators import wide_features
    df = spark.createDataFrame([(5, 10, "b", 1, 0.0), (4, 10, "c", 1, -0.0), (3, 20, "a", 2, 0.0), (9, 10, "b", None, None)],
                               "TransactionID long, ts_us long, M1 string, card1 long, card2 double")
    codes, hot, cards, hot_c1, counted = wide_features.key_statistics(
        df, ["M1"], {"card2_freq": F.col("card2")}, F.lit("fp"), F.lit(True), 2)
    assert [(v, c) for _, v, c in codes] == [("c", 0), ("b", 1), ("a", 2)]
    assert hot == ["fp"] and hot_c1 == ["1"] and cards == {"card2_freq": 1}
    assert {r["value"]: r["n"] for r in counted.collect()} == {"0.0": 3}


def test_prior_counts_of_several_keys_in_one_pass(spark):
    from ledgerguard.operators import hot_windows
    df = spark.createDataFrame([(1, 10, "x", None), (2, 10, "x", 1.5), (3, 5, "x", 1.5), (4, 30, "y", 1.5)],
                               "TransactionID long, ts_us long, a string, b double")
    got = {r["TransactionID"]: (r["na"], r["nb"]) for r in hot_windows.prior_counts(
        df, {"na": "a", "nb": "b"}, "ts_us", "TransactionID").collect()}
    assert got == {1: (1, None), 2: (2, 1), 3: (0, 0), 4: (0, 2)}


def test_the_wide_table_is_joined_once(spark):
    """Statistics, table size, frequencies and windows read the stored join, not the sources again."""
    f, _ = ring_small(spark)
    plan = f._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" in plan and "LocalRelation" not in plan


def test_hot_keys_are_split_off_without_moving_rows(spark):
    """A few hot keys are broadcast: no row is shuffled to be split off."""
    from ledgerguard.operators import asof
    df = spark.createDataFrame([(i, ("a", "b", None)[i % 3]) for i in range(30)], "i long, k string").repartition(4, "i")
    for part, n in zip(asof.split_hot(df, F.col("k"), ["a", None]), (20, 10), strict=True):
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning(coalesce" not in plan
        assert part.count() == n


def test_pair_counts_share_the_card1_partitions(spark):
    """Rows of (card1, addr1), nulls included, without a join; the same for hot card1 values."""
    tx = spark.createDataFrame([
        (i, 0, 3600 * i, 10.0, c, 1.0, 150.0, 226.0, a, "a")
        for i, (c, a) in enumerate([(1, 5.0), (1, 5.0), (1, None), (1, None), (1, 6.0), (2, 5.0), (None, 5.0), (None, 5.0), (None, None)])], TX)
    want = dict(enumerate([2, 2, 2, 2, 1, 1, 2, 2, 1]))
    for hot in ([], [1, None]):
        f = add_wide_features(normalise_wide(tx, None), hot_card1=hot)[0]
        assert {i: r["card1_addr1_freq"] for i, r in rows(f).items()} == want
    plan = add_wide_features(normalise_wide(tx, None))[0]._jdf.queryExecution().executedPlan().toString()
    assert "_k_card1_addr1_freq" not in plan


def test_device_windows_move_rows_once(spark):
    import re
    from ledgerguard.operators.wide_features import _device_windows
    df = spark.createDataFrame([(i, i, "d", i % 2) for i in range(9)], "TransactionID long, ts_us long, device_fp string, card1 long")
    f = _device_windows(df, F.lit(True))
    assert len(re.findall("Exchange hashpartitioning", f._jdf.queryExecution().executedPlan().toString())) == 1
    assert f.agg(F.max("_dev_total"), F.max("_dev_prior_n"), F.max("_dev_prior_distinct")).first() == (9, 8, 2)


def test_only_the_features_that_are_read_with_the_values_of_the_whole_set(spark):
    """Passes over hot keys, and columns, of features that nobody reads are left out."""
    tx = spark.createDataFrame([(i, 0, 3600 * (i % 7), 10.0 + i, i % 4 or None, 1.0 * (i % 3), 150.0, 226.0, 300.0 + i % 2, "a")
                                for i in range(1, 41)], TX)
    idn = spark.createDataFrame([(i, f"d{i % 3}") for i in range(1, 30)], IDN)
    n = normalise_wide(tx, idn)
    whole = add_wide_features(n, hot_min_rows=8)[0]
    for cols in (["client_prior_txn", "client_freq"], ["device_prior_cards", "device_fp_freq"]):
        some, names = add_wide_features(n, hot_min_rows=8, only=cols)
        assert names and set(names) == set(cols) and some.columns == ["TransactionID", *names]
        want = whole.select(some.columns)
        assert some.exceptAll(want).count() == 0 and want.exceptAll(some).count() == 0


def test_hot_keys_by_buckets_are_exact(spark):
    from ledgerguard.operators.wide_features import hot_keys
    df = spark.createDataFrame([("a", 1)] * 5 + [("b", None)] * 4 + [(None, 2)] * 3 + [("c", 3)], "k string, v long")
    found = hot_keys(df, {"k": F.col("k"), "v": F.col("v").cast("string")}, 4)
    assert sorted(found["k"]) == ["a", "b"] and set(found["v"]) == {"1", None}
