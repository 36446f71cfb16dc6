"""As-of card features: strictly-earlier rows only, exact edges and ties."""

import datetime as dt

from pyspark.sql import functions as F

from helpers import T0, by_id, card_frame, tiny_card
from ledgerguard.functions.geo import haversine_km
from ledgerguard.operators.features import add_card_features
from ledgerguard.operators import warehouse


def test_velocity_excludes_current_and_counts_only_past(spark):
    f = by_id(add_card_features(tiny_card(spark)))
    assert [f[i]["txn_count_1h"] for i in (1, 2, 3, 4)] == [0, 1, 2, 0]
    assert f[2]["amt_sum_1h"] == 20.0
    assert f[3]["amt_sum_1h"] == 45.0
    assert f[4]["txn_count_24h"] == 3


def test_time_since_last_and_first_row_gap(spark):
    f = by_id(add_card_features(tiny_card(spark)))
    assert f[1]["time_since_last_s"] > 1_000_000
    assert f[2]["time_since_last_s"] == 600
    assert f[3]["time_since_last_s"] == 1200


def test_mcc_novelty_speed_channel_age(spark):
    f = by_id(add_card_features(tiny_card(spark)))
    assert [f[i]["mcc_novel"] for i in (1, 2, 3, 4)] == [1, 0, 1, 1]
    assert f[4]["geo_speed_kmh"] > 900
    assert [f[i]["is_cnp"] for i in (1, 2, 3, 4)] == [0, 0, 1, 1]
    assert all(f[i]["card_age_days"] >= 100 for i in (1, 2, 3, 4))
    assert f[1]["geo_dist_km"] == 0.0 and f[1]["geo_speed_kmh"] == 0.0


def test_haversine_known_distance(spark):
    d = spark.range(1).select(haversine_km(F.lit(40.6413), F.lit(-73.7781), F.lit(33.9416), F.lit(-118.4085))
                              .alias("d")).first()["d"]
    assert 3800 < d < 4050


def test_window_lower_edge_is_inclusive(spark):
    h = dt.timedelta(hours=1)
    us = dt.timedelta(microseconds=1)
    f = by_id(add_card_features(card_frame(spark, [
        (1, 1, 1, 1, 10.0, T0, 0.0, 0.0, "CP"),
        (2, 1, 1, 1, 10.0, T0 + h, 0.0, 0.0, "CP"),             # exactly 1 h after row 1: counted
        (3, 2, 1, 1, 10.0, T0, 0.0, 0.0, "CP"),
        (4, 2, 1, 1, 10.0, T0 + h + us, 0.0, 0.0, "CP"),        # 1 h + 1 us: not counted
    ])))
    assert f[2]["txn_count_1h"] == 1 and f[2]["amt_sum_1h"] == 10.0
    assert f[4]["txn_count_1h"] == 0 and f[4]["amt_sum_1h"] == 0.0


def test_time_ties_count_only_earlier_ids_but_mart_counts_peers(spark):
    rows = [(i, 1, 1, 1, 10.0 * i, T0, 0.0, 0.0, "CP") for i in (1, 2, 3)]
    rows += [(4, 1, 1, 1, 1.0, T0 + dt.timedelta(minutes=5), 0.0, 0.0, "CP"),
             (5, 1, 1, 1, 1.0, T0 + dt.timedelta(minutes=5), 0.0, 0.0, "CP")]
    raw = card_frame(spark, rows)
    f = by_id(add_card_features(raw))
    assert [f[i]["txn_count_1h"] for i in (1, 2, 3, 4, 5)] == [0, 1, 2, 3, 4]
    v = by_id(warehouse.fct_card_velocity(warehouse.stg_transactions(raw)))
    # the SQL mart excludes only the current row: all peers count
    assert [v[i]["txn_count_1h"] for i in (1, 2, 3, 4, 5)] == [2, 2, 2, 4, 4]
    assert v[1]["time_since_last_s"] is None


def test_constant_spend_gives_zero_z(spark):
    m = dt.timedelta(minutes=1)
    rows = [(i, 1, 1, 1, 20.10, T0 + i * m, 0.0, 0.0, "CP") for i in range(1, 8)]
    rows.append((8, 1, 1, 1, 50.0, T0 + 8 * m, 0.0, 0.0, "CP"))
    rows.append((9, 1, 1, 1, 20.10, T0 + 9 * m, 0.0, 0.0, "CP"))
    f = by_id(add_card_features(card_frame(spark, rows)))
    assert all(f[i]["amount_z"] == 0.0 for i in range(1, 9))   # zero prior variance -> 0
    assert f[9]["amount_z"] < 0


def test_one_row_card_defaults(spark):
    f = add_card_features(card_frame(spark, [(1, 7, 1, 1, 5.0, T0, 1.0, 1.0, "CNP")])).first()
    assert (f["txn_count_1h"], f["txn_count_24h"], f["amt_sum_24h"]) == (0, 0, 0.0)
    assert f["time_since_last_s"] == 2_592_000.0
    assert f["geo_dist_km"] == 0.0 and f["geo_speed_kmh"] == 0.0 and f["amount_z"] == 0.0


def test_no_leakage_after_truncation(spark):
    from ledgerguard.operators.quality import leakage_check
    from ledgerguard.sources.adapters import load_card_transactions
    t = load_card_transactions(spark, "/root/testdata/sf0.001")
    cut = t.approxQuantile("ts_us", [0.4], 0.0)[0]
    cols = ["txn_count_1h", "amt_sum_24h", "amount_z", "mcc_novel", "geo_speed_kmh"]
    assert leakage_check(t, add_card_features, int(cut), cols=cols).count() == 0


def test_hot_key_split_equals_plain_path(spark):
    from ledgerguard.operators.features import add_card_features_skew_safe, detect_hot_keys
    from ledgerguard.sources.adapters import load_card_transactions
    t = load_card_transactions(spark, "/root/testdata/sf0.001")
    cols = ["transaction_id", "txn_count_1h", "amt_sum_1h", "txn_count_24h", "amt_sum_24h", "amount_z",
            "time_since_last_s", "geo_dist_km", "geo_speed_kmh", "mcc_novel", "card_age_days"]
    plain = add_card_features(t).select(cols)
    every = [r[0] for r in t.select("card_id").distinct().collect()]
    split = add_card_features_skew_safe(t, hot_keys=every).select(cols)
    assert plain.exceptAll(split).count() == 0 and split.exceptAll(plain).count() == 0
    assert len(detect_hot_keys(t, min_rows=10)) >= 3


def test_hot_key_split_day_gaps_and_ties(spark):
    """Hot path across empty days (previous row from an earlier day) and ties."""
    from ledgerguard.operators.features import add_card_features_skew_safe
    d, h = dt.timedelta(days=1), dt.timedelta(hours=1)
    rows = [(1, 1, 1, 1, 10.0, T0, 10.0, 10.0, "CNP"), (2, 1, 1, 2, 20.0, T0, 10.0, 10.0, "CP"),
            (3, 1, 1, 1, 30.0, T0 + 23 * h, 11.0, 10.0, "CP"), (4, 1, 1, 1, 40.0, T0 + d + h, 12.0, 10.0, "CNP"),
            (5, 1, 1, 3, 50.0, T0 + 5 * d, 40.0, 10.0, "CP"), (6, 1, 1, 2, 60.0, T0 + 5 * d + h, 40.0, 10.0, "CP")]
    t = card_frame(spark, rows)
    cols = ["transaction_id", "txn_count_1h", "amt_sum_24h", "txn_count_24h", "amount_z", "time_since_last_s",
            "geo_dist_km", "mcc_novel"]
    a = add_card_features(t).select(cols)
    b = add_card_features_skew_safe(t, hot_keys=[1]).select(cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_velocity_mart_hot_split_equals_window_path(spark):
    from ledgerguard.sources.adapters import load_card_transactions
    t = warehouse.stg_transactions(load_card_transactions(spark, "/root/testdata/sf0.001"))
    every = [r[0] for r in t.select("card_id").distinct().collect()]
    a = warehouse.fct_card_velocity(t)
    b = warehouse.fct_card_velocity_skew_safe(t, hot_keys=every)
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    # ties and a gap of several days
    d, h = dt.timedelta(days=1), dt.timedelta(hours=1)
    rows = [(1, 1, 1, 1, 10.0, T0, 0.0, 0.0, "CP"), (2, 1, 1, 1, 20.0, T0, 0.0, 0.0, "CP"),
            (3, 1, 1, 1, 30.0, T0 + 23 * h + 30 * dt.timedelta(minutes=1), 0.0, 0.0, "CP"),
            (4, 1, 1, 1, 40.0, T0 + d, 0.0, 0.0, "CP"), (5, 1, 1, 1, 50.0, T0 + 4 * d, 0.0, 0.0, "CP")]
    s = warehouse.stg_transactions(card_frame(spark, rows))
    a = warehouse.fct_card_velocity(s)
    b = warehouse.fct_card_velocity_skew_safe(s, hot_keys=[1])
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
