"""Prefix-sum history of hot keys against plain windows, also when one day holds all rows."""

import datetime as dt
import random

from pyspark.sql import functions as F

from ledgerguard.operators import hot_windows, warehouse
from ledgerguard.operators.features import add_card_features, add_card_features_skew_safe
from ledgerguard.operators.ordering import running_by_key
from tests.helpers import T0, card_frame

COLS = ["transaction_id", "txn_count_1h", "amt_sum_1h", "txn_count_24h", "amt_sum_24h", "amount_z", "time_since_last_s",
        "geo_dist_km", "geo_speed_kmh", "mcc_novel", "card_age_days"]


def same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def one_day(spark, seed, n=400, span=86_000):
    """One card, all rows within a day, many in the same second."""
    rng = random.Random(seed)
    return card_frame(spark, [(i, 1 if i % 5 else 2, 1, rng.randrange(4), rng.randrange(1, 9000) / 100,
                               T0 + dt.timedelta(seconds=rng.randrange(span)), rng.random() * 40, rng.random() * 40, "CNP")
                              for i in range(n)]).repartition(4)


def test_one_key_with_all_rows_of_one_day(spark):
    for span in (86_000, 3):
        t = one_day(spark, span, span=span)
        same(add_card_features(t).select(COLS), add_card_features_skew_safe(t, hot_keys=[1, 2]).select(COLS))
        s = warehouse.stg_transactions(t)
        same(warehouse.fct_card_velocity(s), warehouse.fct_card_velocity_skew_safe(s, hot_keys=[1, 2]))


def test_hot_day_spreads_over_tasks(spark):
    """The largest task holds a small part of a key that is the whole table."""
    rows = spark.range(40_000).select(F.lit(1).alias("k"), (F.col("id") % 7).alias("t"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")      # the table is small
    try:
        run = running_by_key(rows.repartition(8), ["k"], [F.col("t"), F.col("id")], {"n": F.lit(1)}, keep=["id"])
        sizes = [r["count"] for r in run.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) >= 3 and max(sizes) < 25_000
    assert run.agg(F.max("cum_n"), F.countDistinct("cum_n")).first()[0:2] == (40_000, 40_000)


def test_running_sums_of_many_keys_and_nulls(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, *range(40)]), rng.choice(["a", None]), i, rng.randrange(-9, 9)) for i in range(3000)]
    rows += [(99, "hot", 3000 + i, 1) for i in range(2000)]
    df = spark.createDataFrame(rows, "k int, s string, i long, v long").repartition(5)
    got = {r["i"]: (r["cum_n"], r["cum_v"]) for r in running_by_key(
        df, ["k", "s"], [F.col("i")], {"n": F.lit(1), "v": F.col("v")}, keep=["i"]).collect()}
    sums = {}
    for k, s, i, v in rows:
        n, t = sums.get((k, s), (0, 0))
        sums[k, s] = (n + 1, t + v)
        assert got[i] == sums[k, s]


def test_prior_block_equals_windows(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([None, 1, 2]), rng.randrange(5), rng.choice([None, 5, 7, 10 ** 12]), rng.randrange(300) * 10 ** 9)
            for i in range(500)]
    df = spark.createDataFrame(rows, "id long, k long, who long, c long, ts long")
    got = {r["id"]: r for r in hot_windows.prior_block(df, ["k"], "ts", "id", "c", 40 * 10 ** 9, distinct="who").collect()}
    order = sorted(rows, key=lambda r: (r[4], r[0]))
    for i, r in enumerate(order):
        before = [x for x in order[:i] if x[1] == r[1]]
        near = [x for x in before if x[4] >= r[4] - 40 * 10 ** 9]
        g = got[r[0]]
        assert g["_p_n"] == len(before) and g["_p_total"] == sum(x[1] == r[1] for x in rows)
        assert g["_p_gap"] == (r[4] - before[-1][4] if before else None)
        assert g["_p_s"] == sum(x[3] or 0 for x in before)
        assert g["_p_cw"] == len(near) and g["_p_sw"] == sum(x[3] or 0 for x in near)
        assert g["_p_distinct"] == len({x[2] for x in before})
