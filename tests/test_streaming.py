"""Streaming as-of features: equal to batch on in-order data; late rows routed aside."""

import os
import tempfile
import time

from pyspark.sql import functions as F

from ledgerguard.operators.features import add_card_features
from ledgerguard.sources.adapters import load_card_transactions
from ledgerguard.streaming import card_stream as cs

SF = "/root/testdata/sf0.001"


def test_stream_equals_batch(spark):
    path = cs.run_to_parquet(cs.asof_feature_stream(cs.read_event_stream(spark, f"{SF}/events.parquet")), "t")
    s = spark.read.parquet(path).where("late = 0").select("transaction_id", "txn_count_24h", "amt_sum_24h",
                                                          "amount_z", "mcc_novel")
    b = add_card_features(load_card_transactions(spark, SF)).select("transaction_id", "txn_count_24h",
                                                                     "amt_sum_24h", "amount_z", "mcc_novel")
    assert s.count() == b.count()
    assert s.exceptAll(b).count() == 0


def test_late_rows_go_to_side_output(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    cut = ev.approxQuantile("event_id", [0.5], 0.0)[0]
    d = tempfile.mkdtemp(prefix="lg-late-")
    # the later half arrives first, the earlier half second
    ev.where(F.col("event_id") >= cut).coalesce(1).write.parquet(f"{d}/a")
    time.sleep(1.1)
    ev.where(F.col("event_id") < cut).coalesce(1).write.parquet(f"{d}/b")
    os.makedirs(f"{d}/in")
    for sub in ("a", "b"):
        f = [x for x in os.listdir(f"{d}/{sub}") if x.endswith(".parquet")][0]
        os.link(f"{d}/{sub}/{f}", f"{d}/in/{sub}.parquet")
        time.sleep(1.1)
    out = cs.run_to_parquet(cs.asof_feature_stream(cs.read_event_stream(spark, f"{d}/in")), "late")
    res = spark.read.parquet(out)
    on_time, late = cs.split_late(res)
    assert res.count() == ev.count()
    assert late.count() > 0 and on_time.count() > 0


def test_daily_windows_only_closed(spark):
    path = cs.run_to_parquet(cs.daily_window_stream(cs.read_event_stream(spark, f"{SF}/events.parquet")), "d")
    w = spark.read.parquet(path)
    mx = load_card_transactions(spark, SF).agg(F.max("ts_us")).first()[0]
    assert w.where(F.col("window_start_us") + 86400_000000 > mx - 86400_000000).count() == 0
    assert w.count() > 0
