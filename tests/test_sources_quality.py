"""Sources and sinks round trips, data-quality checks on dirty rows."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from helpers import T0, card_frame
from ledgerguard.operators import quality, warehouse
from ledgerguard.sources import readers
from ledgerguard.sources.adapters import load_wide


def test_csv_pair_round_trip(spark):
    tx, idn = load_wide(spark, "/root/testdata/sf0.001")
    out = tempfile.mkdtemp(prefix="lg-csv-")
    readers.write_csv_pair(tx, idn, out)
    tx2 = readers.read_transaction_csv(spark, f"{out}/train_transaction")
    idn2 = readers.read_identity_csv(spark, f"{out}/train_identity")
    assert tx2.count() == tx.count() and idn2.count() == idn.count()
    assert dict(tx2.dtypes)["card1"] == "bigint" and dict(tx2.dtypes)["D1"] == "double"
    capped = readers.cap_rows(tx2, 100)
    assert readers.restrict_identity(idn2, capped).count() <= 100
    norm = readers.normalise_wide(capped, readers.restrict_identity(idn2, capped))
    assert norm.count() == 100 and {"ts_us", "amount", "is_fraud"} <= set(norm.columns)


def test_parquet_sink_partitioned(spark):
    t = card_frame(spark, [(1, 1, 1, 1, 1.0, T0, 0.0, 0.0, "CP"),
                           (2, 1, 1, 1, 1.0, T0 + dt.timedelta(days=1), 0.0, 0.0, "CP")])
    out = os.path.join(tempfile.mkdtemp(prefix="lg-pq-"), "featured")
    readers.write_featured_parquet(t, out)
    back = spark.read.parquet(out)
    assert back.count() == 2 and "event_date" in back.columns


def test_views_without_identity(spark):
    tx, _ = load_wide(spark, "/root/testdata/sf0.001")
    readers.register_analyst_views(spark, tx, None)
    j = spark.sql("SELECT count(*) AS n, count(DeviceInfo) AS d FROM joined").first()
    assert j["n"] == tx.count() and j["d"] == 0


def test_dirty_raw_checks(spark):
    t = card_frame(spark, [
        (1, 1, 1, 1, 10.0, T0, 0.0, 0.0, "CP"),
        (1, 1, 1, 1, 11.0, T0, 0.0, 0.0, "cnp"),       # duplicate key, lower-case channel
        (3, 1, 1, 1, -5.0, T0, 0.0, 0.0, "XX"),        # negative amount, bad channel
        (4, 1, 1, 1, None, T0, 0.0, 0.0, "CP"),        # null amount
    ])
    nn = {r["column_name"]: r["null_rows"] for r in quality.not_null(t, ["transaction_id", "amount"]).collect()}
    assert nn == {"transaction_id": 0, "amount": 1}
    assert quality.unique_summary(t, "transaction_id").first()["duplicate_keys"] == 1
    stg = warehouse.stg_transactions(t)
    assert stg.count() == 2                                   # amount >= 0 drops negative and null
    acc = {r["column_name"]: r["bad_rows"] for r in quality.accepted_values(t, {"channel": ["CP", "CNP"]}).collect()}
    assert acc["channel"] == 2
    assert quality.accepted_values(stg, {"channel": ["CP", "CNP"]}).first()["bad_rows"] == 0
    now = int((T0 - dt.datetime(1970, 1, 1)).total_seconds() * 1e6) + 30 * 3600 * 10 ** 6
    assert quality.freshness(t, now).first()["status"] == "warn"
