"""Deterministic adapters from the supplied test tables to the two data models.

``card_transactions``  events                      -> card-transaction table
``wide_transactions``  orders + customer           -> wide transaction table
``wide_identity``      lineitem                    -> sparse identity table

The same expressions are written as DuckDB SQL in ``ledgerguard.plans.oracle``;
all integer arithmetic is division of non-negative values, so both engines agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerguard.functions.timecols import US_PER_DAY, US_PER_SECOND, epoch_us, from_epoch_us

# Fixed values of the card adapter.
ADAPTER_T0_US = 1_704_067_200_000_000          # 2024-01-01 00:00:00
MCC_BY_EVENT = {"click": 5411, "view": 5812, "signup": 5999, "purchase": 5967, "error": 4829}
CNP_EVENTS = ["click", "purchase", "error"]

# Fixed values of the wide adapter.
WIDE_DT_ORIGIN_US = 788_918_400_000_000        # 1995-01-01 00:00:00 (TransactionDT origin)
WIDE_REF_DATE_US = 1_512_086_400_000_000       # 2017-12-01 00:00:00 (ts = REF_DATE + DT)
PRODUCT_BY_PRIORITY = {"1": "W", "2": "C", "3": "R", "4": "H", "5": "S"}
CARD4_VALUES = ["visa", "mastercard", "american express", "discover"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def card_transactions(events: DataFrame) -> DataFrame:
    """Card transactions from ``events``; adds ``ts_us``, ``issue_us`` and ``amount_minor``."""
    k = F.get_json_object("props", "$.k").cast("int")
    q = F.when(F.col("user_id") % 10 == 0, F.lit(60)).otherwise(F.lit(4)).cast("long")
    raw_us = epoch_us("ts")
    mcc = F.lit(None).cast("int")
    for ev, code in reversed(list(MCC_BY_EVENT.items())):
        mcc = F.when(F.col("event_type") == ev, F.lit(code)).otherwise(mcc)
    base = events.select(
        F.col("event_id").alias("transaction_id"),
        F.col("user_id").alias("card_id"),
        k.alias("k"),
        F.col("event_type"),
        F.col("value").alias("amount"),
        (raw_us - F.lit(ADAPTER_T0_US)).alias("off_us"),
        q.alias("q"),
    ).withColumn("ts_us", F.lit(ADAPTER_T0_US) + F.expr("off_us div q"))
    uid = F.col("card_id")
    kk = F.col("k")
    lat = (F.lit(25) + (uid * 31 % 2000) / 100 + (kk % 20) / 100
           + F.when(kk >= 95, F.lit(8)).otherwise(F.lit(0)))
    lon = F.lit(-120) + (uid * 53 % 5000) / 100 - (kk % 20) / 100
    issue_us = F.lit(ADAPTER_T0_US) - (uid * 37 % 900 + 5) * F.lit(US_PER_DAY)
    return base.select(
        "transaction_id", "card_id",
        (kk + 1).cast("long").alias("merchant_id"),
        mcc.alias("mcc"),
        F.col("amount"),
        F.round(F.col("amount") * 100).cast("long").alias("amount_minor"),
        from_epoch_us("ts_us").alias("ts"),
        F.col("ts_us"),
        lat.cast("double").alias("lat"),
        lon.cast("double").alias("lon"),
        F.when(F.col("event_type").isin(CNP_EVENTS), F.lit("CNP")).otherwise(F.lit("CP")).alias("channel"),
        from_epoch_us(issue_us).alias("card_issue_date"),
        issue_us.cast("long").alias("issue_us"),
        ((F.col("event_type") == "error") & (kk < 12)).cast("int").alias("is_fraud"),
    )


def load_card_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return card_transactions(read_table(spark, sf_dir, "events"))


def wide_transactions(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Wide transaction table (competition-file shape) from orders and customers.

    customer grows with the data, so the join is left to the planner (AQE picks
    broadcast only when the runtime size allows it).
    """
    o = orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate",
                      "o_orderpriority", "o_orderstatus")
    c = customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey, "left")
    dt = F.floor((epoch_us("o_orderdate") - F.lit(WIDE_DT_ORIGIN_US)) / F.lit(US_PER_SECOND)).cast("long")
    pcd = F.lit(None).cast("string")
    for digit, code in reversed(list(PRODUCT_BY_PRIORITY.items())):
        pcd = F.when(F.substring("o_orderpriority", 1, 1) == digit, F.lit(code)).otherwise(pcd)
    nat = F.col("c_nationkey")
    card4 = F.element_at(F.array(*[F.lit(v) for v in CARD4_VALUES]), (F.col("o_custkey") % 4 + 1).cast("int"))
    return j.select(
        F.col("o_orderkey").alias("TransactionID"),
        ((F.col("o_orderkey") * 7919) % 1000 < 35).cast("int").alias("isFraud"),
        dt.alias("TransactionDT"),
        F.col("o_totalprice").alias("TransactionAmt"),
        pcd.alias("ProductCD"),
        F.col("o_custkey").alias("card1"),
        nat.cast("double").alias("card2"),
        F.lit(150.0).alias("card3"),
        card4.alias("card4"),
        (F.lit(100) + nat % 4).cast("double").alias("card5"),
        F.when(F.col("o_custkey") % 3 == 0, F.lit("debit")).otherwise(F.lit("credit")).alias("card6"),
        nat.cast("double").alias("addr1"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(None)).otherwise(F.col("o_orderkey") % 500)
         .cast("double").alias("dist1"),
        F.concat(F.lower(F.col("c_mktsegment")), F.lit(".com")).alias("P_emaildomain"),
        (F.col("o_custkey") % 13).cast("double").alias("C1"),
        (nat * 3 % 11).cast("double").alias("C2"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit(None)).otherwise(F.col("o_orderkey") % 200)
         .cast("double").alias("D1"),
        F.when(F.col("o_custkey") % 5 == 0, F.lit(None)).otherwise(F.col("o_custkey") % 30)
         .cast("double").alias("D2"),
        (F.col("o_orderkey") % 17).cast("double").alias("V1"),
        (F.col("o_orderkey") % 5).cast("double").alias("V2"),
        F.col("o_orderstatus").alias("M4"),
        F.when(F.col("o_orderkey") % 2 == 0, F.lit("T")).otherwise(F.lit("F")).alias("M6"),
    )


def wide_identity(lineitem: DataFrame) -> DataFrame:
    """Sparse identity table: one row per order whose smallest part key is not a multiple of 3.

    (l_orderkey, l_linenumber) is not unique in the test tables, so the rows are
    always aggregated per order first (partial aggregation before the shuffle).
    """
    agg = (lineitem.groupBy("l_orderkey")
           .agg(F.min("l_partkey").alias("p"), F.min("l_returnflag").alias("id_31"),
                F.min("l_linestatus").alias("id_33")))
    p = F.col("p")
    return agg.where(p % 3 != 0).select(
        F.col("l_orderkey").alias("TransactionID"),
        F.when(p % 2 == 0, F.lit("mobile")).otherwise(F.lit("desktop")).alias("DeviceType"),
        F.when(p % 4 == 0, F.lit("Windows")).otherwise(F.concat(F.lit("dev"), p.cast("string"))).alias("DeviceInfo"),
        ((p % 50) * -5).cast("double").alias("id_01"),
        F.col("id_31"),
        F.col("id_33"),
    )


def load_wide(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    tx = wide_transactions(read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "customer"))
    idn = wide_identity(read_table(spark, sf_dir, "lineitem"))
    return tx, idn


def wide_ts_us(dt_col="TransactionDT"):
    return F.lit(WIDE_REF_DATE_US) + F.col(dt_col) * F.lit(US_PER_SECOND)


def prepare_card_frame(raw: DataFrame, scale: int = 2) -> DataFrame:
    """Canonical raw card transactions (``TXN_SCHEMA``: ts and card_issue_date as
    naive timestamps) -> operator input: adds ts_us, issue_us and amount_minor."""
    return raw.withColumns({
        "ts_us": epoch_us("ts"),
        "issue_us": epoch_us("card_issue_date"),
        "amount_minor": F.round(F.col("amount") * F.lit(10 ** scale)).cast("long"),
    })
