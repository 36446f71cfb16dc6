"""Incremental loads: the velocity mart (P2) and the category codes (E21) as stored tables that
later loads bring up to date without reading their history again.

*Mart.*  A folder holds, by ``event_date``: the staging rows (``staging``), the mart (``mart``)
and the last time of every card and date (``card_days``, the carried state).  A load reads its
own rows, the stored rows of the dates from its first one on, and one day of look-back (the
longest trailing frame); the previous row of a card that has none of these comes from
``card_days``.  Only the dates from the first new one on are written again, each as a whole, so
late rows and repeated loads (a row replaces the stored one with its id, whose date it keeps) give
the mart that one load of everything would.

*Codes.*  A dictionary (column, value, code, load) only grows: values that a load sees for the
first time get the next codes of their column, in order of first appearance; codes given once
never change.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ledgerguard.operators.warehouse import fct_card_velocity_skew_safe
from ledgerguard.session import cut_lineage

LOOK_BACK_DAYS = 1       # the longest trailing frame of the mart


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def _replace_dates(df: DataFrame, path: str) -> None:
    """Write the dates of ``df``, each replacing what was stored of it."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(path)


def load_velocity(stg: DataFrame, folder: str) -> DataFrame:
    """Bring the mart in ``folder`` up to date with the staging rows ``stg`` (new, late or
    repeated) and return it.  An empty load changes nothing."""
    spark = stg.sparkSession
    new = cut_lineage(stg.withColumn("event_date", F.to_date("event_ts")))
    first = new.agg(F.min("event_date").alias("d")).first()["d"]
    there = _exists(spark, f"{folder}/staging")
    if first is None:
        return read_mart(spark, folder) if there else fct_card_velocity_skew_safe(stg)
    since = F.lit(first)
    if there:
        old = spark.read.schema(new.schema).parquet(f"{folder}/staging")
        kept = old.where(F.col("event_date") >= since).join(new.select("transaction_id"), "transaction_id", "left_anti")
        rows = cut_lineage(kept.unionByName(new))
        back = old.where((F.col("event_date") < since) & (F.col("event_date") >= F.date_sub(since, LOOK_BACK_DAYS)))
        earlier = spark.read.parquet(f"{folder}/card_days").where(F.col("event_date") < since)
        last = earlier.groupBy(F.col("card_id").alias("_card")).agg(F.max("last_us").alias("_last"))
        fact = fct_card_velocity_skew_safe(rows.unionByName(back), keep=("event_date",)).where(F.col("event_date") >= since)
        carried = F.when(F.col("time_since_last_s").isNull(), (F.col("ts_us") - F.col("_last")) / F.lit(1_000_000.0)) \
            .otherwise(F.col("time_since_last_s"))
        fact = (fact.join(last, F.col("card_id").eqNullSafe(F.col("_card")), "left")
                .withColumn("time_since_last_s", carried).drop("_card", "_last"))
    else:
        rows, fact = new, fct_card_velocity_skew_safe(new, keep=("event_date",))
    fact = cut_lineage(fact)                 # all reading ends before anything is replaced
    days = rows.groupBy("event_date", "card_id").agg(F.max("ts_us").alias("last_us"))
    _replace_dates(days, f"{folder}/card_days")
    _replace_dates(fact, f"{folder}/mart")
    _replace_dates(rows, f"{folder}/staging")
    return read_mart(spark, folder)


def read_mart(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/mart")


def grow_codes(df: DataFrame, columns: Sequence[str], folder: str, ts: str = "ts_us", tie: str = "TransactionID") -> DataFrame:
    """Add the values that ``df`` brings to the dictionary in ``folder`` and return all of it:
    (column_name, value, code, load).  Nulls have no code; a value known from an earlier load
    keeps its code, so a repeated load adds nothing."""
    spark = df.sparkSession
    kind = "column_name string, value string, code long, load int"
    known = spark.read.schema(kind).parquet(folder) if _exists(spark, folder) else spark.createDataFrame([], kind)
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]))
    seen = (df.select(values.alias("v"), F.struct(ts, tie).alias("at")).where(F.col("v.value").isNotNull())
            .groupBy("v.column_name", "v.value").agg(F.min("at").alias("at")))
    fresh = seen.join(known, ["column_name", "value"], "left_anti")
    ends = known.groupBy("column_name").agg((F.max("code") + 1).alias("start"), F.max("load").alias("last"))
    place = F.row_number().over(Window.partitionBy("column_name").orderBy("at", "value")) - 1     # distinct values only
    load = (known.agg(F.max("load")).first()[0] or 0) + 1
    added = fresh.select("column_name", "value", place.alias("place")).join(ends, "column_name", "left").select(
        "column_name", "value", (F.col("place") + F.coalesce("start", F.lit(0))).cast("long").alias("code"), F.lit(load).alias("load"))
    cut_lineage(added).write.mode("append").parquet(folder)
    return spark.read.schema(kind).parquet(folder)
