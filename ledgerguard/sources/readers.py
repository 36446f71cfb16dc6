"""Readers, normaliser, views and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerguard.sources.adapters import WIDE_REF_DATE_US
from ledgerguard.sources.schemas import WIDE_ID_KNOWN, WIDE_TX_KNOWN


def _schema_for(spark: SparkSession, path: str, known: dict) -> T.StructType:
    """Header-driven schema: known columns get fixed types, the rest are read as
    double (numeric wide columns) or string (``M*``, ``id_*`` text, e-mail...).

    Only the header line is read (``limit(0)`` on a header-only scan)."""
    header = spark.read.option("header", True).option("inferSchema", False).csv(path).limit(0).columns
    fields = []
    for c in header:
        if c in known:
            fields.append(T.StructField(c, known[c], True))
        elif c[:1] in ("C", "D", "V") and c[1:].isdigit() or c.startswith("dist"):
            fields.append(T.StructField(c, T.DoubleType(), True))
        else:
            fields.append(T.StructField(c, T.StringType(), True))
    return T.StructType(fields)


def read_transaction_csv(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """Transaction CSV with a header.  Known columns are typed explicitly;
    ``infer=True`` falls back to Spark's inference (an extra pass)."""
    if infer:
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    return spark.read.option("header", True).schema(_schema_for(spark, path, WIDE_TX_KNOWN)).csv(path)


def read_identity_csv(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    if infer:
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    known = dict(WIDE_ID_KNOWN)
    return spark.read.option("header", True).schema(_schema_for(spark, path, known)).csv(path)


def cap_rows(tx: DataFrame, nrows: int | None, key: str = "TransactionID") -> DataFrame:
    """S1's optional cap: the first ``nrows`` by key (file order is not defined in Spark)."""
    return tx if nrows is None else tx.orderBy(key).limit(int(nrows))


def restrict_identity(idn: DataFrame, tx: DataFrame, key: str = "TransactionID") -> DataFrame:
    """Identity rows of the kept transactions (left semi join)."""
    return idn.join(tx.select(key), key, "left_semi")


def normalise_identity_names(idn: DataFrame) -> DataFrame:
    """``id-XX`` -> ``id_XX`` (the real files spell some identity columns with a dash)."""
    ren = {c: c.replace("-", "_") for c in idn.columns if c.startswith("id") and "-" in c}
    return idn.withColumnsRenamed(ren) if ren else idn


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in float and double columns is a missing value (files written by dataframe tools)."""
    floats = [f.name for f in df.schema.fields if f.dataType.simpleString() in ("float", "double")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def normalise_wide(tx: DataFrame, idn: DataFrame | None = None, key: str = "TransactionID") -> DataFrame:
    """Left join the optional identity table, derive ts / ts_us, amount,
    amount_minor (thousandths) and is_fraud (when the label exists).

    The identity side is 1:0..1 on the key; ``identity_key_duplicates`` checks it.
    No sort: time order lives in the window specs downstream.
    """
    tx = df = nan_to_null(tx)
    if idn is not None:
        idn = normalise_identity_names(nan_to_null(idn))
        df = tx.join(idn, key, "left")
    ts_us = F.lit(WIDE_REF_DATE_US) + F.col("TransactionDT").cast("long") * F.lit(1_000_000)
    derived = {
        "ts_us": ts_us,
        "ts": F.timestamp_add("MICROSECOND", ts_us, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")),
        "amount": F.col("TransactionAmt").cast("double"),
        "amount_minor": F.round(F.col("TransactionAmt") * 1000).cast("long"),
    }
    if "isFraud" in tx.columns:
        derived["is_fraud"] = F.col("isFraud").cast("int")
    return df.withColumns(derived)


def identity_key_duplicates(idn: DataFrame, key: str = "TransactionID") -> DataFrame:
    """Keys that appear more than once on the identity side (would fan out the join)."""
    return idn.groupBy(key).count().where("count > 1")


def write_csv_pair(tx: DataFrame, idn: DataFrame, out_dir: str, mode: str = "overwrite") -> None:
    """Two CSV folders shaped like the competition files."""
    tx.write.mode(mode).option("header", True).csv(f"{out_dir}/train_transaction")
    idn.write.mode(mode).option("header", True).csv(f"{out_dir}/train_identity")


def write_featured_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ("event_date",),
                           mode: str = "overwrite") -> None:
    """Parquet sink of the featured table, partitioned by date for pruning."""
    out = df
    if "event_date" in partition_by and "event_date" not in df.columns:
        out = df.withColumn("event_date", F.to_date("ts"))
    out.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_bucketed(df: DataFrame, name: str, path: str, key: str, order: tuple[str, ...], buckets: int) -> DataFrame:
    """A table stored in ``buckets`` by the hash of ``key`` and sorted by (key, ``order``) inside
    each, read back: windows and aggregates by the key then need no Exchange.  One file a bucket;
    choose about as many buckets as the largest window's shuffle would have partitions."""
    (df.repartition(buckets, key).write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key, *order)
     .format("parquet").saveAsTable(name))
    return df.sparkSession.table(name)


def register_raw_source(df: DataFrame, name: str = "raw_transactions") -> str:
    """The named warehouse source."""
    df.createOrReplaceTempView(name)
    return name


def analyst_joined(tx: DataFrame, idn: DataFrame | None) -> DataFrame:
    """S8's ``joined``: tx LEFT JOIN idn exposing only DeviceInfo and DeviceType;
    without identity, typed NULL columns."""
    if idn is not None:
        idn = normalise_identity_names(idn)
        return tx.join(idn.select("TransactionID", "DeviceInfo", "DeviceType"), "TransactionID", "left")
    return tx.select("*", F.lit(None).cast("string").alias("DeviceInfo"),
                     F.lit(None).cast("string").alias("DeviceType"))


def register_analyst_views(spark: SparkSession, tx: DataFrame, idn: DataFrame | None) -> None:
    """Temp views tx, idn, joined for analyst SQL (``spark.sql``)."""
    tx.createOrReplaceTempView("tx")
    if idn is not None:
        normalise_identity_names(idn).createOrReplaceTempView("idn")
    analyst_joined(tx, idn).createOrReplaceTempView("joined")


def materialise(df: DataFrame, name: str, kind: str = "view", path: str | None = None,
                mode: str = "overwrite") -> DataFrame:
    """staging = view, marts = table (parquet folder or catalogue table)."""
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df
    if path:
        df.write.mode(mode).parquet(path)
        out = df.sparkSession.read.parquet(path)
        out.createOrReplaceTempView(name)
        return out
    df.write.mode(mode).saveAsTable(name)
    return df.sparkSession.table(name)
