"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerguard.session import cut_lineage, ensure_checkpoint_dir

__all__ = ["attach_totals", "binary_column", "bounded_batches", "cut_lineage", "drop_stored", "finite_vectors", "give_back",
           "pieces_by_bytes", "scratch_path", "shuffle_partitions", "store", "store_at", "table", "whole_components", "without"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir`` (shared by all executors)."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def store_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written as Parquet to the shared folder and read again, and where it is."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def store(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: cuts the lineage of
    tables that hold texts (compressed, unlike a checkpoint)."""
    return store_at(df, name)[0]


def drop_stored(spark: SparkSession, path: str) -> None:
    """Delete a stored table that nothing reads any more (by Spark's own file system)."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def finite_vectors(vectors: DataFrame, key: str, vector: str, *more: str) -> DataFrame:
    """(id, v, *more) rows whose vector is there and holds no null and no non-finite component."""
    rows = vectors.where(F.col(vector).isNotNull()).select(F.col(key).cast("long").alias("id"),
                                                           F.col(vector).cast("array<double>").alias("v"), *more)
    return rows.where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))


def whole_components(rows: DataFrame, steps: int, bits: int = 26) -> DataFrame:
    """``rows`` with x, the components of v in whole steps (floor(steps * v)) as longs; a component
    of more than ``bits`` bits raises an error, as exact 64-bit distances would not hold it."""
    whole = F.transform("v", lambda x: F.floor(x * steps).cast("long"))
    fits = ~F.exists("v", lambda x: F.abs(x * steps) >= float(1 << bits))
    return rows.withColumn("x", F.when(fits, whole).otherwise(F.raise_error(F.lit(
        f"a vector component times {steps} needs more than {bits} bits")).cast("array<long>")))


def attach_totals(rows: DataFrame, key: str, totals: DataFrame, spread_by: str, small: int = 200_000, salts: int = 64
                  ) -> DataFrame:
    """``rows`` with the other columns of ``totals`` (one row per value of ``key``, null included):
    by broadcast while ``totals`` has at most ``small`` rows; beyond, each of its rows is copied
    to every salt and the rows of a hot key are dealt over the salts by ``spread_by``."""
    more = [c for c in totals.columns if c != key]
    if totals.count() <= small:
        on = F.col(f"a.{key}").eqNullSafe(F.col(f"t.{key}"))
        return rows.alias("a").join(F.broadcast(totals).alias("t"), on).select("a.*", *more)
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    copies = totals.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    on = F.col(f"a.{key}").eqNullSafe(F.col(f"t.{key}")) & (F.col("a.__salt") == F.col("t.__salt"))
    return salted.alias("a").join(copies.alias("t"), on).select(*[f"a.{c}" for c in rows.columns], *more)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns an operator is about to add under the same names."""
    drop = {n.lower() for n in names}
    return df.select(*[c for c in (df[f"`{n}`"] for n in df.columns if n.lower() not in drop)])


def binary_column(batch: pa.RecordBatch, i: int) -> pa.BinaryArray:
    """Column ``i`` as UTF-8 bytes; nulls become empty."""
    col = batch.column(i)
    if col.type not in (pa.binary(), pa.large_binary()):
        col = col.cast(pa.large_binary() if col.type == pa.large_string() else pa.binary())
    return col.fill_null(b"")


def bounded_batches(spark: SparkSession, rows: int = 2_000) -> None:
    """At most ``rows`` texts in one Arrow batch of this session: the default of 10,000 takes
    tens of megabytes several times over in the JVM and in each Python worker."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, rows)


def give_back() -> None:
    """Return freed memory to the system between pieces of work: the workers of an executor
    share its memory, and one that is between tasks should not hold on to it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):    # another C library
        pass


def pieces_by_bytes(batches: Iterator[pa.RecordBatch], text_at: int, limit: int = 8 << 20
                    ) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that one piece holds about ``limit`` bytes of text (or one
    longer text): what a task keeps in memory does not follow the batch size."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = binary_column(batch, text_at)
        lengths = np.frombuffer(ends.buffers()[1], dtype=np.int64 if ends.type == pa.large_binary() else np.int32
                                )[ends.offset:ends.offset + len(ends) + 1]
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(lengths, lengths[start] + limit, side="right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            give_back()
            start = stop
