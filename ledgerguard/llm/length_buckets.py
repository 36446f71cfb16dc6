"""Packing by optimal length buckets.

1. One aggregate gives the global histogram of (rounded) lengths; at most one row per
   distinct length reaches the driver, and lengths are at most the longest text's.
2. Dynamic programming over the histogram chooses up to ``max_buckets`` upper bounds so that
   padding every sequence to its bucket's bound wastes the fewest tokens (divide and conquer
   on the monotone split points: O(buckets x lengths x log lengths)).
3. Inside a bucket, batches hold as many sequences as the token budget allows at the padded
   length.  Sequences are numbered by the hash of their key: hash ranges of about
   ``range_rows`` rows each are counted, their starts summed, and rows numbered inside their
   range only, so that a bucket with most of the rows is spread over many tasks.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from ledgerguard.llm.common import store, without


def optimal_bounds(lengths: np.ndarray, counts: np.ndarray, max_buckets: int) -> list[int]:
    """Upper bounds (ascending, the last is the longest length) with the least padding."""
    order = np.argsort(lengths)
    x, c = lengths[order].astype(np.int64), counts[order].astype(np.float64)
    n = len(x)
    if n == 0:
        return []
    total = np.r_[0.0, np.cumsum(c)]
    used = np.r_[0.0, np.cumsum(c * x)]
    best = np.r_[0.0, np.full(n, np.inf)]      # best[j]: padding of the first j lengths
    back = []
    for _ in range(min(max_buckets, n)):
        now, split = np.full(n + 1, np.inf), np.zeros(n + 1, dtype=np.int64)
        todo = [(1, n, 0, n - 1)]
        while todo:
            lo, hi, a, b = todo.pop()
            if lo > hi:
                continue
            j = (lo + hi) // 2
            i = np.arange(a, min(b, j - 1) + 1)
            cost = best[i] + x[j - 1] * (total[j] - total[i]) - (used[j] - used[i])
            k = int(cost.argmin())
            now[j], split[j] = cost[k], i[k]
            todo.append((lo, j - 1, a, int(i[k])))
            todo.append((j + 1, hi, int(i[k]), b))
        back.append(split)
        if now[n] >= best[n]:
            back.pop()
            break
        best = now
    bounds, j = [], n
    for split in reversed(back):
        if j == 0:
            break
        bounds.append(int(x[j - 1]))
        j = int(split[j])
    return bounds[::-1]


def pack(docs: DataFrame, length: str = "n_tokens", key: str = "doc_id", max_buckets: int = 16,
         token_budget: int = 65_536, round_to: int = 8, range_rows: int = 50_000) -> DataFrame:
    """``docs`` with bucket (int, from 0), padded_length, batch (long, from 0 inside the
    bucket), slot (int, place in the batch).

    Null lengths count as 0; a sequence longer than the budget has a batch of its own, however
    long it is; rows with equal keys are ordered by all their columns' hash; an empty table gives
    no rows.  Input columns named like an output column are replaced.  ``docs`` should be
    stored: it is read four times.
    """
    docs = without(docs, "bucket", "padded_length", "batch", "slot", "__len", "__every", "__copies", "__u", "__range")
    spark = docs.sparkSession
    columns = docs.columns
    every = F.xxhash64(*[F.col(f"`{c}`") for c in columns])
    sized = docs.withColumn("__len", (F.ceil(F.coalesce(F.col(length), F.lit(0)) / round_to) * round_to).cast("long"))
    histogram = sized.groupBy("__len").count().collect()
    bounds = optimal_bounds(np.array([r["__len"] for r in histogram], dtype=np.int64),
                            np.array([r["count"] for r in histogram], dtype=np.int64), max_buckets)
    rows = np.array([r["count"] for r in histogram], dtype=np.int64)
    at = np.searchsorted(np.array(bounds, dtype=np.int64), [r["__len"] for r in histogram])
    ranges = [max(1, -(-int(rows[at == b].sum()) // range_rows)) for b in range(len(bounds))]
    plan = spark.createDataFrame([(b, v, r, max(1, token_budget // max(v, 1))) for b, (v, r) in
                                  enumerate(zip(bounds, ranges, strict=True))],
                                 "bucket int, padded_length long, ranges int, capacity long")
    bound = F.array(*[F.lit(b) for b in bounds]) if bounds else F.array().cast("array<bigint>")
    # at most rows / range_rows contents fill a range by themselves
    sized = sized.withColumn("__every", every)
    copies = sized.groupBy("__every").count().where(F.col("count") > range_rows).select("__every", F.lit(True).alias("__copies"))
    sized = sized.withColumn("__row", F.monotonically_increasing_id()).join(copies, "__every", "left")
    unit = F.pmod(F.xxhash64(F.col(key), "__every", F.when(F.col("__copies"), F.col("__row")), F.lit("pack")), F.lit(1 << 40))
    placed = (sized.withColumn("bucket", F.size(F.filter(bound, lambda b: b < F.col("__len"))))
              .withColumn("__u", unit).join(F.broadcast(plan), "bucket")   # max_buckets rows
              .withColumn("__range", F.floor(F.col("__u") * F.col("ranges") / F.lit(1 << 40)).cast("int")))
    counted = placed.groupBy("bucket", "__range").agg(F.count("*").alias("n"))
    before = counted.withColumn("before", F.sum("n").over(
        Window.partitionBy("bucket").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)))
    starts = before.select("bucket", "__range", F.coalesce("before", F.lit(0)).alias("before"))
    inside = Window.partitionBy("bucket", "__range").orderBy("__u", key, "__every")
    numbered = placed.withColumn("__n", F.row_number().over(inside)).join(starts, ["bucket", "__range"])
    place = F.col("before") + F.col("__n") - 1
    return numbered.select(*[F.col(f"`{c}`") for c in columns], "bucket", "padded_length",
                           F.floor(place / F.col("capacity")).cast("long").alias("batch"),
                           F.pmod(place, F.col("capacity")).cast("int").alias("slot"))


def pack_texts(docs: DataFrame, vocabulary: str, keep: list[str], key: str = "doc_id", text: str = "text",
               **options) -> DataFrame:
    """Count the ids of every whole text and pack the documents (``keep`` columns)."""
    from ledgerguard.llm.token_rollup import with_token_count

    counted = store(with_token_count(without(docs, "n_tokens"), vocabulary, keep, text), "lengths")
    return pack(counted, "n_tokens", key, **options)
