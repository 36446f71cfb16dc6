"""Data-quality checks V1-V5: one aggregate pass per check, results as rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerguard.functions.timecols import US_PER_HOUR


def not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """V1: NULL count per column, all columns in one pass; one row per column."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', n{i}" for i, c in enumerate(cols))
    return agg.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, null_rows)").select(
        "column_name", F.col("null_rows").cast("long"), (F.col("null_rows") == 0).alias("passed"))


def unique(df: DataFrame, col: str) -> DataFrame:
    """V2: keys that appear more than once (an empty result passes)."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def unique_summary(df: DataFrame, col: str) -> DataFrame:
    d = unique(df, col)
    return d.agg(F.count(F.lit(1)).cast("long").alias("duplicate_keys"),
                 F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("duplicate_rows")).select(
        F.lit(col).alias("column_name"), "duplicate_keys", "duplicate_rows",
        (F.col("duplicate_keys") == 0).alias("passed"))


def accepted_values(df: DataFrame, checks: dict[str, Sequence]) -> DataFrame:
    """V3: rows whose value is outside the accepted set (NULLs are not counted,
    as in the usual accepted-values test), one row per column."""
    aggs = [F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(list(v))).alias(f"n{i}")
            for i, (c, v) in enumerate(checks.items())]
    agg = df.agg(*aggs)
    stack = ", ".join(f"'{c}', n{i}" for i, c in enumerate(checks))
    return agg.selectExpr(f"stack({len(checks)}, {stack}) AS (column_name, bad_rows)").select(
        "column_name", F.col("bad_rows").cast("long"), (F.col("bad_rows") == 0).alias("passed"))


def freshness(df: DataFrame, now_us: int, ts: str = "ts_us", warn_hours: int = 24,
              error_hours: int = 72) -> DataFrame:
    """V4: age of the newest row against a supplied 'now' (never the wall clock)."""
    a = df.agg(F.max(ts).alias("newest_us"))
    age_h = (F.lit(int(now_us)) - F.col("newest_us")) / F.lit(float(US_PER_HOUR))
    return a.select("newest_us", age_h.alias("age_hours"),
                    F.when(F.col("newest_us").isNull(), F.lit("error"))
                    .when(age_h > error_hours, F.lit("error"))
                    .when(age_h > warn_hours, F.lit("warn")).otherwise(F.lit("pass")).alias("status"))


def leakage_check(df: DataFrame, build: Callable[[DataFrame], DataFrame], cut_us: int,
                  key: str = "transaction_id", cols: Sequence[str] = (), ts: str = "ts_us") -> DataFrame:
    """V5: features of rows at or before ``cut_us`` must not change when every
    later row is removed.  Returns the differing rows (empty = no leakage)."""
    from ledgerguard.session import cut_lineage
    # each side is read twice by the symmetric difference: materialise it once
    full = cut_lineage(build(df).where(F.col(ts) <= F.lit(int(cut_us))).select(key, *cols))
    cut = cut_lineage(build(df.where(F.col(ts) <= F.lit(int(cut_us)))).select(key, *cols))
    return full.exceptAll(cut).unionByName(cut.exceptAll(full))
