"""Generic as-of ("strictly before this row") window operators.

Every builder returns a Column to be placed in ONE ``select`` together with
the other as-of columns of the same key.  Row frames are ordered by
(ts_us, tie) and range frames by ts_us only; a sort on (key, ts_us, tie)
satisfies both, so the whole feature block plans as one Exchange on the key
and one Sort.

Tie rule: when several rows of a key share a timestamp only rows EARLIER IN
(ts_us, tie) ORDER count as prior.  Range frames cannot exclude the current
row in Spark, so the trailing-window count is written as

    (rows earlier in order) - (rows with ts_us <= now - width - 1)

which is exact on ties and includes the lower edge (ts_us = now - width).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNB = Window.unboundedPreceding


#: so many hot keys go to every task as they are, so that no row moves to be split off
HOT_BROADCAST_MAX = 100_000


def split_hot(df: DataFrame, key: Column, hot: list) -> tuple[DataFrame, DataFrame]:
    """(rows of the keys in ``hot``, all other rows), by null-safe semi and anti joins: every
    row is in exactly one part.  A NULL in ``hot`` names the rows without a key; other rows
    without a key belong to the second part.  Any number of keys is allowed; up to
    ``HOT_BROADCAST_MAX`` are broadcast (a shuffle would move all rows, and put those of one
    hot key, or without a key, in one task)."""
    kind = df.select(key.alias("_hot")).schema["_hot"].dataType
    found = [(k,) for k in dict.fromkeys(hot)]
    keys = df.sparkSession.createDataFrame(found, T.StructType([T.StructField("_hot", kind)]))
    if len(found) <= HOT_BROADCAST_MAX:
        keys = F.broadcast(keys)
    same = key.eqNullSafe(F.col("_hot"))
    return df.join(keys, same, "left_semi"), df.join(keys, same, "left_anti")


def _keys(key) -> list:
    return [key] if isinstance(key, (str, Column)) else list(key)


def ordered(key, ts: str = "ts_us", tie: str = "transaction_id"):
    return Window.partitionBy(*_keys(key)).orderBy(F.col(ts), F.col(tie))


def by_time(key, ts: str = "ts_us"):
    return Window.partitionBy(*_keys(key)).orderBy(F.col(ts))


def prior_count(key, ts="ts_us", tie="transaction_id") -> Column:
    """Rows of the key strictly before this one (0 for the first)."""
    return (F.row_number().over(ordered(key, ts, tie)) - 1).cast("long")


def _older_than(key, ts, width_us) -> Window:
    return by_time(key, ts).rangeBetween(UNB, -(int(width_us) + 1))


def prior_count_within(key, width_us: int, ts="ts_us", tie="transaction_id") -> Column:
    """Earlier rows with ts_us >= now - width_us (lower edge inclusive)."""
    older = F.count(F.lit(1)).over(_older_than(key, ts, width_us))
    return (prior_count(key, ts, tie) - older).cast("long")


def prior_sum(value: str | Column, key, ts="ts_us", tie="transaction_id") -> Column:
    v = F.col(value) if isinstance(value, str) else value
    return F.sum(v).over(ordered(key, ts, tie).rowsBetween(UNB, -1))


def prior_sum_within(value: str | Column, key, width_us: int, ts="ts_us",
                     tie="transaction_id") -> Column:
    """Sum of ``value`` over the rows counted by ``prior_count_within`` (0 if none).

    Written as the difference of two prefix sums; on integer minor units the
    subtraction is exact.
    """
    v = F.col(value) if isinstance(value, str) else value
    upto = F.sum(v).over(ordered(key, ts, tie).rowsBetween(UNB, -1))
    older = F.sum(v).over(_older_than(key, ts, width_us))
    return F.coalesce(upto, F.lit(0)) - F.coalesce(older, F.lit(0))


def prior_zscore(value_minor: str, key, ts="ts_us", tie="transaction_id") -> Column:
    """(x - prior mean) / prior population std, computed exactly on integers.

    With n prior rows, S = sum c and Q = sum c^2 (c = integer minor units):
        z = (n*c - S) / sqrt(n*Q - S^2)
    0 when fewer than two prior rows or when the prior variance is zero.
    Q is accumulated as DECIMAL(38,0) so it cannot overflow.
    """
    c = F.col(value_minor)
    w = ordered(key, ts, tie).rowsBetween(UNB, -1)
    n = F.count(c).over(w).cast("decimal(38,0)")
    s = F.sum(c).over(w).cast("decimal(38,0)")
    q = F.sum(c.cast("decimal(38,0)") * c.cast("decimal(38,0)")).over(w).cast("decimal(38,0)")
    cd = c.cast("decimal(38,0)")
    num = (n * cd - s).cast("decimal(38,0)")
    den = (n * q - s * s).cast("decimal(38,0)")
    z = num.cast("double") / F.sqrt(den.cast("double"))
    return F.when((n >= 2) & (den > 0), z).otherwise(F.lit(0.0))


def prior_mean(value: str | Column, key, ts="ts_us", tie="transaction_id") -> Column:
    """Mean of earlier values (NULL when there are none)."""
    v = F.col(value) if isinstance(value, str) else value
    return F.avg(v).over(ordered(key, ts, tie).rowsBetween(UNB, -1))


def previous(col: str | Column, key, ts="ts_us", tie="transaction_id") -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.lag(c).over(ordered(key, ts, tie))


def gap_seconds(key, first_value: float | None, ts="ts_us", tie="transaction_id") -> Column:
    """Seconds since the previous row of the key; ``first_value`` for the first."""
    g = (F.col(ts) - previous(ts, key, ts, tie)) / F.lit(1_000_000.0)
    return g if first_value is None else F.coalesce(g, F.lit(float(first_value)))


def first_seen(key, value: str, ts="ts_us", tie="transaction_id") -> Column:
    """1 on the key's first row with this value (hash distribution on ``key``
    also satisfies the (key, value) window, so this adds a Sort, not an Exchange)."""
    w = Window.partitionBy(*_keys(key), F.col(value)).orderBy(F.col(ts), F.col(tie))
    return (F.row_number().over(w) == 1).cast("int")


def prior_distinct(key, value: str, ts="ts_us", tie="transaction_id",
                   first_col: str = "_first") -> tuple[Column, Column]:
    """Distinct ``value`` seen within ``key`` strictly before this row.

    Spark has no COUNT(DISTINCT) over a window, so this is two steps: flag the
    first appearance of (key, value), then a running sum of the flags minus the
    current flag.  Returns (flag column, distinct-count column using ``first_col``).
    """
    flag = first_seen(key, value, ts, tie)
    run = F.sum(F.col(first_col)).over(ordered(key, ts, tie).rowsBetween(UNB, 0))
    return flag, (run - F.col(first_col)).cast("long")


def join_null_safe(left, right, keys: list, how: str = "left"):
    """Equi-join on ``keys`` where NULL matches NULL (as window partitions and
    grouping treat NULL as one group); the right copies of the keys are dropped."""
    ren = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                       *[F.col(c) for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        e = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        cond = e if cond is None else cond & e
    return left.join(ren, cond, how).drop(*[f"_r_{k}" for k in keys])


def total_count(key) -> Column:
    """Rows of the key over the whole frame (NULL keys are one group in a window)."""
    return F.count(F.lit(1)).over(Window.partitionBy(*_keys(key)))
