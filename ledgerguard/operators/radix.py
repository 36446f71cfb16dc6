"""Sums over the first k rows of an order, for many k, without sorting.

A distributed radix select: each pass counts (and sums) the rows by the next leading bits of
their key, with partial aggregation in every task; only the bucket that holds a wanted position
is looked at again, by its next bits.  A few passes narrow every position down to a handful of
rows, which are then read and counted one by one.  Rows are never sorted or moved, and what
reaches the driver (``HISTOGRAM`` buckets a pass, ``REST`` rows at the end) does not depend on
the table, so the same steps serve every k, order and size.

Keys are 64-bit whole numbers in ascending order (``descending`` turns a double into one); the
last key must be unique, so that the order is total.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

HISTOGRAM = 1 << 16      # buckets of a pass, over all open positions
REST = 1_000             # rows read one by one at the end
_LOW = (1 << 64) - 1
_SIGN = -(1 << 63)


def descending(score: Column) -> Column:
    """A long whose ascending order is the descending order of doubles (nulls last)."""
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), score.cast("double") + F.lit(0.0)).cast("long")
    upward = F.when(bits >= 0, bits).otherwise(bits.bitwiseXOR(F.lit((1 << 63) - 1)))
    return F.when(score.isNull(), F.lit((1 << 63) - 1)).otherwise(F.bitwise_not(upward))


def _unsigned(key: str) -> Column:
    """Same order, as an unsigned number in the bits of a long."""
    return F.col(key).bitwiseXOR(F.lit(_SIGN))


@dataclass
class Cut:
    """The first rows of an order: those whose keys (in full, and the leading bits of the last
    named one) are lexicographically at most ``values``."""

    keys: list[str]
    values: list[int]
    shift: int

    def holds(self) -> Column:
        """Condition on the rows' keys."""
        out = F.lit(True)
        for i in reversed(range(len(self.values))):
            bits = F.shiftrightunsigned(_unsigned(self.keys[i]), self.shift if i == len(self.values) - 1 else 0)
            # unsigned comparison: as signed numbers with the top bit turned
            here, limit = bits.bitwiseXOR(F.lit(_SIGN)), F.lit(_signed(self.values[i] ^ (1 << 63)))
            out = (here < limit) | ((here == limit) & out)
        return out


def _signed(u: int) -> int:
    return u - (1 << 64) if u >> 63 else u


@dataclass
class _Open:
    """A bucket that holds wanted positions: its group, full earlier keys and leading bits."""

    group: object
    path: tuple[int, ...]
    wanted: list[tuple[int, int, tuple[int, ...]]]       # (k, rows still needed, sums so far)


def first_sums(rows: DataFrame, keys: Sequence[str], ks: Sequence[int], measures: Sequence[str] = (), group: str | None = None,
               rest: int | None = None) -> tuple[dict, dict]:
    """({group: {k: (rows, *sums of measures)}}, {group: {k: Cut}}) of the first k rows in order of
    ``keys``, for every k; k beyond the table gives all of it.  ``rows`` should be narrow and cheap
    to read again; null measures count as 0.  Group None where there is no ``group``."""
    rest = REST if rest is None else rest
    keys, ks = list(keys), sorted({int(k) for k in ks if k > 0})
    g = F.col(group) if group else F.lit(0)
    base = rows.select(g.alias("_g"), *[F.col(k).cast("long").alias(k) for k in keys],
                       *[F.coalesce(F.col(m).cast("long"), F.lit(0)).alias(m) for m in measures])
    sums = [F.count("*").alias("_rows"), *[F.sum(m).alias(f"_s{i}") for i, m in enumerate(measures)]]
    ends = [f(k).alias(f"_{n}{i}") for i, k in enumerate(keys) for n, f in (("lo", F.min), ("hi", F.max))]
    whole = base.groupBy("_g").agg(*sums, *ends).collect()
    total = lambda r: (r["_rows"], *(r[f"_s{i}"] for i in range(len(measures))))
    found: dict = {r["_g"]: {k: total(r) for k in ks if k >= r["_rows"]} for r in whole}
    cuts: dict = {r["_g"]: {k: Cut(keys, [_LOW], 0) for k in ks if k >= r["_rows"]} for r in whole}
    widths = []
    for i in range(len(keys)):
        lo = min(((r[f"_lo{i}"] ^ _SIGN) & _LOW for r in whole), default=0)
        hi = max(((r[f"_hi{i}"] ^ _SIGN) & _LOW for r in whole), default=0)
        widths.append((lo ^ hi).bit_length())
    zero = (0,) * len(measures)
    open_ = [_Open(r["_g"], (), [(k, k, zero) for k in ks if k < r["_rows"]]) for r in whole]
    open_ = [o for o in open_ if o.wanted]
    held, at, shift = sum(r["_rows"] for r in whole), 0, None
    spark = rows.sparkSession
    while open_:
        bits = lambda i, s: F.shiftrightunsigned(_unsigned(keys[i]), s)
        part = base
        if open_[0].path:
            n = len(open_[0].path)
            kind = base.schema["_g"].dataType.simpleString()
            side = spark.createDataFrame([(o.group, k, *map(_signed, o.path)) for k, o in enumerate(open_)],
                                         f"_og {kind}, _open int, " + ", ".join(f"_p{i} long" for i in range(n)))
            same = [F.col("_g") == F.col("_og")] + [bits(i, shift if i == n - 1 else 0) == F.col(f"_p{i}") for i in range(n)]
            part = base.join(F.broadcast(side), same)        # as many rows as there are open positions
            if n > at and shift == 0:                        # this key is used up
                at, shift = at + 1, None
        else:
            part = base.withColumn("_open", F.lit(-1))
        if held <= rest or at == len(keys):
            if at == len(keys):
                raise ValueError("rows with equal keys: the last key must be unique")
            picked: dict = {}
            for r in part.collect():
                picked.setdefault((r["_g"], r["_open"]), []).append(r)
            for k, o in enumerate(open_):
                mine = picked[(o.group, k if o.path else -1)]
                mine.sort(key=lambda r: tuple(r[x] for x in keys))
                for want, need, got in o.wanted:
                    taken = mine[:need]
                    found[o.group][want] = (want, *(s + sum(r[m] for r in taken) for s, m in zip(got, measures, strict=True)))
                    cuts[o.group][want] = Cut(keys, [(taken[-1][x] ^ _SIGN) & _LOW for x in keys], 0)
            break
        step = max(4, (HISTOGRAM // len(open_)).bit_length() - 1)
        shift = max((widths[at] if shift is None else shift) - step, 0)
        counted: dict = {}
        for r in part.groupBy("_g", "_open", bits(at, shift).alias("_bits")).agg(*sums).collect():
            counted.setdefault((r["_g"], r["_open"]), []).append((r["_bits"] & _LOW, total(r)))
        now, held = [], 0
        for k, o in enumerate(open_):
            buckets = sorted(counted[(o.group, k if o.path else -1)])
            done = o.path if len(o.path) <= at else o.path[:at]
            left, i, before = list(o.wanted), 0, (0,) * (len(measures) + 1)
            for value, inside in buckets:
                here, upto = [], tuple(a + b for a, b in zip(before, inside, strict=True))
                while left and left[0][1] <= upto[0]:
                    want, need, got = left.pop(0)
                    if need == upto[0]:
                        found[o.group][want] = (want, *(s + x for s, x in zip(got, upto[1:], strict=True)))
                        cuts[o.group][want] = Cut(keys, [*done, value], shift)
                    else:
                        here.append((want, need - before[0], tuple(s + x for s, x in zip(got, before[1:], strict=True))))
                if here:
                    now.append(_Open(o.group, (*done, value), here))
                    held += inside[0]
                before = upto
        open_ = now
    if not group:
        return found.get(0, {}), cuts.get(0, {})
    return found, cuts
