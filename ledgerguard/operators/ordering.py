"""Global order without a single partition.

``global_cumulative`` gives every row its 1-based position in a total order and
running sums of chosen measures, without a window that lacks ``partitionBy``:

1. ``orderBy`` range-partitions on the full sort key (Spark samples the key, so
   a hot leading value is split by the trailing keys) and sorts each partition;
2. the sorted rows are checkpointed to the shared checkpoint folder, which fixes
   which partition each row is in (recomputation after an executor loss reads
   the checkpoint instead of re-sampling);
3. per-partition totals are aggregated -- one row per partition, a bounded
   collect -- and turned into exclusive offsets on the driver;
4. ``mapInPandas`` walks each partition in order and adds the offsets, so the
   running sums need no second shuffle.

``exact_quantiles`` uses it to compute linear-interpolated quantiles (the
numpy / ``quantile_cont`` / ``percentile`` definition) without the single-task
value map of Spark's exact ``percentile`` aggregate.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerguard.session import cut_lineage

POS = "_pos"


def global_cumulative(df: DataFrame, order: Sequence[Column], measures: dict[str, Column] | None = None,
                      keep: Sequence[str] = (), group: str | None = None, totals_out: dict | None = None) -> DataFrame:
    """Rows of ``df`` (columns ``keep``) with ``_pos`` (1-based global position)
    and ``cum_<name>`` (inclusive running sum) for every measure.

    With ``group`` set, ``order`` must start with the group column, and positions
    and sums restart at every group (``_pos`` counts within the group).
    Measures must be integral or floating numbers; sums are float64 for doubles
    and int64 for integers.
    """
    measures = dict(measures or {})
    keep = list(keep)
    if group and group not in keep:
        keep = [group] + keep
    mcols = [m.alias(f"_m_{n}") for n, m in measures.items()]
    base = df.select(*[F.col(c) for c in keep], *mcols)
    whole = [f.name for f in base.schema.fields if f.name.startswith("_m_") and isinstance(
        f.dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.BooleanType))]
    base = base.withColumns({c: F.coalesce(F.col(c).cast("long"), F.lit(0)) for c in whole}) if whole else base
    srt = base.orderBy(*order).withColumn("_pid", F.spark_partition_id())
    srt = cut_lineage(srt)

    names = list(measures)
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.sum(f"_m_{n}").alias(f"_s_{n}") for n in names]
    if group:
        # totals per (partition, group): bounded by partitions x groups spanning them
        tot = srt.groupBy("_pid", group).agg(*aggs).collect()
        tot = sorted(tot, key=lambda r: r["_pid"])
    else:
        tot = sorted(srt.groupBy("_pid").agg(*aggs).collect(), key=lambda r: r["_pid"])

    if totals_out is not None:
        # per group (or overall): [rows, sum of each measure], from the
        # per-partition totals already collected
        for r in tot:
            g = r[group] if group else None
            prev = totals_out.get(g, [0] * (len(names) + 1))
            totals_out[g] = [prev[0] + r["_n"]] + [prev[i + 1] + (r[f"_s_{n}"] or 0) for i, n in enumerate(names)]
    offsets: dict = {}
    if group:
        run: dict = {}
        # groups appear in partition order; a group may span several partitions
        for r in _order_group_rows(tot, group):
            g = r[group]
            prev = run.get(g, [0] + [0] * len(names))
            offsets[(r["_pid"], g)] = list(prev)
            run[g] = [prev[0] + r["_n"]] + [prev[i + 1] + (r[f"_s_{n}"] or 0) for i, n in enumerate(names)]
    else:
        acc = [0] + [0] * len(names)
        for r in tot:
            offsets[r["_pid"]] = list(acc)
            acc = [acc[0] + r["_n"]] + [acc[i + 1] + (r[f"_s_{n}"] or 0) for i, n in enumerate(names)]

    in_schema = srt.schema
    out_fields = [f for f in in_schema.fields if not f.name.startswith("_m_") and f.name != "_pid"]
    out_fields.append(T.StructField(POS, T.LongType(), False))
    for n in names:
        dt = in_schema[f"_m_{n}"].dataType
        is_int = isinstance(dt, (T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.BooleanType))
        out_fields.append(T.StructField(f"cum_{n}", T.LongType() if is_int else T.DoubleType(), True))
    out_schema = T.StructType(out_fields)
    keep_names = [f.name for f in out_fields if f.name != POS and not f.name.startswith("cum_")]

    kinds = {n: np.int64 if isinstance(out_schema[f"cum_{n}"].dataType, T.LongType) else np.float64 for n in names}

    def running(values, n: str) -> np.ndarray:
        """Running sums; integer measures (never null here) stay integers, so they are exact."""
        return np.cumsum(np.nan_to_num(values.to_numpy(dtype=kinds[n])))

    def walk(it):
        state: dict = {}
        for pdf in it:
            if pdf.empty:
                continue
            out = pdf[keep_names].copy()
            pid = int(pdf["_pid"].iloc[0])
            if group:
                pos = np.empty(len(pdf), dtype=np.int64)
                sums = {n: np.empty(len(pdf), dtype=kinds[n]) for n in names}
                gvals = pdf[group].to_numpy()
                # contiguous runs of one group inside the batch
                starts = np.flatnonzero(np.r_[True, gvals[1:] != gvals[:-1]])
                ends = np.r_[starts[1:], len(pdf)]
                for s, e in zip(starts, ends):
                    g = gvals[s]
                    key = (pid, g.item() if hasattr(g, "item") else g)
                    base_ = state.get(key) or offsets[key]
                    cnt = base_[0] + np.arange(1, e - s + 1)
                    pos[s:e] = cnt
                    new = [int(cnt[-1])]
                    for i, n in enumerate(names):
                        cs = base_[i + 1] + running(pdf[f"_m_{n}"].iloc[s:e], n)
                        sums[n][s:e] = cs
                        new.append(cs[-1])
                    state[key] = new
                out[POS] = pos
                for n in names:
                    out[f"cum_{n}"] = sums[n]
            else:
                base_ = state.get(pid) or offsets[pid]
                cnt = base_[0] + np.arange(1, len(pdf) + 1, dtype=np.int64)
                out[POS] = cnt
                new = [int(cnt[-1])]
                for i, n in enumerate(names):
                    cs = base_[i + 1] + running(pdf[f"_m_{n}"], n)
                    out[f"cum_{n}"] = cs
                    new.append(cs[-1])
                state[pid] = new
            yield out

    return srt.mapInPandas(walk, out_schema)


def running_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], measures: dict[str, Column],
                   keep: Sequence[str] = ()) -> DataFrame:
    """``df`` rows (columns ``keep``, and _k1, _k2: a 128-bit hash of ``keys``, null-safe) with
    ``cum_<name>``, the inclusive running sum of every whole-number measure within the key.

    For any number of keys of any size: rows are range-partitioned by (key hash, ``order``) and
    checkpointed, so a key of all rows spreads over all tasks.  Only the last key of a partition
    can go on in the next, so one row per partition reaches the driver, whatever the number of keys.
    """
    names, keep = list(measures), list(keep)
    if not names:
        raise ValueError("no measure")
    parts = [F.col(k) for k in keys]
    rows = df.select(*keep, F.xxhash64(*parts, *[k.isNull() for k in parts]).alias("_k1"),
                     F.xxhash64(F.lit(len(parts)), *[k.isNull() for k in parts], *parts).alias("_k2"),
                     *[o.alias(f"_o{i}") for i, o in enumerate(order)],
                     *[F.coalesce(m.cast("long"), F.lit(0)).alias(f"_m_{n}") for n, m in measures.items()])
    srt = rows.orderBy("_k1", "_k2", *[f"_o{i}" for i in range(len(order))]).withColumn("_pid", F.spark_partition_id())
    srt = cut_lineage(srt.drop(*[f"_o{i}" for i in range(len(order))]))       # the order stays without its columns

    def bounds(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        k1, k2 = pdf["_k1"].to_numpy(), pdf["_k2"].to_numpy()
        return np.flatnonzero(np.r_[True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])]), k1, k2

    def last_key(it):
        """(first key, last key, sums of the last key) of a partition."""
        first = last = None
        sums = np.zeros(len(names), dtype=np.int64)
        pid = 0
        for pdf in it:
            if pdf.empty:
                continue
            pid = int(pdf["_pid"].iloc[0])
            starts, k1, k2 = bounds(pdf)
            first = first or (int(k1[0]), int(k2[0]))
            tail = np.array([pdf[f"_m_{n}"].to_numpy()[starts[-1]:].sum() for n in names], dtype=np.int64)
            now = (int(k1[-1]), int(k2[-1]))
            sums = sums + tail if now == last else tail
            last = now
        if last is not None:
            yield pd.DataFrame([(pid, *first, *last, sums.tolist())], columns=["pid", "a1", "a2", "b1", "b2", "sums"])

    ends = sorted(srt.mapInPandas(last_key, "pid int, a1 long, a2 long, b1 long, b2 long, sums array<long>").collect(),
                  key=lambda r: r["pid"])
    carried: dict[int, tuple[tuple[int, int], np.ndarray]] = {}
    open_key, open_sums = None, np.zeros(len(names), dtype=np.int64)
    for r in ends:
        if open_key == (r["a1"], r["a2"]):
            carried[r["pid"]] = (open_key, open_sums)
        goes_on = open_key == (r["a1"], r["a2"]) == (r["b1"], r["b2"])
        open_sums = np.array(r["sums"], dtype=np.int64) + (open_sums if goes_on else 0)
        open_key = (r["b1"], r["b2"])

    def walk(it):
        state = None
        for pdf in it:
            if pdf.empty:
                continue
            starts, k1, k2 = bounds(pdf)
            state = state or carried.get(int(pdf["_pid"].iloc[0]))
            out = pdf[[*keep, "_k1", "_k2"]].copy()
            group = np.zeros(len(pdf), dtype=np.int64)
            group[starts] = 1
            group = np.cumsum(group) - 1
            first = slice(0, starts[1] if len(starts) > 1 else len(pdf))
            goes_on = state is not None and state[0] == (int(k1[0]), int(k2[0]))
            last = []
            for i, n in enumerate(names):
                m = pdf[f"_m_{n}"].to_numpy().astype(np.int64)
                run = np.cumsum(m)
                run = run - (run[starts] - m[starts])[group]
                if goes_on:
                    run[first] += state[1][i]
                out[f"cum_{n}"] = run
                last.append(run[-1])
            state = ((int(k1[-1]), int(k2[-1])), np.array(last, dtype=np.int64))
            yield out

    fields = [*(srt.schema[c] for c in (*keep, "_k1", "_k2")), *(T.StructField(f"cum_{n}", T.LongType()) for n in names)]
    return srt.mapInPandas(walk, T.StructType(fields))


def _order_group_rows(rows, group):
    return sorted(rows, key=lambda r: r["_pid"])


def sketch_rank_error(k: int) -> float:
    """Rank error of a quantile from a sketch of size ``k``, as a share of the rows (holds with 99 %
    confidence for one quantile, by the published analysis of this kind of sketch)."""
    return 2.296 / k ** 0.9723


def quantile_sketch(df: DataFrame, col: str, keys: Sequence[str] = (), k: int = 1024) -> DataFrame:
    """(keys, sketch): one mergeable quantile sketch per key (or one in all), of bounded size
    whatever the rows; nulls are ignored.  Sketches of parts (days, say) can be stored and merged."""
    src = df.where(F.col(col).isNotNull())
    agg = F.kll_sketch_agg_double(F.col(col).cast("double"), F.lit(k)).alias("sketch")
    return src.groupBy(*keys).agg(agg) if keys else src.agg(agg)


def merge_sketches(parts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One sketch per key from the sketches of its parts."""
    agg = F.kll_merge_agg_double("sketch").alias("sketch")
    return parts.groupBy(*keys).agg(agg) if keys else parts.agg(agg)


def sketch_quantiles(sketches: DataFrame, probs: Sequence[float], group: str | None = None) -> dict:
    """{prob: value} (or per ``group``) of sketches, each within :func:`sketch_rank_error` of its
    rank; None without rows.  One row per group reaches the driver."""
    values = [F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(f"q{i}") for i, p in enumerate(probs)]
    rows = sketches.where(F.col("sketch").isNotNull() & (F.kll_sketch_get_n_double("sketch") > 0)).select(
        *([group] if group else []), *values).collect()
    found = {r[group] if group else None: {p: r[f"q{i}"] for i, p in enumerate(probs)} for r in rows}
    return found if group else found.get(None, {p: None for p in probs})


SMALL_VALUE_COUNTS = 100_000


def _interpolate(sorted_vals: list, counts: list, probs, n: int) -> dict:
    """Linear-interpolated quantiles from (value, count) pairs in value order."""
    cum = np.cumsum(counts)

    def value_at(i):
        return sorted_vals[int(np.searchsorted(cum, i, side="right"))]

    res = {}
    for p in probs:
        h = (n - 1) * p
        lo, hi = int(math.floor(h)), int(math.ceil(h))
        a, b = float(value_at(lo)), float(value_at(hi))
        t = h - lo
        res[p] = a + (b - a) * t if t < 0.5 else b - (b - a) * (1 - t)
    return res


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], group: str | None = None,
                    weight: str | None = None) -> dict:
    """Linear-interpolated quantiles of ``col`` (NULLs ignored) -- the numpy /
    ``quantile_cont`` / ``percentile`` definition -- without Spark's single-task
    value map.

    The value counts are aggregated first (partial aggregation).  When that
    table is small (checked: at most ``SMALL_VALUE_COUNTS`` rows) it is
    collected and interpolated directly; otherwise the counts are put in a
    distributed global order and only the rows covering the needed positions
    (at most two per probability and group) are collected.

    ``weight`` names a column of row multiplicities (for pre-aggregated input).
    Returns {prob: value} or, with ``group``, {group_value: {prob: value}}.
    """
    keys = [group] if group else []
    cnt = F.count(F.lit(1)) if weight is None else F.sum(weight)
    src = df.where(F.col(col).isNotNull()) if weight is None else df.where(F.col(col).isNotNull() & (F.col(weight) > 0))
    vc = cut_lineage(src.groupBy(*keys, col).agg(cnt.cast("long").alias("_c")))   # aggregated once for either way
    small = vc.limit(SMALL_VALUE_COUNTS + 1).collect()
    if len(small) <= SMALL_VALUE_COUNTS:
        by: dict = {}
        for r in small:
            by.setdefault(r[group] if group else None, []).append((r[col], r["_c"]))
        out = {}
        for g, pairs in by.items():
            pairs.sort(key=lambda x: x[0])
            vals = [v for v, _ in pairs]
            cnts = [c for _, c in pairs]
            out[g] = _interpolate(vals, cnts, probs, int(sum(cnts)))
        return out if group else out.get(None, {p: None for p in probs})

    order = ([F.col(group)] if group else []) + [F.col(col)]
    totals: dict = {}
    cum = global_cumulative(vc, order, {"c": F.col("_c")}, keep=keys + [col, "_c"], group=group,
                            totals_out=totals)
    totals = {g: int(v[1]) for g, v in totals.items()}        # number of non-NULL values
    return quantiles_from_running(cum, col, "_c", "cum_c", totals, probs, group)


def quantiles_from_running(cum: DataFrame, col: str, count: str, running: str, totals: dict, probs: Sequence[float],
                           group: str | None = None) -> dict:
    """Quantiles from value counts with their running sums: only the rows that cover a needed
    position (at most two per probability and group) are collected.  ``totals``: number of
    values per group (key None without groups)."""
    keys = [group] if group else []
    cum = cum.where(F.col(count) > 0)
    # positions needed (0-based) per group
    need: dict = {}
    for g, n in totals.items():
        for p in probs:
            h = (n - 1) * p
            need.setdefault(g, set()).update({int(math.floor(h)), int(math.ceil(h))})
    # a distinct value covers 0-based positions [cum - c, cum - 1]
    conds = []
    for g, pos in need.items():
        arr = F.array(*[F.lit(int(x)) for x in sorted(pos)])
        hit = F.exists(arr, lambda x: (x >= F.col(running) - F.col(count)) & (x <= F.col(running) - 1))
        conds.append(hit if not group else ((F.col(group) == F.lit(g)) & hit))
    cond = conds[0]
    for c in conds[1:]:
        cond = cond | c
    rows = cum.where(cond).select(*keys, col, F.col(count).alias("_c"), F.col(running).alias("cum_c")).collect()
    lookup: dict = {}
    for r in rows:
        g = r[group] if group else None
        lookup.setdefault(g, []).append((r["cum_c"] - r["_c"], r["cum_c"] - 1, r[col]))

    def value_at(g, i):
        for lo, hi, v in lookup[g]:
            if lo <= i <= hi:
                return v
        raise KeyError(i)

    out: dict = {}
    for g, n in totals.items():
        res = {}
        for p in probs:
            h = (n - 1) * p
            lo, hi = int(math.floor(h)), int(math.ceil(h))
            a, b = float(value_at(g, lo)), float(value_at(g, hi))
            t = h - lo
            res[p] = a + (b - a) * t if t < 0.5 else b - (b - a) * (1 - t)
        out[g] = res
    return out if group else out[None]
