"""As-of history of keys too large for a window partition, in any stretch of time.

A trailing frame is the difference of two prefix sums of its key's timeline: what came before
the row, less what came up to the frame's lower edge.  So every row sends one *probe* per edge
to its key's timeline, at the edge's time and after all rows of that time; one running sum over
rows and probes in (key, time) order then holds all of them, and probes report back by row id.
The order is range-partitioned (``ordering.running_by_key``): a key whose rows all lie in one
day, hour or microsecond is spread over all tasks like any other, without context copies.

Every row also gets the row before it, by its place in the key's order; first appearances are
the rows in place one of (key, value).  All joins are by row id or by (key, place), so no join
meets a hot key either.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerguard.operators.asof import join_null_safe
from ledgerguard.operators.ordering import running_by_key
from ledgerguard.session import cut_lineage

UID = "_uid"
#: squares of whole numbers are summed as high and low parts, so that running sums stay in 64 bits
SQUARE_PART = 1 << 31
#: a probe after all rows of its key
WHOLE = "whole"


def identified(df: DataFrame) -> DataFrame:
    """``df`` written once to the checkpoint folder, with a row id that stays."""
    return cut_lineage(df.withColumn(UID, F.monotonically_increasing_id()))


def square_parts(value: Column) -> dict[str, Column]:
    square = value.cast("decimal(38,0)") * value.cast("decimal(38,0)")
    return {"sq_hi": F.floor(square / SQUARE_PART), "sq_lo": square % SQUARE_PART}


def square_sum(hi: Column, lo: Column) -> Column:
    return (hi.cast("decimal(38,0)") * F.lit(SQUARE_PART).cast("decimal(12,0)") + lo.cast("decimal(38,0)")).cast("decimal(38,0)")


def exact_zscore(value: Column, n: Column, total: Column, squares: Column) -> Column:
    """(x - mean) / population deviation of ``n`` values by their exact sums; 0 for fewer than
    two or without variance (the rule of ``asof.prior_zscore``)."""
    n, s, c = n.cast("decimal(38,0)"), total.cast("decimal(38,0)"), value.cast("decimal(38,0)")
    den = (n * squares - s * s).cast("decimal(38,0)")
    z = (n * c - s).cast("decimal(38,0)").cast("double") / F.sqrt(den.cast("double"))
    return F.when((n >= 2) & (den > 0), z).otherwise(F.lit(0.0))


def first_of(rows: DataFrame, keys: Sequence[str], ts: str, tie: str) -> DataFrame:
    """Row ids of the first row of each key."""
    run = running_by_key(rows, keys, [F.col(ts), F.col(tie)], {"n": F.lit(1)}, keep=[UID])
    return run.where("cum_n = 1").select(UID)


def with_prior(rows: DataFrame, keys: Sequence[str], ts: str, tie: str, values: dict[str, Column] | None = None,
               edges: dict[str, int | None] | None = None, previous: Sequence[str] = ()) -> DataFrame:
    """``rows`` (identified) with, per row of ``keys`` (nulls are one key) in (ts, tie) order:

    * ``_n`` and ``_s_<value>``: rows before it, and their whole-number values' sums;
    * ``_n_<edge>`` and ``_s_<value>_<edge>`` for each edge: the same of the key's rows at most at
      ts - offset (so 0 gives its own time with all peers; ``WHOLE``: None, the whole key);
    * ``_prev``: the columns ``previous`` of the row before it (null for the first).
    """
    values, edges = dict(values or {}), dict(edges or {})
    measures = ["n", *values]
    own = rows.select(*keys, F.col(ts).cast("long").alias("_t"), F.lit(0).alias("_kind"), F.col(tie).alias("_tie"), UID,
                      F.lit(1).cast("long").alias("n"), *[F.coalesce(v.cast("long"), F.lit(0)).alias(n) for n, v in values.items()])
    events = own
    for k, offset in enumerate(edges.values()):
        at = F.lit((1 << 63) - 1) if offset is None else F.col("_t") - offset
        events = events.unionByName(own.select(*keys, at.alias("_t"), F.lit(k + 1).alias("_kind"), "_tie", UID,
                                               *[F.lit(0).cast("long").alias(m) for m in measures]))
    run = running_by_key(events, keys, [F.col("_t"), F.col("_kind"), F.col("_tie"), F.col(UID)],
                         {m: F.col(m) for m in measures}, keep=["_kind", UID])
    at = lambda kind, m: F.max(F.when(F.col("_kind") == kind, F.col(f"cum_{m}")))
    name = lambda m: "_n" if m == "n" else f"_s_{m}"
    found = run.groupBy(UID).agg(*[at(0, m).alias(f"_at_{m}") for m in measures],
                                 *[at(k + 1, m).alias(f"{name(m)}_{edge}") for k, edge in enumerate(edges) for m in measures])
    out = rows.join(found, UID)
    out = out.withColumn("_n", F.col("_at_n") - 1).withColumns(
        {f"_s_{n}": F.col(f"_at_{n}") - F.coalesce(v.cast("long"), F.lit(0)) for n, v in values.items()})
    if previous:
        place = run.where("_kind = 0").select("_k1", "_k2", F.col("cum_n").alias("_place"), UID)
        before = (place.join(rows.select(UID, *[F.col(c).alias(f"_prev_{c}") for c in previous]), UID)
                  .select("_k1", "_k2", (F.col("_place") + 1).alias("_place"),
                          F.struct(*[F.col(f"_prev_{c}").alias(c) for c in previous]).alias("_prev")))
        out = out.join(place.join(before, ["_k1", "_k2", "_place"]).select(UID, "_prev"), UID, "left")
    return out.drop(*[f"_at_{m}" for m in measures])


def prior_block(df: DataFrame, keys: Sequence[str], ts: str, tie: str, value_minor: str | None = None,
                width_us: int | None = None, distinct: str | None = None, prefix: str = "_p", gap: bool = True,
                few_keys: bool = False) -> DataFrame:
    """The as-of block of entity features for hot keys: ``df`` with ``{prefix}_n`` (rows before),
    ``_total`` (rows of the key), ``_gap`` (microseconds since the row before), for a value ``_s``
    and ``_z`` (prior sum and exact z-score), with a width ``_cw`` and ``_sw`` (earlier rows not
    older than it, and their sum), and for ``distinct`` ``_distinct`` (its values seen before).

    ``_gap`` only with ``gap``.  A frame that has row ids already (of a stored table) is not written
    again.  ``few_keys``: the keys' totals are few enough to be broadcast."""
    whole = df if UID in df.columns else identified(df)
    # the passes read and move only these columns; the whole rows are joined once at the end
    rows = whole.select(UID, *dict.fromkeys([*keys, ts, tie, *[c for c in (value_minor, distinct) if c]]))
    values = {}
    if value_minor:
        c = F.col(value_minor)
        values = {"c": c, "nn": c.isNotNull().cast("long")} | square_parts(c)
    if distinct:
        # aggregated by task first, so that a value of very many rows is no task's either
        first = (rows.groupBy(*keys, distinct).agg(F.min(F.struct(F.col(ts), F.col(tie), F.col(UID))).alias("_f"))
                 .select(F.col(f"_f.{UID}").alias(UID), F.lit(1).alias("_first")))
        rows = cut_lineage(rows.join(first, UID, "left"))
        values["new"] = F.col("_first")
    edges: dict[str, int | None] = ({} if few_keys else {WHOLE: None}) | ({"w": int(width_us) + 1} if width_us else {})
    out = with_prior(rows, keys, ts, tie, values, edges, [ts] if gap else [])
    if few_keys:
        out = join_null_safe(out, F.broadcast(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"_n_{WHOLE}"))), list(keys), "inner")
    cols = [F.col("_n").alias(f"{prefix}_n"), F.col(f"_n_{WHOLE}").alias(f"{prefix}_total")]
    if gap:
        cols.append((F.col(ts) - F.col(f"_prev.{ts}")).alias(f"{prefix}_gap"))
    if value_minor:
        squares = square_sum(F.col("_s_sq_hi"), F.col("_s_sq_lo"))
        cols += [F.col("_s_c").alias(f"{prefix}_s"),
                 exact_zscore(F.col(value_minor), F.col("_s_nn"), F.col("_s_c"), squares).alias(f"{prefix}_z")]
        if width_us:
            cols += [(F.col("_n") - F.col("_n_w")).alias(f"{prefix}_cw"), (F.col("_s_c") - F.col("_s_c_w")).alias(f"{prefix}_sw")]
    if distinct:
        cols.append(F.col("_s_new").alias(f"{prefix}_distinct"))
    return whole.join(out.select(UID, *cols), UID).drop(UID)


def prior_counts(df: DataFrame, keys: dict[str, str], ts: str, tie: str) -> DataFrame:
    """``df`` with, for each name of ``keys``, the rows before this one with the same value of that
    key column (null where the key is null).  All keys go through one running count over narrow
    rows, so the frame itself is written and joined once, however many keys there are."""
    rows = identified(df)
    narrow = rows.select(UID, F.col(ts), F.col(tie), F.explode(F.array(*[
        F.struct(F.lit(i).alias("no"), F.col(k).cast("string").alias("key")) for i, k in enumerate(keys.values())])).alias("_kv"))
    narrow = narrow.select(UID, ts, tie, F.col("_kv.no").alias("_no"), F.col("_kv.key").alias("_key")).where(F.col("_key").isNotNull())
    run = running_by_key(narrow, ["_no", "_key"], [F.col(ts), F.col(tie), F.col(UID)], {"n": F.lit(1)}, keep=["_no", UID])
    found = run.groupBy(UID).agg(*[F.max(F.when(F.col("_no") == i, F.col("cum_n") - 1)).alias(name) for i, name in enumerate(keys)])
    return rows.join(found, UID, "left").drop(UID)
