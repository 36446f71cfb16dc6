"""Centroid clustering (Lloyd's rounds) with ns-bounds.

Every vector keeps, from the round in which it was last *evaluated* (all its centroid
distances taken): its centroid, an upper bound of the distance to it and a lower bound of the
distance to each other centroid.  All earlier centroids are retained, so in a later round the
bounds are loosened by the norm of a centroid's total displacement since that evaluation (the
norm of the sum), not by the sum of its drifts round by round, which is never smaller.  While
the upper bound stays below every other centroid's lower bound the vector keeps its centroid
without any distance; vectors that fail are evaluated again, exactly.

Components are whole numbers and all distances are exact integers; bounds are doubles widened
by more than their rounding error, so results equal those of the plain algorithm, ties
included (the smaller centroid number wins; a tie never passes the bounds).

One Spark job a round: the stored table of vectors and bounds is read, written anew with the
bounds of this round, and carries one row of sums per centroid and task, so no vector is ever
shuffled and no second pass is needed.  The driver holds the centroids of the rounds
(rounds x k x dimension numbers, whatever the table's size).  A round's table goes once the
next one is written.

Defined cases: vectors of another length than ``dimension``, null, or with null or non-finite
components take no part; repeated rows each count; a null id takes part but never starts a
centroid; fewer vectors than ``k`` give as many centroids; an empty table gives no rows; other
columns are ignored whatever their names.  Components beyond 2^26 steps raise an error, as
squared distances would leave 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerguard.llm.common import drop_stored, finite_vectors, store_at, whole_components

#: relative widening of a bound: far above the rounding of a square root and a sum of doubles
SLACK = 1e-9
STATE = ("vec_id long, x array<int>, cluster int, since int, upper double, lower array<double>, "
         "sums array<long>, members long, rescanned long")
_TYPES = pa.schema([("vec_id", pa.int64()), ("x", pa.list_(pa.int32())), ("cluster", pa.int32()), ("since", pa.int32()),
                    ("upper", pa.float64()), ("lower", pa.list_(pa.float64())), ("sums", pa.list_(pa.int64())),
                    ("members", pa.int64()), ("rescanned", pa.int64())])


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    n, d = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * d), pa.array(values.reshape(-1), kind))


def squared_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """(rows, centroids) exact squared distances of whole numbers."""
    out = np.empty((len(x), len(centroids)), dtype=np.int64)
    for k, c in enumerate(centroids):
        gap = x - c
        out[:, k] = np.einsum("ij,ij->i", gap, gap)
    return out


def shifts(history: np.ndarray) -> np.ndarray:
    """(round, centroid): norm of the total displacement of a centroid from that round to the
    last of ``history`` (rounds, centroids, dimension), rounded up."""
    gap = (history[-1][None] - history).astype(np.float64)
    return np.sqrt((gap * gap).sum(axis=2)) * (1 + SLACK)


def assign_round(x: np.ndarray, cluster: np.ndarray, since: np.ndarray, upper: np.ndarray, lower: np.ndarray,
                 history: np.ndarray) -> int:
    """One assignment of all ``x`` to the last centroids of ``history``; the state is brought up
    to date in place.  ``since`` is the round of a vector's last evaluation (-1: never).
    Returns the number of vectors evaluated."""
    now = len(history) - 1
    moved = shifts(history)
    loosest = upper + moved[since, cluster]                       # at most this far from its own centroid
    nearest_other = lower - moved[since]                          # at least this far from the others
    nearest_other[np.arange(len(x)), cluster] = np.inf
    fails = (since < 0) | (loosest >= nearest_other.min(axis=1, initial=np.inf))
    if fails.any():
        exact = squared_distances(x[fails], history[-1])
        own = exact.argmin(axis=1)                                # the first of equals
        length = np.sqrt(exact.astype(np.float64))
        cluster[fails], since[fails] = own, now
        upper[fails] = length[np.arange(len(own)), own] * (1 + SLACK)
        lower[fails] = length * (1 - SLACK)
    return int(fails.sum())


def _round_task(history: np.ndarray):
    """The rows of a stored round with their state after one more assignment, then one row of
    sums per centroid (null vec_id and x)."""
    k, d = history.shape[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, members, rescanned = np.zeros((k, d), dtype=np.int64), np.zeros(k, dtype=np.int64), 0
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(b.num_rows, d)
            lower = b.column("lower").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, k).copy()
            cluster, since, upper = (b.column(c).to_numpy(zero_copy_only=False).copy() for c in ("cluster", "since", "upper"))
            rescanned += assign_round(x, cluster, since, upper, lower, history)
            np.add.at(sums, cluster, x)
            members += np.bincount(cluster, minlength=k)
            none = pa.nulls(b.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("x"), pa.array(cluster, pa.int32()), pa.array(since, pa.int32()),
                 pa.array(upper), _lists(lower, pa.float64()), pa.nulls(b.num_rows, _TYPES.field("sums").type), none, none], schema=_TYPES)
        if members.any():
            used = np.flatnonzero(members)
            counts = np.zeros(len(used), dtype=np.int64)
            counts[0] = rescanned
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(used), pa.int64()), pa.nulls(len(used), _TYPES.field("x").type), pa.array(used, pa.int32()),
                 pa.nulls(len(used), pa.int32()), pa.nulls(len(used), pa.float64()), pa.nulls(len(used), _TYPES.field("lower").type),
                 _lists(sums[used], pa.int64()), pa.array(members[used]), pa.array(counts)], schema=_TYPES)
    return run


def _start(kept: DataFrame, k: int, seed: int) -> np.ndarray:
    """The first centroids: the ``k`` vectors whose id has the smallest salted hash."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.where("vec_id is not null").orderBy(order, "x").limit(k).collect()
    return np.array([r["x"] for r in first], dtype=np.int64)


def _moved(sums: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, int]:
    """Centroids after the means (rounded down) of their members; empty ones stay.  ``sums`` has
    a row per task and centroid; k x dimension totals reach the driver."""
    parts = sums.select("cluster", "members", "rescanned", F.posexplode("sums").alias("place", "part"))
    totals = parts.groupBy("cluster", "place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("s"),
                                                   F.sum("members").alias("n"), F.sum("rescanned").alias("r")).collect()
    out = centroids.copy()
    for t in totals:
        out[t["cluster"], t["place"]] = int(t["s"]) // t["n"]
    return out, sum(t["r"] for t in totals if t["place"] == 0)


def _last_task(history: np.ndarray):
    """(vec_id, cluster, distance): a last assignment, and the exact distance to the centroid."""
    k, d = history.shape[1:]
    kind = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _round_task(history)(batches):
            rows = b.filter(b.column("x").is_valid())
            if rows.num_rows:
                x = rows.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(rows.num_rows, d)
                gap = x - history[-1][rows.column("cluster").to_numpy()]
                yield pa.RecordBatch.from_arrays([rows.column("vec_id"), rows.column("cluster"),
                                                  pa.array(np.einsum("ij,ij->i", gap, gap))], schema=kind)
    return run


def cluster_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 8, rounds: int = 10,
                    dimension: int = 64, steps: int = 1024, seed: int = 3, report: list | None = None) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) for every vector
    that takes part: ``rounds`` rounds of assignment and means, then a last assignment.

    Components are floor(steps * x).  ``report`` (if given) receives the number of vectors
    evaluated exactly in each round; the others passed their bounds."""
    spark = vectors.sparkSession
    whole = whole_components(finite_vectors(vectors, key, vector).where(F.size("v") == dimension), steps)
    kept = whole.select(F.col("id").alias("vec_id"), F.col("x").cast("array<int>").alias("x"))
    centroids = _start(kept, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
                                         "centroid_sha256 string")
    state = kept.select(
        "vec_id", "x", F.lit(0).alias("cluster"), F.lit(-1).alias("since"), F.lit(0.0).alias("upper"),
        F.array_repeat(F.lit(0.0), len(centroids)).alias("lower"))
    history, path = [centroids], None
    for _ in range(rounds):
        now = np.stack(history)
        written, at = store_at(state.mapInArrow(_round_task(now), STATE), "centroid-round")
        centroids, evaluated = _moved(written.where("members is not null"), history[-1])
        if report is not None:
            report.append(evaluated)
        history.append(centroids)
        if path:
            drop_stored(spark, path)
        path = at
        state = written.where("members is null").select("vec_id", "x", "cluster", "since", "upper", "lower")
    final, _ = store_at(state.mapInArrow(_last_task(np.stack(history)), "vec_id long, cluster int, distance long"),
                        "centroid-clusters")
    if path:
        drop_stored(spark, path)
    totals = {r["cluster"]: int(r["s"]) for r in final.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}       # at most k rows
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in history[-1]]
    per = spark.createDataFrame([(c, s, sum(totals.values()), digest[c]) for c, s in totals.items()],
                                "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return final.join(F.broadcast(per), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                                                          "centroid_sha256")
