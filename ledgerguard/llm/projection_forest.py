"""Approximate nearest neighbours by a forest of random-projection trees.

* *Fit*: trees are grown on a bounded hash sample (``sample_rows``): a node's hyperplane lies
  between two random sample vectors and is moved to the median, so every split halves its
  rows.  For inner products, vectors get one more coordinate that makes all lengths equal
  (and is zero for queries), which turns the largest inner product into the smallest angle.
* *Index*: every row goes down every tree; a leaf's rows are cut into blocks of about
  ``block_rows``, so a dense region is spread over tasks.
* *Search*: one priority queue per query (scaled to unit length, which changes no ranking) holds
  open nodes of all trees; the node that the query lies nearest to is opened next.  It first
  takes leaves with ``first_rows`` rows (a row counts in every tree; leaf sizes are known from
  the index).  The distance d of the ``top``-th candidate found then bounds the rest: no nearer
  vector lies across a hyperplane further away than d, and few lie further than ``reach`` x d /
  sqrt(dimension), the typical part of a distance along one direction.  The queue is followed
  up to that margin, or until it has opened as many rows as ``search_share`` of the table.
  Clustered vectors end early; for vectors whose nearest are hardly nearer than others (64
  dimensions, inner products of about 0.4 between unit vectors) no margin tells much, and nearly
  as many rows are read as there are.
* *Rerank*: queries meet their leaves' rows; inner products of the original vectors in double
  precision, nearest per block, then per query.

Of equal vectors only the ``top`` + 1 smallest ids can be among any query's nearest, so the
others are left out of the index without changing any result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgerguard.llm.common import cut_lineage, shuffle_partitions


class Forest:
    """Trees in arrays: node k splits by ``normal[k] . x > shift[k]`` into ``child[k]``
    (left, right); a negative child -1 - c is leaf c."""

    def __init__(self, sample: np.ndarray, trees: int, leaf_sample: int, seed: int = 7):
        self.normals: list[np.ndarray] = []
        self.shifts: list[float] = []
        self.children: list[list[int]] = []
        self.leaves = 0
        rng = np.random.default_rng(seed)
        self.roots = [self._grow(sample, np.arange(len(sample)), leaf_sample, rng) for _ in range(trees)]
        d = sample.shape[1] if sample.ndim == 2 else 0
        self.normal = np.array(self.normals, dtype=np.float32).reshape(-1, d)
        self.shift = np.array(self.shifts, dtype=np.float32)
        self.child = np.array(self.children, dtype=np.int64).reshape(-1, 2)
        del self.normals, self.shifts, self.children

    def _grow(self, x: np.ndarray, rows: np.ndarray, leaf_sample: int, rng) -> int:
        if len(rows) > leaf_sample:
            for _ in range(3):
                a, b = x[rng.choice(rows, 2, replace=False)]
                normal = a / max(np.linalg.norm(a), 1e-12) - b / max(np.linalg.norm(b), 1e-12)
                side = x[rows] @ normal
                shift = float(np.median(side))
                right = side > shift
                if 0 < right.sum() < len(rows):
                    k = len(self.normals)
                    size = max(float(np.linalg.norm(normal)), 1e-12)
                    self.normals.append(normal / size)
                    self.shifts.append(shift / size)
                    self.children.append([0, 0])
                    self.children[k] = [self._grow(x, rows[~right], leaf_sample, rng),
                                        self._grow(x, rows[right], leaf_sample, rng)]
                    return k
        self.leaves += 1
        return -self.leaves

    def leaves_of(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees) leaf numbers."""
        out = np.empty((len(x), len(self.roots)), dtype=np.int64)
        for t, root in enumerate(self.roots):
            at = np.full(len(x), root, dtype=np.int64)
            while (open_ := np.flatnonzero(at >= 0)).size:
                node = at[open_]
                right = np.einsum("ij,ij->i", x[open_], self.normal[node]) > self.shift[node]
                at[open_] = self.child[node, right.astype(np.int64)]
            out[:, t] = -1 - at
        return out

    def search(self, query: np.ndarray, sizes: list[int], first: int, rows: int = 0, reach: float = -np.inf) -> list[int]:
        """Leaves opened for one query by the shared queue: until they hold ``first`` rows, and on
        while nodes are within ``reach`` and the leaves hold less than ``rows`` rows."""
        margin = (self.normal @ query - self.shift).tolist()
        child = self.child
        queue = [(-np.inf, r) for r in self.roots]
        heapq.heapify(queue)
        found, got = [], 0
        while queue and got < max(first, rows):
            priority, node = heapq.heappop(queue)
            if got >= first and priority > reach:
                break
            if node < 0:
                found.append(-1 - node)
                got += sizes[-1 - node]
                continue
            m = margin[node]
            left, right = child[node].tolist()
            heapq.heappush(queue, (max(priority, m), left))
            heapq.heappush(queue, (max(priority, -m), right))
        return found


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def usable_vectors(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v) rows that take part: a key, a vector of the table's (most common) length without
    null or non-finite components, not all zero."""
    good = vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0)).select(
        F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = good.where(~bad & F.exists("v", lambda x: x != 0))
    common = good.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return good.where(F.size("v") == (common[0]["d"] if common else 0))


def nearest(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", query_every: int = 20, top: int = 20,
            trees: int = 16, sample_rows: int = 20_000, leaf_sample: int = 128, search_share: float = 1.25,
            first_rows: int = 4_000, reach: float = 0.5, block_rows: int = 4_096, queries: DataFrame | None = None
            ) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` largest inner products found per query,
    largest first, ties to the smaller id.  Queries are the rows whose key is divisible by
    ``query_every`` (or ``queries``, with the same columns); a query's own key is no candidate.

    Rows without a key or with an unusable vector take no part; repeated keys count as one row
    per distinct vector; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    good = cut_lineage(usable_vectors(vectors, key, vector).distinct())
    asked = good.where(F.col("id") % query_every == 0) if queries is None else usable_vectors(queries, key, vector)
    copies = Window.partitionBy("v").orderBy("id")
    indexed = cut_lineage(good.withColumn("__n", F.row_number().over(copies)).where(F.col("__n") <= top + 1).drop("__n"))
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    kind = good.schema["v"].dataType.simpleString()
    size = indexed.agg(F.count("*").alias("n"), F.max(square).alias("m")).first()
    out_schema = "query_id long, rank int, vec_id long, score double"
    if not size["n"]:
        return spark.createDataFrame([], out_schema)
    longest = float(np.sqrt(size["m"]))
    unit = F.pmod(F.xxhash64("id", F.lit("forest")), F.lit(1 << 30)) / F.lit(1 << 30)
    sample = indexed.where(unit < min(1.0, sample_rows / size["n"])).orderBy("id").select("v").collect()

    def lifted(x: np.ndarray) -> np.ndarray:
        x = x / longest
        rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", x, x)))
        return np.c_[x, rest].astype(np.float32)

    forest = Forest(lifted(np.array([r["v"] for r in sample], dtype=float)) if sample else
                    np.empty((0, 1), np.float32), trees, leaf_sample)
    shared = spark.sparkContext.broadcast(forest)   # trees x sample / leaf_sample hyperplanes

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            leaf = shared.value.leaves_of(lifted(_matrix(batch.column(1))))
            for t in range(leaf.shape[1]):
                yield pa.RecordBatch.from_arrays([pa.array(leaf[:, t]), batch.column(0), batch.column(1)],
                                                 names=["leaf", "id", "v"])

    placed = indexed.select("id", "v").mapInArrow(index, f"leaf long, id long, v {kind}")
    counts = placed.groupBy("leaf").count().collect()   # one row per leaf: bounded by the sample
    sizes = [0] * forest.leaves
    for r in counts:
        sizes[r["leaf"]] = r["count"]
    known = spark.sparkContext.broadcast(sizes)
    most = int(search_share * size["n"])
    blocks = spark.createDataFrame([(leaf, -(-n // block_rows)) for leaf, n in enumerate(sizes) if n],
                                   "leaf long, blocks int")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Leaves of each query: the first ones, or (with a bound) those that follow them."""
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            length = np.maximum(np.sqrt(np.einsum("ij,ij->i", x, x)), 1e-300)[:, None]
            rows = np.c_[x / length, np.zeros(len(x))].astype(np.float32)
            found = [shared.value.search(q, known.value, first_rows) for q in rows]
            if batch.num_columns > 2:
                # squared distance of unit vectors to the worst candidate (none: all are nearer)
                worst = batch.column(2).to_numpy(zero_copy_only=False) / (length[:, 0] * longest)
                gap = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * np.nan_to_num(worst, nan=-1.0)))
                bound = np.minimum(reach / np.sqrt(x.shape[1]), 1.0) * gap
                found = [shared.value.search(q, known.value, first_rows, most, r)[len(f):]
                         for q, r, f in zip(rows, bound.tolist(), found, strict=True)]
            at = np.repeat(np.arange(len(found)), [len(f) for f in found])
            take = pa.array(at)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).astype(np.int64)),
                                              batch.column(0).take(take), batch.column(1).take(take)],
                                             names=["leaf", "id", "v"])

    n_parts = shuffle_partitions(spark)
    cells = placed.join(F.broadcast(blocks), "leaf").withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))

    def meet(_, ours: pa.Table, theirs: pa.Table) -> pa.Table:
        empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                          "score": pa.array([], pa.float64())})
        if not ours.num_rows or not theirs.num_rows:
            return empty
        qid, vid = ours.column("id").to_numpy(), theirs.column("id").to_numpy()
        q, v = _matrix(ours.column("v").combine_chunks()), _matrix(theirs.column("v").combine_chunks())
        rows = []
        for a in range(0, len(q), 256):
            near = q[a:a + 256] @ v.T
            near[qid[a:a + 256, None] == vid[None, :]] = -np.inf
            k = min(top, near.shape[1])
            least = -np.partition(-near, k - 1, axis=1)[:, k - 1]
            slack = 1e-9 * (1.0 + np.abs(np.where(np.isfinite(least), least, 0.0)))
            i, j = np.nonzero((near >= (least - slack)[:, None]) & np.isfinite(near))
            score = (q[a + i] * v[j]).sum(axis=1)      # one order of summation for every pair
            order = np.lexsort((vid[j], -score, i))
            i, j, score = i[order], j[order], score[order]
            place = np.arange(len(i)) - np.searchsorted(i, i)
            ok = place < top
            rows.append((qid[a + i[ok]], vid[j[ok]], score[ok]))
        cols = [np.concatenate(c) for c in zip(*rows, strict=True)]
        return pa.table({"query_id": pa.array(cols[0]), "vec_id": pa.array(cols[1]), "score": pa.array(cols[2])})

    def candidates(asked: DataFrame) -> DataFrame:
        probes = (asked.repartition(n_parts, "id").mapInArrow(probe, f"leaf long, id long, v {kind}")
                  .join(F.broadcast(blocks), "leaf").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
        met = probes.select("leaf", "block", "id", "v").groupBy("leaf", "block").cogroup(
            cells.select("leaf", "block", "id", "v").groupBy("leaf", "block")).applyInArrow(
            meet, "query_id long, vec_id long, score double")
        return met.distinct()

    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= top)

    first = cut_lineage(best(candidates(asked.select("id", "v"))))
    worst = first.where(F.col("rank") == top).select(F.col("query_id").alias("id"), F.col("score").alias("worst"))
    more = candidates(asked.select("id", "v").join(worst, "id", "left"))
    return best(first.drop("rank").unionByName(more).distinct()).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
