"""Outlier score M5: an isolation forest trained and applied as Spark jobs.

Spark ML has no isolation forest, so:
1. each row has one hash position on a circle; tree t takes the rows of an arc
   of the circle that starts at t golden-ratio steps and holds about 1.25 * s
   rows, ordered by a hash of its own, and of them the first s (the same rule
   at every size: arcs of small tables overlap, those of large ones do not);
2. ``groupBy(tree).applyInPandas`` grows the trees (random feature, random
   split, depth limit ceil(log2 s)) and returns a node table of at most
   trees x (2^(depth+1) - 1) rows;
3. the node table -- bounded by construction, not by the data -- is shipped
   to every task and ``mapInPandas`` computes path lengths on Arrow batches;
4. scores are min-max scaled over the scored frame (reference behaviour) or
   over frozen bounds (``bounds=(lo, hi)``) for incremental scoring.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EULER = 0.5772156649015329
GOLDEN = 0.6180339887498949
NODE_SCHEMA = "tree int, node int, feature int, split double, left int, right int, size long, leaf boolean"


def c_factor(n: float) -> float:
    """Average path length of an unsuccessful search in a BST of n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + EULER) - 2.0 * (n - 1) / n


def _grow(x: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    nodes: list[list] = []

    def build(idx: np.ndarray, depth: int) -> int:
        me = len(nodes)
        nodes.append([me, -1, 0.0, -1, -1, len(idx), True])
        if depth >= max_depth or len(idx) <= 1:
            return me
        sub = x[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        cand = np.flatnonzero(hi > lo)
        if cand.size == 0:
            return me
        f = int(rng.choice(cand))
        s = float(rng.uniform(lo[f], hi[f]))
        left = idx[sub[:, f] < s]
        right = idx[sub[:, f] >= s]
        nodes[me][1], nodes[me][2], nodes[me][6] = f, s, False
        nodes[me][3] = build(left, depth + 1)
        nodes[me][4] = build(right, depth + 1)
        return me

    build(np.arange(len(x)), 0)
    return nodes


def fit_isolation_forest(train: DataFrame, feature_cols: Sequence[str], n_trees: int = 200,
                         sample_size: int = 256, seed: int = 0, id_col: str = "transaction_id") -> pd.DataFrame:
    """Returns the node table (bounded: n_trees x 511 rows at most)."""
    feats = [F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(feature_cols)]
    n = train.count()
    s = min(sample_size, n)
    whole = float(1 << 52)
    u = F.pmod(F.xxhash64(F.col(id_col), F.lit(seed), F.lit(-1)), F.lit(1 << 52)) / F.lit(whole)
    arc = min(1.0, 1.25 * s / max(n, 1))
    starts = F.array(*[F.struct(F.lit(t).alias("t"), F.lit((t * GOLDEN) % 1.0).alias("at")) for t in range(n_trees)])
    mine = F.filter(starts, lambda x: F.pmod(F.col("_u") - x["at"] + F.lit(1.0), F.lit(1.0)) < F.lit(arc))
    sampled = (train.select(F.col(id_col), *feats, u.alias("_u")).withColumn("_x", F.explode(mine))
               .select(F.col(id_col), *[f"_x{i}" for i in range(len(feats))], F.col("_x.t").alias("_t"))
               .withColumn("_h", F.xxhash64(F.col(id_col), F.lit(seed), F.col("_t"))))
    k = len(feature_cols)
    max_depth = int(math.ceil(math.log2(max(s, 2))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(pdf["_t"].iloc[0])
        pdf = pdf.sort_values(["_h", id_col]).head(s)         # a hash order: no id is favoured
        x = pdf[[f"_x{i}" for i in range(k)]].to_numpy(dtype=float)
        rng = np.random.default_rng([seed, t])
        nodes = _grow(x, rng, max_depth)
        out = pd.DataFrame(nodes, columns=["node", "feature", "split", "left", "right", "size", "leaf"])
        out.insert(0, "tree", t)
        return out

    node_df = sampled.groupBy("_t").applyInPandas(grow, NODE_SCHEMA)
    return node_df.toPandas()   # bounded by n_trees x (2^(max_depth+1) - 1) rows


def score_isolation_forest(df: DataFrame, nodes: pd.DataFrame, feature_cols: Sequence[str],
                           sample_size: int = 256, keep: Sequence[str] = ("transaction_id",),
                           out: str = "anomaly_raw") -> DataFrame:
    """Raw outlier score 2^(-E[h(x)] / c(s)) per row (higher = more anomalous)."""
    trees = []
    for _, g in nodes.groupby("tree"):
        g = g.sort_values("node")
        trees.append((g["feature"].to_numpy(), g["split"].to_numpy(), g["left"].to_numpy(),
                      g["right"].to_numpy(), g["leaf"].to_numpy(),
                      np.array([c_factor(v) for v in g["size"].to_numpy()])))
    fitted = nodes.loc[nodes["node"] == 0, "size"]
    denom = c_factor(int(fitted.max()) if len(fitted) else sample_size)   # rows the trees were grown on
    keep = list(keep)
    feats = [F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(feature_cols)]
    src = df.select(*[F.col(c) for c in keep], *feats)
    k = len(feature_cols)
    schema = T.StructType([src.schema[c] for c in keep] + [T.StructField(out, T.DoubleType())])

    def score(it):
        for pdf in it:
            x = pdf[[f"_x{i}" for i in range(k)]].to_numpy(dtype=float)
            m = len(x)
            total = np.zeros(m)
            rows = np.arange(m)
            for feat, split, left, right, leaf, cadj in trees:
                node = np.zeros(m, dtype=np.int64)
                depth = np.zeros(m)
                active = ~leaf[node]
                while active.any():
                    f = feat[node[active]]
                    go_left = x[rows[active], f] < split[node[active]]
                    node[active] = np.where(go_left, left[node[active]], right[node[active]])
                    depth[active] += 1
                    active = ~leaf[node]
                total += depth + cadj[node]
            res = pdf[keep].copy()
            res[out] = np.power(2.0, -(total / len(trees)) / denom)
            yield res

    return src.mapInPandas(score, schema)


def anomaly_scores(train: DataFrame, score_df: DataFrame, feature_cols: Sequence[str], n_trees: int = 200,
                   sample_size: int = 256, seed: int = 0, keep: Sequence[str] = ("transaction_id",),
                   bounds: tuple[float, float] | None = None, nodes: pd.DataFrame | None = None) -> DataFrame:
    """M5: outlier score in [0, 1]; min-max over the scored frame unless
    ``bounds`` are given; all zero when the raw scores are constant.  Pass
    ``nodes`` (from ``fit_isolation_forest``) to score several frames with one
    fitted forest."""
    if nodes is None:
        nodes = fit_isolation_forest(train, feature_cols, n_trees, sample_size, seed, keep[0])
    raw = score_isolation_forest(score_df, nodes, feature_cols, sample_size, keep)
    if bounds is None:
        mm = raw.agg(F.min("anomaly_raw").alias("lo"), F.max("anomaly_raw").alias("hi"))
        s = mm.select(F.struct("lo", "hi").alias("b")).scalar()
        lo, hi = s.getField("lo"), s.getField("hi")
    else:
        lo, hi = F.lit(float(bounds[0])), F.lit(float(bounds[1]))
    scaled = F.when(hi > lo, (F.col("anomaly_raw") - lo) / (hi - lo)).otherwise(F.lit(0.0))
    return raw.withColumn("anomaly_score", F.least(F.greatest(scaled, F.lit(0.0)), F.lit(1.0)))
