"""Learned score M1-M4 and permutation importance M8.

M2/M3: one gradient-boosted-tree model per calibration fold (``boosting.train_folds``: all
folds side by side), each paired with an isotonic calibrator fitted on the fold it did not
see; the score is the mean of the calibrated probabilities.  Folds are a seeded hash of
(id, label), so every fold holds positives.  Spark's isotonic fit finishes in one task, so the
held-out margins are first reduced to at most ``calib_bins`` weighted quantile bins (a bounded
input whatever the table size).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerguard.operators import boosting
from ledgerguard.session import cut_lineage


def assemble(df: DataFrame, feature_cols: Sequence[str], out: str = "features") -> DataFrame:
    """M1: feature vector from the named columns (NULL/NaN is an error, as in
    the reference's dense matrix)."""
    va = VectorAssembler(inputCols=list(feature_cols), outputCol=out, handleInvalid="error")
    return va.transform(df.withColumns({c: F.col(c).cast("double") for c in feature_cols}))


def fold_of(id_col: str, label: str, k: int, seed: int) -> Column:
    return F.pmod(F.xxhash64(F.col(id_col), F.col(label), F.lit(seed)), F.lit(k)).cast("int")


@dataclass
class CalibratedScorer:
    feature_cols: list[str]
    models: list[boosting.BoostedTrees]
    #: (margins, probabilities) of each fold's isotonic steps
    calibrators: list[tuple[np.ndarray, np.ndarray]]
    params: dict = field(default_factory=dict)

    def probability(self, margins: Sequence[np.ndarray]) -> np.ndarray:
        """Mean calibrated probability from each model's margins (to nine places, so that sums of
        the same trees in another order give the same score)."""
        return np.mean([np.interp(np.round(m, 9), *steps) for m, steps in zip(margins, self.calibrators, strict=True)], axis=0)

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.probability(boosting.Walk(self.models).margins(x))

    def transform(self, df: DataFrame, out: str = "model_score") -> DataFrame:
        """M4: calibrated probability of fraud using the remembered feature list."""
        scorer = self

        @F.pandas_udf("double")
        def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            walk = boosting.Walk(scorer.models)
            for columns in batches:
                yield pd.Series(scorer.probability(walk.margins(_dense(columns))))

        return df.withColumn(out, score(*[F.col(c).cast("double") for c in self.feature_cols]))

    def importance(self) -> np.ndarray:
        """Share of each feature in the gain, averaged over the fold models."""
        return np.mean([m.importance() for m in self.models], axis=0)


def _dense(columns: Sequence[pd.Series]) -> np.ndarray:
    x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
    if np.isnan(x).any():
        raise ValueError("a feature is null or NaN")
    return x


def _isotonic(held: DataFrame, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Steps of the isotonic fit of ``label`` on ``margin``."""
    edges = held.approxQuantile("margin", [i / bins for i in range(1, bins)], 1.0 / (4 * bins))
    splits = [-float("inf")] + sorted(set(edges)) + [float("inf")]
    b = Bucketizer(splits=splits, inputCol="margin", outputCol="_bin")
    agg = (b.transform(held).groupBy("_bin")
           .agg(F.avg("margin").alias("m"), F.avg("label").alias("y"), F.count(F.lit(1)).cast("double").alias("w")))
    fit = IsotonicRegression(featuresCol="m", labelCol="y", weightCol="w", isotonic=True).fit(agg)
    return fit.boundaries.toArray(), fit.predictions.toArray()


def train_scorer(train: DataFrame, feature_cols: Sequence[str], label: str = "is_fraud",
                 id_col: str = "transaction_id", *, max_depth: int | None = 4, max_leaves: int = 31, step_size: float = 0.08,
                 max_iter: int = 250, min_instances: int = 20, l2: float = 1.0, max_bins: int = 255,
                 calib_cv: int = 3, calib_bins: int = 10_000, seed: int = 0) -> CalibratedScorer:
    """M2 + M3.  Trees and calibrators are fitted on all labelled rows."""
    cols = list(feature_cols)
    rows = cut_lineage(train.select(F.col(id_col), F.col(label).cast("int").alias(label), *[F.col(c).cast("double").alias(c) for c in cols]))
    fold = fold_of(id_col, label, calib_cv, seed)
    models = boosting.train_folds(
        rows, cols, label, fold, id_col, calib_cv, max_depth=max_depth,
        max_leaves=max_leaves, step_size=step_size, max_iter=max_iter, min_leaf=min_instances, l2=l2, bins=max_bins)

    @F.pandas_udf("double")
    def held_out(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        walks = [boosting.Walk([m]) for m in models]
        for f, *columns in batches:
            x, out = _dense(columns), np.zeros(len(f))
            for k, walk in enumerate(walks):
                mine = f.to_numpy() == k
                out[mine] = np.round(walk.margins(x[mine])[0], 9)
            yield pd.Series(out)

    held = cut_lineage(rows.select(fold.alias("fold"), F.col(label).cast("double").alias("label"), held_out(fold, *cols).alias("margin")))
    with ThreadPoolExecutor(calib_cv) as side_by_side:    # small jobs, each with a last task of its own
        steps = list(side_by_side.map(lambda k: _isotonic(held.where(F.col("fold") == k), calib_bins), range(calib_cv)))
    return CalibratedScorer(cols, models, steps, dict(
        max_depth=max_depth, max_leaves=max_leaves, step_size=step_size, max_iter=max_iter, min_instances=min_instances,
        l2=l2, calib_cv=calib_cv, seed=seed))


def _variant_task(scorer: CalibratedScorer, names: tuple[str, str]):
    """(feature, score, label) of every row and feature, with the feature's value from elsewhere.

    A row's leaf masks are kept per tree, and only the replaced feature's are looked up again, in
    the trees that split on it (``boosting.Walk.replaced``)."""
    width = len(scorer.feature_cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = boosting.Walk(scorer.models)
        for b in batches:
            if not b.num_rows:
                continue
            own, other = (_dense([b.column(f"{n}{i}").to_pandas() for i in range(width)]) for n in names)
            label = b.column("label")
            for i, margins in enumerate(walk.replaced(own, other)):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), i, dtype=np.int32)), pa.array(scorer.probability(margins)), label],
                                                 names=["_fi", "s", "label"])
    return run


def rescored_by_trees(scorer: CalibratedScorer):
    """``permutation_importance``'s scorer of permuted rows by the margins of the trees."""
    def rescore(both: DataFrame, label: str) -> DataFrame:
        width = len(scorer.feature_cols)
        rows = both.select(F.col(label).cast("long").alias("label"),
                           *[F.col(c).cast("double").alias(f"o{i}") for i, c in enumerate(scorer.feature_cols)],
                           *[F.col(f"_p{i}").cast("double").alias(f"p{i}") for i in range(width)])
        return rows.mapInArrow(_variant_task(scorer, ("o", "p")), "_fi int, s double, label long").withColumnRenamed("label", label)
    return rescore


def rescored_by_function(score_fn, cols: Sequence[str]):
    """The same by any score function: a copy of the rows per feature."""
    def rescore(both: DataFrame, label: str) -> DataFrame:
        each = both.withColumn("_fi", F.explode(F.array(*[F.lit(i) for i in range(len(cols))])))
        variant = each.select(label, "_fi", *[F.when(F.col("_fi") == i, F.col(f"_p{i}")).otherwise(F.col(c)).alias(c)
                                              for i, c in enumerate(cols)])
        return score_fn(variant).select("_fi", F.col("model_score").alias("s"), F.col(label))
    return rescore


def permutation_importance(scorer, df: DataFrame, feature_cols: Sequence[str], repeats: int = 6,
                           seed: int = 0, label: str = "is_fraud", id_col: str = "transaction_id") -> DataFrame:
    """M8: drop in average precision when one feature's values are permuted.

    A repeat's permutation is one of the whole table: rows are ranked by id and by a seeded
    hash (two distributed ranks of a narrow projection), and the row at a place of the first
    order takes the values of the row at the same place of the second.  Neither rank depends
    on the number of partitions.  A repeat gives one score per row and feature, with only that
    feature's value replaced: a ``CalibratedScorer`` keeps its trees' margins and walks only the
    trees that split on the feature, any other function (frame -> frame with ``model_score``)
    scores a copy of the rows per feature.  The average precision of all variants comes from one
    grouped global-order pass over their value counts.
    """
    from functools import reduce

    from ledgerguard.operators.evaluation import average_precision
    from ledgerguard.operators.ordering import POS, global_cumulative

    spark = df.sparkSession
    cols = list(feature_cols)
    by_trees = isinstance(scorer, CalibratedScorer)
    rescore = rescored_by_trees(scorer) if by_trees else rescored_by_function(scorer, cols)
    score_fn = scorer.transform if by_trees else scorer
    base = cut_lineage(df.select(F.col(id_col), F.col(label), *[F.col(c) for c in cols]))
    own = cut_lineage(global_cumulative(base, [F.col(id_col)], keep=base.columns))
    counts = []
    for rep in range(repeats):
        order = F.xxhash64(F.col(id_col), F.lit(seed), F.lit(rep))
        values = base.select(order.alias("_o"), F.col(id_col), *[F.col(c).alias(f"_p{i}") for i, c in enumerate(cols)])
        other = global_cumulative(values, [F.col("_o"), F.col(id_col)], keep=[f"_p{i}" for i in range(len(cols))])
        scored = rescore(own.join(other, POS), label).withColumn("_rep", F.lit(rep))
        counts.append(cut_lineage(scored.groupBy("_fi", "_rep", "s").agg(F.count(F.lit(1)).alias("n"),
                                                                         F.sum(label).alias("pos"))))
    vc = reduce(DataFrame.unionByName, counts).withColumn("_var", F.col("_fi") * F.lit(1000) + F.col("_rep"))
    # average precision per variant: value counts per (variant, score), ordered by score descending
    cum = global_cumulative(vc, [F.col("_var"), F.col("s").desc()], {"n": F.col("n"), "pos": F.col("pos")},
                            keep=["_var", "pos"], group="_var")
    tot = vc.groupBy("_fi", "_rep", "_var").agg(F.sum("pos").alias("P"))
    ap = (cum.groupBy("_var").agg(F.sum(F.col("pos") * (F.col("cum_pos") / F.col("cum_n"))).alias("_s"))
          .join(tot, "_var").select("_fi", "_rep", F.when(F.col("P") > 0, F.col("_s") / F.col("P")).alias("ap")))
    base_ap = average_precision(score_fn(base).withColumn("score", F.col("model_score")), "score", label)
    names = spark.createDataFrame(list(enumerate(cols)), "_fi int, feature string")
    drops = ap.select("_fi", (base_ap.select("pr_auc").scalar() - F.col("ap")).alias("drop"))
    out = drops.groupBy("_fi").agg(F.avg("drop").alias("importance_mean"), F.stddev_pop("drop").alias("importance_std"))
    return out.join(F.broadcast(names), "_fi").select("feature", "importance_mean", "importance_std") \
              .orderBy(F.desc("importance_mean"), F.asc("feature"))
