"""Learned score and outlier score invariants."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerguard.operators import anomaly, boosting, model


def _frame(spark, n=600, seed=0):
    rng = np.random.default_rng(seed)
    x1 = rng.normal(0, 1, n)
    x2 = rng.normal(0, 1, n)
    y = (x1 + 0.3 * rng.normal(0, 1, n) > 1.2).astype(int)
    rows = [(i, float(a), float(b), int(c)) for i, (a, b, c) in enumerate(zip(x1, x2, y))]
    return spark.createDataFrame(rows, "transaction_id long, x1 double, x2 double, is_fraud int")


def test_permutation_importance_only_used_feature_matters(spark):
    df = _frame(spark)
    score_fn = lambda d: d.withColumn("model_score", F.col("x1"))
    imp = {r["feature"]: r for r in model.permutation_importance(score_fn, df, ["x1", "x2"], repeats=3).collect()}
    assert imp["x1"]["importance_mean"] > 0.2
    assert imp["x2"]["importance_mean"] == pytest.approx(0.0, abs=1e-12)


def test_calibrated_scorer_invariants(spark):
    df = _frame(spark, 900)
    sc = model.train_scorer(df, ["x1", "x2"], max_iter=10, min_instances=5)
    out = sc.transform(df)
    s = out.agg(F.min("model_score").alias("lo"), F.max("model_score").alias("hi"),
                F.avg("model_score").alias("m"), F.avg("is_fraud").alias("rate")).first()
    assert 0.0 <= s["lo"] <= s["hi"] <= 1.0
    assert abs(s["m"] - s["rate"]) < 0.05              # calibrated mean close to the base rate
    again = model.train_scorer(df, ["x1", "x2"], max_iter=10, min_instances=5).transform(df)
    a = {r[0]: r[1] for r in out.select("transaction_id", "model_score").collect()}
    b = {r[0]: r[1] for r in again.select("transaction_id", "model_score").collect()}
    assert a == b                                      # same seed, same output


def test_trees_follow_plain_newton_boosting(spark):
    """Two folds against a direct implementation over all rows and cuts."""
    rng = np.random.default_rng(3)
    x = rng.integers(0, 12, size=(400, 3)).astype(float)
    y = (x[:, 0] + x[:, 1] * (x[:, 2] > 5) + rng.normal(size=400) > 9).astype(int)
    rows = [(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame(rows, "transaction_id long, a double, b double, c double, is_fraud int").repartition(3)
    fold = F.pmod(F.col("transaction_id"), F.lit(2)).cast("int")
    models = boosting.train_folds(df, ["a", "b", "c"], "is_fraud", fold, "transaction_id", 2, max_depth=3, max_leaves=31,
                                  step_size=0.3, max_iter=5, min_leaf=10, l2=1.0)
    for f in range(2):
        mine = np.arange(400) % 2 != f
        xs, ys = x[mine], y[mine]
        margin, whole = np.full(len(xs), np.log(ys.mean() / (1 - ys.mean()))), np.full(400, np.log(ys.mean() / (1 - ys.mean())))
        for _ in range(5):
            p = 1 / (1 + np.exp(-margin))
            g, h = p - ys, p * (1 - p)

            def grow(own, out, depth):
                best = None
                for j in range(3):
                    for cut in np.unique(xs[:, j])[:-1]:
                        left, right = own & (xs[:, j] <= cut), own & (xs[:, j] > cut)
                        if min(left.sum(), right.sum()) >= 10 and min(h[left].sum(), h[right].sum()) >= 1e-3:
                            gain = sum(g[s].sum() ** 2 / (h[s].sum() + 1) * w for s, w in ((left, 1), (right, 1), (own, -1)))
                            if best is None or gain > best[0] + 1e-9 * abs(best[0]):
                                best = (gain, j, cut)
                if depth == 3 or best is None or best[0] <= 1e-12:
                    return np.where(out, -0.3 * g[own].sum() / (h[own].sum() + 1) if depth else 0.0, 0.0)
                _, j, cut = best
                return (grow(own & (xs[:, j] <= cut), out & (x[:, j] <= cut), depth + 1)
                        + grow(own & (xs[:, j] > cut), out & (x[:, j] > cut), depth + 1))
            step = grow(np.ones(len(xs), dtype=bool), np.ones(400, dtype=bool), 0)
            whole, margin = whole + step, margin + step[mine]
        assert np.allclose(models[f].margin(x), whole, atol=1e-8)


def test_many_blocks_give_the_trees_of_one(spark, monkeypatch):
    df = _frame(spark, 900)
    fold = model.fold_of("transaction_id", "is_fraud", 3, 0)
    how = dict(max_depth=3, max_leaves=31, step_size=0.2, max_iter=6, min_leaf=15, l2=1.0)
    x = df.toPandas()[["x1", "x2"]].to_numpy()
    one = boosting.train_folds(df, ["x1", "x2"], "is_fraud", fold, "transaction_id", 3, **how)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 120)
    monkeypatch.setattr(boosting, "CHECKPOINT_ROUNDS", 2)
    many = boosting.train_folds(df, ["x1", "x2"], "is_fraud", fold, "transaction_id", 3, **how)
    for a, b in zip(one, many, strict=True):
        assert len(a.trees) == len(b.trees) == 6 and np.allclose(a.margin(x), b.margin(x), atol=1e-9)


def test_leaf_cap_minimum_and_bounded_rows(spark):
    df = _frame(spark, 900)
    fold = model.fold_of("transaction_id", "is_fraud", 2, 0)
    how = dict(step_size=0.1, max_iter=4, min_leaf=15, l2=1.0)
    models = boosting.train_folds(df, ["x1", "x2"], "is_fraud", fold, "transaction_id", 2, max_depth=None, max_leaves=6, **how)
    rows = df.withColumn("f", fold).toPandas()
    for f, m in enumerate(models):
        x = rows.loc[rows["f"] != f, ["x1", "x2"]].to_numpy()
        for t in m.trees:
            assert sum(k < 0 for k in t.feature) <= 6
            assert np.bincount(t.leaf_of(x, t.cut))[[i for i, k in enumerate(t.feature) if k < 0]].min() >= 15
    few = boosting.bounded_rows(df, "transaction_id", 200, 0).count()
    assert 140 < few < 260 and boosting.bounded_rows(df, "transaction_id", 900, 0) is df


def test_a_null_feature_is_an_error(spark):
    df = _frame(spark, 100).withColumn("x2", F.when(F.col("transaction_id") != 7, F.col("x2")))
    with pytest.raises(Exception, match="null or NaN"):
        model.train_scorer(df, ["x1", "x2"], max_iter=2, min_instances=5)


def test_importance_by_tree_margins_equals_the_plain_form(spark):
    df = _frame(spark, 500)
    sc = model.train_scorer(df, ["x1", "x2"], max_iter=15, min_instances=5)
    by_trees = {r["feature"]: r for r in model.permutation_importance(sc, df, ["x1", "x2"], repeats=2).collect()}

    def plain(d):          # scores rounded as the margins of the trees are
        return sc.transform(d)
    by_copies = {r["feature"]: r for r in model.permutation_importance(plain, df, ["x1", "x2"], repeats=2).collect()}
    for c in ("x1", "x2"):
        assert by_trees[c]["importance_mean"] == pytest.approx(by_copies[c]["importance_mean"], abs=1e-6)
    assert sc.importance()[0] > 0.5 and sc.importance().sum() == pytest.approx(1)


def test_registered_queries_end_with_the_references_rounds(spark):
    """All of m2, m3, m4, m8 and the card review to the end, on one model of 250 rounds."""
    import __spark_entry__
    from ledgerguard.plans import demo_runs, model_queries
    assert (model_queries.QUERY_MAX_ITER, demo_runs.WIDE_MAX_ITER) == (250, 300)
    queries = __spark_entry__.queries()
    sf = __spark_entry__.SF_SMOKE
    rows = {n: queries[n](spark, sf).count() for n in (
        "m2_gbt_importance", "m3_calibrated_valid", "m4_score_test", "m8_permutation_importance", "run_card_review", "run_card_queue")}
    scorer = model_queries._SCORERS[spark.sparkContext.applicationId, sf]
    assert scorer.params["max_iter"] == 250 and max(len(m.trees) for m in scorer.models) == 250
    assert rows["m2_gbt_importance"] == rows["m8_permutation_importance"] == len(scorer.feature_cols)
    assert rows["m3_calibrated_valid"] > 0 and rows["m4_score_test"] > 0
    assert rows["run_card_review"] == 1 and rows["run_card_queue"] == 10


def test_isolation_forest_ranks_planted_outlier_first(spark):
    rng = np.random.default_rng(1)
    rows = [(i, float(v), float(w)) for i, (v, w) in enumerate(zip(rng.normal(0, 1, 2000), rng.normal(0, 1, 2000)))]
    rows.append((99999, 12.0, -12.0))
    df = spark.createDataFrame(rows, "transaction_id long, a double, b double")
    s = anomaly.anomaly_scores(df, df, ["a", "b"], n_trees=50)
    top = s.orderBy(F.desc("anomaly_score")).first()
    assert top["transaction_id"] == 99999 and top["anomaly_score"] == 1.0
    assert s.agg(F.min("anomaly_score")).first()[0] == 0.0


def test_isolation_forest_frozen_bounds(spark):
    rng = np.random.default_rng(2)
    rows = [(i, float(v), float(w)) for i, (v, w) in enumerate(zip(rng.normal(0, 1, 500), rng.normal(0, 1, 500)))]
    df = spark.createDataFrame(rows, "transaction_id long, a double, b double")
    free = anomaly.anomaly_scores(df, df, ["a", "b"], n_trees=20)
    lo, hi = free.agg(F.min("anomaly_raw"), F.max("anomaly_raw")).first()
    frozen = anomaly.anomaly_scores(df, df.limit(10), ["a", "b"], n_trees=20, bounds=(lo, hi))
    f = {r[0]: r[1] for r in free.select("transaction_id", "anomaly_score").collect()}
    for r in frozen.select("transaction_id", "anomaly_score").collect():
        assert r[1] == pytest.approx(f[r[0]])           # batch-independent with frozen bounds


def test_shared_codes_and_masks_follow_the_walk_of_the_trees(spark):
    """Margins by bit masks, with replaced features too, equal the walk; sums per shared code equal plain sums."""
    rng = np.random.default_rng(5)
    x = np.stack([rng.normal(size=500), rng.integers(0, 2, 500), rng.integers(0, 3, 500), np.zeros(500)], axis=1)
    edges = [np.unique(np.quantile(c, np.arange(1, 20) / 20)) for c in x.T]
    layout = boosting.Layout([e if len(np.unique(c)) > 1 else e[:0] for e, c in zip(edges, x.T, strict=True)])
    assert layout.live == [0, 1, 2] and sum(map(len, layout.columns)) == 3 and len(layout.columns) < 3
    tree, cut = boosting.Tree(), lambda f, b: float(layout.edges[f][b])
    a, b = tree.split(0, 0, 7, cut(0, 7), 1.0, (0.0, 0.0))
    c, d = tree.split(a, 1, 0, cut(1, 0), 1.0, (0.5, 0.0))
    tree.split(d, 0, 3, cut(0, 3), 1.0, (1.5, 2.5))
    tree.split(b, 2, 1, cut(2, 1), 1.0, (3.5, 4.5))
    bins = [np.searchsorted(e, v) for e, v in zip(layout.edges, x.T, strict=True)]
    codes = layout.pack(bins)
    nodes, leaf = layout.leaves(tree, codes)
    assert (np.array(nodes)[leaf] == tree.leaf_of(x, tree.cut)).all()
    wide = boosting.Tree()                        # above 16 leaves
    for i, k in enumerate([0] + list(range(2, 40, 2))):
        wide.split(k, 0, 18 - i if i < 19 else 0, cut(0, max(0, 18 - i)), 1.0, (float(i), -float(i)))
    models = [boosting.BoostedTrees(0.25, [tree, wide, boosting.Tree()], 4)]
    walk = lambda z: 0.25 + tree.margin(z) + wide.margin(z)
    assert np.allclose(models[0].margin(x), walk(x), atol=1e-12)
    other = x[::-1]
    for f, (margin,) in enumerate(boosting.Walk(models).replaced(x, other)):
        z = x.copy()
        z[:, f] = other[:, f]
        assert np.allclose(margin, walk(z), atol=1e-12)
    y, used, margins = (x[:, 0] > 1).astype(np.int8), np.ones((1, 500), dtype=bool), np.zeros((1, 500))
    sums = next(boosting._leaf_sums([tree], [[c]], layout)([([0], codes, y, used, margins)]))
    own = tree.leaf_of(x, tree.cut) == c
    for i, f in enumerate(layout.live):
        got = sums[:, 0, layout.offsets[i]:layout.offsets[i + 1]]
        for row, w in zip(got, (0.5 - y, np.full(500, 0.25), np.ones(500)), strict=True):
            assert np.allclose(row, np.bincount(bins[f][own], w[own], layout.sizes[f]))


def test_a_training_of_many_blocks_sends_the_driver_candidates_only(spark, monkeypatch):
    df = _frame(spark, 900)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 120)
    state = spark.sparkContext.parallelize([([0], np.zeros((2, 4), np.uint16), np.zeros(4, np.int8), np.ones((1, 4), bool), np.zeros((1, 4)))] * 3, 3)
    layout = boosting.Layout([np.arange(200.0), np.arange(200.0)])
    growth = boosting.Growth(layout, 2, 4, 0.1, 1, 1.0)
    found = boosting._splits_of_blocks(growth, state, [])([boosting.Tree()], boosting.Level([[0]], 1, [(0, 0)], []))
    assert found == [None]                        # a leaf of one bin: no sums come back
    models = boosting.train_folds(df, ["x1", "x2"], "is_fraud", model.fold_of("transaction_id", "is_fraud", 2, 0), "transaction_id", 2,
                                  max_depth=None, max_leaves=8, step_size=0.2, max_iter=3, min_leaf=15, l2=1.0)
    assert all(len(m.trees) == 3 for m in models)


def test_rows_of_several_blocks_are_one_task_of_each_fold(spark, monkeypatch):
    """Up to FOLD_BLOCKS blocks no level is a job of its own, and the trees are those of one block and of many."""
    rng = np.random.default_rng(11)
    x = np.stack([rng.normal(size=900), rng.integers(0, 300, 900), rng.integers(0, 3, 900), rng.normal(size=900)], axis=1)
    y = (x[:, 0] + x[:, 1] / 150 + (x[:, 2] > 1) * x[:, 3] > 1.4).astype(int)
    rows = [(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))]
    cols = ["a", "b", "c", "d"]
    df = spark.createDataFrame(rows, "transaction_id long, a double, b double, c double, d double, is_fraud int")
    fold = model.fold_of("transaction_id", "is_fraud", 2, 0)
    how = dict(max_depth=None, max_leaves=12, step_size=0.2, max_iter=5, min_leaf=15, l2=1.0)
    monkeypatch.setattr(boosting, "ROUNDS_A_JOB", 3)
    monkeypatch.setattr(boosting, "LEAST_BLOCK_ROWS", 200)
    found = []
    for block_rows, cells in ((1_000_000, 150_000_000), (200, 150_000_000), (200, 100)):
        with monkeypatch.context() as m:
            m.setattr(boosting, "BLOCK_ROWS", block_rows)
            m.setattr(boosting, "FOLD_CELLS", cells)
            if cells > 100:
                m.setattr(boosting, "_splits_of_blocks", None)
            found.append(boosting.train_folds(df, cols, "is_fraud", fold, "transaction_id", 2, **how))
    for one, several, many in zip(*found, strict=True):
        assert len(one.trees) == len(several.trees) == len(many.trees) == 5
        assert np.allclose(one.margin(x), several.margin(x), atol=1e-9) and np.allclose(one.margin(x), many.margin(x), atol=1e-9)
        assert one.trees[0].feature == several.trees[0].feature == many.trees[0].feature


def test_a_folds_rows_lie_side_by_side_and_are_summed_by_ranges(monkeypatch):
    """Rows picked from codes by row are the columns' codes, and sums of several ranges those of all rows."""
    rng = np.random.default_rng(4)
    x = rng.integers(0, 255, (700, 6)).astype(float)
    layout = boosting.Layout([np.arange(n) + 0.5 for n in (2, 254, 3, 200, 40, 1)])
    codes = layout.pack([np.searchsorted(e, x[:, f]) for f, e in enumerate(layout.edges)])
    monkeypatch.setattr(boosting, "ROWS_AT_ONCE", 64)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 150)
    leaves = boosting.Leaves(layout, boosting._by_row(codes))
    some = rng.permutation(700)[:333]
    assert np.array_equal(leaves.columns(some), codes[:, some])
    tree = boosting.Tree()
    tree.split(0, 1, 90, 90.5, 1.0, (0.0, 0.0))
    leaves.follow(tree)
    left = x[:, 1] <= 90.5
    assert np.array_equal(leaves.rows[1], np.flatnonzero(left)) and np.array_equal(leaves.rows[2], np.flatnonzero(~left))
    w = rng.random(700)
    sums = leaves.sums([2, 1], (w, 2 * w))
    for f, (a, b) in enumerate(zip(layout.offsets[:-1], layout.offsets[1:], strict=True)):
        bins = np.searchsorted(layout.edges[layout.live[f]], x[:, layout.live[f]])
        for node, own in ((0, ~left), (1, left)):
            assert np.allclose(sums[0, node, a:b], np.bincount(bins[own], w[own], b - a))
            assert np.allclose(sums[1, node, a:b], np.bincount(bins[own], 2 * w[own], b - a))
            assert np.array_equal(sums[2, node, a:b], np.bincount(bins[own], minlength=b - a))


def test_rows_of_one_block_are_packed_by_as_many_tasks_as_there_are_cores(spark, monkeypatch):
    """Rows of a fold's task are put into bins by several tasks, also below BLOCK_ROWS."""
    dealt, blocks = [], boosting._blocks
    monkeypatch.setattr(boosting, "LEAST_BLOCK_ROWS", 200)
    monkeypatch.setattr(boosting, "_blocks", lambda *a: dealt.append(a[-1]) or blocks(*a))
    boosting.train_folds(_frame(spark, 900), ["x1", "x2"], "is_fraud", model.fold_of("transaction_id", "is_fraud", 2, 0), "transaction_id", 2,
                         max_depth=2, max_leaves=4, step_size=0.2, max_iter=1, min_leaf=15, l2=1.0)
    assert dealt == [min(spark.sparkContext.defaultParallelism, 4)]


def test_all_labelled_rows_grow_the_trees(spark, monkeypatch):
    """A table that counts more than 4,000,000 rows is not thinned before the trees are grown."""
    df, taken, train = _frame(spark, 300), [], boosting.train_folds
    frame = type(df)
    count, collect = frame.count, frame.collect

    def grow(rows, *a, **how):
        taken.append(sorted(r["transaction_id"] for r in collect(rows.select("transaction_id"))))
        return train(rows, *a, **how)
    monkeypatch.setattr(boosting, "train_folds", grow)
    monkeypatch.setattr(frame, "count", lambda self: 20_000 * count(self))
    model.train_scorer(df, ["x1", "x2"], max_iter=2, min_instances=5)
    assert taken == [list(range(300))]


def test_a_training_above_five_blocks_needs_no_job_for_each_level(spark, monkeypatch):
    """Rows of eight blocks are still one task of each fold, put into bins once, and give the trees of one block."""
    df, fold = _frame(spark, 900), model.fold_of("transaction_id", "is_fraud", 2, 0)
    how = dict(max_depth=None, max_leaves=8, step_size=0.2, max_iter=4, min_leaf=15, l2=1.0)
    x = df.toPandas()[["x1", "x2"]].to_numpy()
    one = boosting.train_folds(df, ["x1", "x2"], "is_fraud", fold, "transaction_id", 2, **how)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 120)
    monkeypatch.setattr(boosting, "_splits_of_blocks", None)
    monkeypatch.setattr(boosting.RDD, "zipWithIndex", None)       # a pass over all blocks only to number them
    several = boosting.train_folds(df, ["x1", "x2"], "is_fraud", fold, "transaction_id", 2, **how)
    for a, b in zip(one, several, strict=True):
        assert [t.feature for t in a.trees] == [t.feature for t in b.trees] and np.allclose(a.margin(x), b.margin(x), atol=1e-9)


def test_sums_over_all_rows_by_wider_columns_are_those_of_the_rows_picked(monkeypatch):
    """Root sums from the columns of several features, and leaves divided by them, follow the plain codes."""
    rng = np.random.default_rng(8)
    monkeypatch.setattr(boosting, "ROWS_AT_ONCE", 100)
    x = rng.integers(0, 300, (900, 5)).astype(float)
    layout = boosting.Layout([np.arange(n) + 0.5 for n in (3, 250, 30, 26, 1)])
    codes = boosting._by_row(layout.pack([np.searchsorted(e, x[:, f]) for f, e in enumerate(layout.edges)]))
    wide, whole = layout.wider(codes)
    assert len(wide.columns) < len(layout.columns) and max(wide.codes) <= boosting.WHOLE_CODES
    leaves, plain = boosting.Leaves(layout, codes, (wide, whole)), boosting.Leaves(layout, codes)
    w = rng.random(900)
    tree = boosting.Tree()
    assert np.allclose(leaves.sums([0], (w, 3 * w)), plain.sums([0], (w, 3 * w)))
    for node, f, b in ((0, 2, 17), (1, 1, 100), (2, 0, 1)):
        tree.split(node, f, b, float(b), 1.0, (0.0, 0.0))
        for own in (leaves, plain):
            own.follow(tree)
    assert sorted(leaves.rows) == sorted(plain.rows) == [3, 4, 5, 6]
    for node in leaves.rows:
        assert np.array_equal(leaves.rows[node], plain.rows[node])
    assert np.allclose(leaves.sums([6, 3, 5], (w, 3 * w)), plain.sums([6, 3, 5], (w, 3 * w)))
    leaves.start()
    assert np.allclose(leaves.sums([0], (w, 3 * w))[2].sum(), 900 * len(layout.live))


def test_a_folds_rows_in_parts_give_the_trees_of_one_part(spark, monkeypatch):
    """Cores without a fold take parts of a fold's rows; their processes end with the job's rounds."""
    import multiprocessing
    rng = np.random.default_rng(12)
    x = rng.integers(0, 60, (900, 3)).astype(float)
    y = (x[:, 0] + x[:, 1] * (x[:, 2] > 20) + rng.normal(0, 9, 900) > 70).astype(np.int8)
    layout = boosting.Layout([np.arange(59.0)] * 3)
    growth = boosting.Growth(layout, None, 12, 0.2, 15, 1.0)
    codes = boosting._by_row(layout.pack([np.searchsorted(e, x[:, f]) for f, e in enumerate(layout.edges)]))
    monkeypatch.setattr(boosting, "PART_ROWS", 250)
    found = [next(boosting._rounds_of_a_fold(growth, 4, cores)(iter([(0, codes, y, np.zeros(900))]))) for cores in (1, 3)]
    (_, _, _, one), trees = found[0]
    (_, _, _, several), others = found[1]
    assert [t.feature for t in trees] == [t.feature for t in others] and len(trees[0].feature) > 3
    assert np.allclose(one, several, atol=1e-9) and not multiprocessing.active_children()
    parts = boosting.Parts(layout, codes, y, np.zeros(900), 3)
    with pytest.raises(RuntimeError, match="KeyError"), parts:
        parts.first.sums = lambda *a: None
        parts.call("sums", boosting.Tree(), [7])
    assert not multiprocessing.active_children()
