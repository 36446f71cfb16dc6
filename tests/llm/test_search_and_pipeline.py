"""Projection forest against brute force; the pipeline's stages; registration."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerguard.llm import projection_forest, queries
from ledgerguard.llm.common import store

SF = "/root/testdata/sf0.01"


def brute(ids, vectors, queries_, top):
    out = {}
    for q in queries_:
        score = (vectors * vectors[ids.index(q)]).sum(axis=1)
        order = sorted((-s, i) for s, i in zip(score.tolist(), ids, strict=True) if i != q)[:top]
        out[q] = [(i, -s) for s, i in order]
    return out


def as_lists(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out.get(r["query_id"], ())) + 1
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def test_forest_is_exact_when_all_leaves_are_opened(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 8))
    x[40:120] = x[40]                      # many equal vectors
    ids = list(range(300))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>")
    df = df.withColumn("leaf", F.lit("clash")).withColumn("id", F.lit("clash")).repartition(4)
    got = as_lists(projection_forest.nearest(df, top=20, leaf_sample=8, first_rows=10 ** 6, block_rows=16).collect())
    want = brute(ids, x, range(0, 300, 20), 20)
    assert {q: [i for i, _ in r] for q, r in got.items()} == {q: [i for i, _ in r] for q, r in want.items()}
    assert all(abs(a[1] - b[1]) < 1e-12 for q in got for a, b in zip(got[q], want[q], strict=True))


def test_forest_recall(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 16)) * rng.uniform(0.5, 2, size=(4000, 1))
    ids = list(range(4000))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>")
    got = as_lists(projection_forest.nearest(df, top=20, leaf_sample=32, first_rows=500).collect())
    want = brute(ids, x, range(0, 4000, 20), 20)
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert len(got) == 200 and np.mean(hits) >= 0.9
    assert all(r == sorted(r, key=lambda p: (-p[1], p[0])) for r in got.values())


@pytest.mark.parametrize("kind, most", [("clustered", 0.4), ("skewed", 1.3)])
def test_recall_and_rows_read(kind, most):
    """20,000 vectors: recall against brute force, and rows opened as a share of the table."""
    rng = np.random.default_rng(2)
    n, d = 20_000, 32
    x = rng.normal(size=(n, d))
    if kind == "clustered":
        x = rng.normal(size=(300, d))[rng.integers(0, 300, n)] + 0.2 * x
    x = x / np.linalg.norm(x, axis=1)[:, None] * (np.exp(0.7 * rng.normal(size=(n, 1))) if kind == "skewed" else 1)
    longest = np.linalg.norm(x, axis=1).max()
    unit = x / longest
    lifted = np.c_[unit, np.sqrt(np.maximum(0, 1 - (unit * unit).sum(axis=1)))].astype(np.float32)
    forest = projection_forest.Forest(lifted[:10_000], 16, 128)
    leaf = forest.leaves_of(lifted)
    sizes = np.bincount(leaf.ravel(), minlength=forest.leaves).tolist()
    hits, read = [], []
    for q in range(0, n, 400):
        score = x @ x[q]
        score[q] = -np.inf
        length = np.linalg.norm(x[q])
        query = np.r_[x[q] / length, 0].astype(np.float32)
        rows = lambda leaves: np.flatnonzero(np.isin(leaf, leaves).any(axis=1))
        worst = np.sort(score[rows(forest.search(query, sizes, 4_000))])[-20]
        reach = 0.5 / np.sqrt(d) * np.sqrt(max(0.0, 2 - 2 * worst / (length * longest)))
        opened = forest.search(query, sizes, 4_000, int(1.25 * n), reach)
        found = rows(opened)
        best = found[np.argsort(-score[found])[:20]]
        hits.append(len(set(best.tolist()) & set(np.argsort(-score)[:20].tolist())) / 20)
        read.append(sum(sizes[k] for k in opened) / n)
    assert np.mean(hits) >= 0.9 and np.mean(read) <= most


def test_recall_on_the_test_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.collect()
    ids, x = [r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows], dtype=float)
    got = as_lists(projection_forest.nearest(df).collect())
    want = brute(ids, x, sorted(i for i in ids if i % 20 == 0), 20)
    assert got.keys() == want.keys()
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9


def test_forest_edges(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [1.0, None]), (4, [float("nan"), 1.0]),
            (5, [float("inf"), 1.0]), (6, [2.0, 1.0]), (None, [3.0, 1.0]), (20, [-1.0, 0.0]), (40, [0.0, 0.0]), (7, [1.0]),
            (6, [2.0, 1.0]), (8, [2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = as_lists(projection_forest.nearest(df).collect())
    assert got == {0: [(6, 2.0), (8, 2.0), (20, -1.0)], 20: [(0, -1.0), (6, -2.0), (8, -2.0)]}
    assert projection_forest.nearest(df.limit(0)).count() == 0


# ------------------------------------------------------------------ pipeline

@pytest.fixture(scope="module")
def staged(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(store(stage(spark, frames[-1], SF), f"test-{name}"))
    return frames


def test_stages_keep_columns_and_documents(staged):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "simhash_near_dedup", "suffix_dedup",
                                                     "packing"]
    assert all(f.schema.names == staged[0].schema.names for f in staged[1:-1])
    ids = [sorted(r["doc_id"] for r in f.select("doc_id").collect()) for f in staged]
    assert len(ids[1]) >= 0.98 * len(ids[0])          # documents with a language stay
    assert ids[2] == ids[1] and ids[4] == ids[3] == ids[5] and set(ids[3]) <= set(ids[2])


def test_near_copies_leave_one_document(staged):
    from test_dedup_ops import brute_components, brute_simhash

    rows = sorted(staged[2].collect(), key=lambda r: r["doc_id"])
    roots = brute_components(brute_simhash([r["text"] for r in rows]))
    want = sorted(rows[i]["doc_id"] for i in set(roots))
    assert sorted(r["doc_id"] for r in staged[3].select("doc_id").collect()) == want


def test_text_stages_change_texts_as_their_operators(staged):
    from test_dedup_ops import brute_lines, brute_repeats
    import hashlib

    before = sorted(staged[1].collect(), key=lambda r: r["doc_id"])
    want = brute_lines([r["text"] for r in before], [r["doc_id"] for r in before])
    assert {r["doc_id"]: r["text"] for r in staged[2].collect()} == want
    before = sorted(staged[3].collect(), key=lambda r: r["doc_id"])
    want = {d: sha for d, _, _, _, sha in brute_repeats([r["text"] for r in before], [r["doc_id"] for r in before], 50)}
    got = {r["doc_id"]: r["text"] for r in staged[4].collect()}
    exact = sum(hashlib.sha256(t.encode()).hexdigest() == want[d] for d, t in got.items())
    assert exact >= 0.95 * len(got)                   # others end inside a character, which goes whole
    assert all(r["n_chars"] == len(r["text"]) for r in staged[4].collect())


def test_stages_on_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, None, None), (None, "the cat sat on the mat", "en", None, 22), (2, "", "en", "a", 0),
            (2, "", "en", "a", 0), (3, "the cat sat on the mat", None, "a", 22), (3, "the cat sat on the mat", "en", "a", 22)]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).collect()
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_every_operator_is_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names
    assert set(queries.ORACLES) <= set(queries.QUERIES)
