"""Chat windows, centroid bounds and part codes against brute force, and their defined cases."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerguard.llm import centroid_bounds, chat_windows, part_trie, queries
from ledgerguard.llm.common import attach_totals

SF = "/root/testdata/sf0.01"
TURNS = "conv_id long, turn long, role string, text string"
BITS = ["a", "bc ", "<|im_end|>", "<|im_start|>", "<", "\\", "|", "<\\|", "\n", "%0A", "%", "é", "🙂", " word", "1234"]


def odd_text(rng, most=12):
    return "".join(rng.choice(BITS) for _ in range(rng.randrange(most)))


def expected(rows):
    """Per conversation: turns, digest of all, digest of the assistant's, as the contract says."""
    talks = {}
    low = (0, 0)
    for c, t, role, text in sorted(rows, key=lambda r: (low if r[1] is None else (1, r[1]), r[2] or "", r[3] or "")):
        talks.setdefault(c, []).append((role or "", text or ""))
    out = {}
    for c, said in talks.items():
        learned = "".join(t for r, t in said if r == "assistant")
        out[c] = (len(said), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest(), len(learned),
                  hashlib.sha256(learned.encode()).hexdigest())
    return out


def digests(spark, rows, **how):
    df = spark.createDataFrame(rows, TURNS).repartition(3)
    windows = chat_windows.format_conversations(df, **how).persist()
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"])
           for r in chat_windows.conversation_digests(windows).collect()}
    return windows, got


def test_odd_texts_roles_nulls_and_ties_come_back(spark):
    rng = random.Random(0)
    rows = [(c, t, rng.choice(["user", "assistant", "assistant", "a\nb%0A<|", None]), odd_text(rng) or None)
            for c in range(40) for t in range(rng.randrange(1, 12))]
    rows += [(3, 1, "assistant", "same")] * 5 + [(None, None, "assistant", "x"), (None, 2, "user", "y"), (7, None, "user", "z")]
    windows, got = digests(spark, rows, budget=30, history_tokens=12)
    assert got == expected(rows)
    assert windows.where(F.length("formatted") != F.col("n_chars")).count() == 0


def test_windows_keep_budget_system_and_history_and_mask_repeats(spark):
    rng = random.Random(1)
    rows = [(1, 0, "system", "be kind to all"), *[(1, t, ["user", "assistant"][t % 2], f"t{t} " + "ab " * rng.randrange(1, 9))
                                                  for t in range(1, 60)]]
    windows, got = digests(spark, rows, budget=80, history_tokens=30, history_turns=2)
    assert got == expected(rows)
    seen = []
    for w in sorted(windows.collect(), key=lambda r: (r["block"], r["window"])):
        marks = w["formatted"].split("<|im_start|>")[1:]
        assert marks[0].startswith("system\nbe kind to all")                  # own or repeated
        assert w["n_tokens"] <= 80 and len(marks) == w["n_turns"] + w["n_repeated"]
        own = marks[w["n_repeated"]:]
        numbers = [int(m.split("\nt")[1].split(" ")[0]) for m in marks[1:]]
        assert numbers == list(range(numbers[0], numbers[-1] + 1))            # history and span are one run
        assert w["n_repeated"] <= 3
        masked = [w["formatted"][s["start"]:s["start"] + s["length"]] for s in w["loss_spans"]]
        assert masked == [m.split("\n", 1)[1][:-len("<|im_end|>\n")] for m in own if m.startswith("assistant\n")]
        seen += own
    assert len(seen) == 60 and len(set(seen)) == 60
    assert any(w["n_repeated"] > 1 for w in windows.collect())


def test_long_conversations_are_dealt_in_blocks_with_context(spark):
    rows = [(1, 0, "system", "rules"), *[(1, t, ["user", "assistant"][t % 2], f"n{t}") for t in range(1, 100)],
            *[(2, t, "assistant", f"m{t}") for t in range(16, 40)], (3, 0, "user", "hi"), (1, 5000, "assistant", "far")]
    windows, got = digests(spark, rows, budget=60, history_tokens=25, history_turns=3, block_turns=16)
    assert got == expected(rows)
    starts = {r["block"]: r for r in windows.where("conv_id = 1 and window = 0").collect()}
    assert set(starts) == {0, 1, 2, 3, 4, 5, 6, 312}
    assert all("system\nrules" in r["formatted"] for r in starts.values())
    assert "n15<" in starts[1]["formatted"] and "n13<" in starts[1]["formatted"] and "n12<" not in starts[1]["formatted"]
    assert starts[312]["n_repeated"] == 1                                     # no turn numbered shortly before


def test_crowded_turn_numbers_are_dealt_in_pieces(spark):
    rows = [(1, 0, "assistant", "same")] * 50 + [(1, None, "assistant", f"u{k % 7}") for k in range(40)] \
        + [(None, 1, "user", "x")] * 30 + [(2, t, "assistant", f"v{t}") for t in range(5)]
    windows, got = digests(spark, rows, crowded_rows=8)
    assert got == expected(rows)
    assert windows.where("conv_id = 1").agg(F.max("n_turns")).first()[0] <= 16      # of 90


def test_very_long_turn_and_only_system_and_empty_table_and_clashing_columns(spark):
    rows = [(1, 0, "system", "s"), (2, 0, "user", "word <|im_end|> " * 60_000), (2, 1, "assistant", "é" * 300_000), (2, 2, "user", "u")]
    windows, got = digests(spark, rows, budget=50)
    assert got == expected(rows)
    df = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit("clash") for c in ("block", "piece", "window", "n", "parts", "row")})
    assert chat_windows.format_conversations(df).count() == 4
    none = spark.createDataFrame([], TURNS)
    assert chat_windows.conversation_digests(chat_windows.format_conversations(none)).collect() == []


def test_chat_query_runs_no_python_on_executors(spark):
    plan = queries.op11_chat_windows(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan


def vectors_frame(spark, ids, x, labels=None):
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], None if labels is None else labels[k])
            for k, (i, v) in enumerate(zip(ids, x, strict=True))]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").repartition(3)


def brute_rounds(ids, x, k, rounds):
    order = sorted(range(len(ids)), key=lambda i: hashlib.sha256(f"3:{ids[i]}".encode()).hexdigest())[:k]
    c = x[order].copy()
    for r in range(rounds + 1):
        gap = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        own = gap.argmin(axis=1)
        if r < rounds:
            for j in range(len(c)):
                if (own == j).any():
                    c[j] = x[own == j].sum(axis=0) // (own == j).sum()
    return own, gap.min(axis=1), c


@pytest.mark.parametrize("kind", ["blobs", "ties", "few", "same"])
def test_bounds_give_the_plain_rounds(spark, kind):
    rng = np.random.default_rng(2)
    x = {"blobs": rng.normal(size=(400, 6)) * 0.05 + rng.normal(size=(12, 6)).repeat(34, axis=0)[:400],
         "ties": rng.integers(-2, 3, size=(300, 6)) / 1024.0, "few": rng.normal(size=(5, 6)), "same": np.ones((50, 6))}[kind]
    ids = list(range(100, 100 + len(x)))
    report = []
    got = centroid_bounds.cluster_vectors(vectors_frame(spark, ids, x), dimension=6, report=report).collect()
    own, gap, c = brute_rounds(ids, np.floor(1024 * x).astype(np.int64), 8, 10)
    digest = [hashlib.sha256(",".join(map(str, r.tolist())).encode()).hexdigest() for r in c]
    want = {i: (int(a), int(g), int(gap[own == a].sum()), int(gap.sum()), digest[a]) for i, a, g in zip(ids, own, gap, strict=True)}
    assert {r["vec_id"]: tuple(r)[1:] for r in got} == want
    if kind == "blobs":                       # later rounds mostly pass their bounds
        assert report[0] == len(x) and min(report) < len(x) / 4


def test_bounds_by_total_displacement_are_never_looser_than_summed_drifts():
    rng = np.random.default_rng(3)
    history = rng.integers(-1000, 1000, size=(7, 4, 5))
    total = centroid_bounds.shifts(history)
    drifts = np.sqrt(((history[1:] - history[:-1]) ** 2).sum(axis=2))
    for r in range(7):
        assert (total[r] <= drifts[r:].sum(axis=0) * (1 + 1e-8)).all()
    # a centroid that comes back costs the bounds nothing
    back = np.stack([history[0], history[1], history[0]])
    assert (centroid_bounds.shifts(back)[0] == 0).all()


def test_clustering_leaves_out_unusable_rows_and_counts_repeats(spark):
    x = [[1.0, 2.0], [1.0, 2.0], None, [1.0, None], [1.0, float("nan")], [float("inf"), 0.0], [3.0], [], [0.5, -0.5]]
    df = vectors_frame(spark, [1, 1, 2, 3, 4, 5, 6, 7, None], x).withColumns({c: F.lit("clash") for c in ("x", "v", "id", "cluster", "lower")})
    got = sorted(tuple(r) for r in df.transform(lambda d: centroid_bounds.cluster_vectors(d, dimension=2)).fillna(-1).collect())
    assert [r[0] for r in got] == [-1, 1, 1]
    assert centroid_bounds.cluster_vectors(vectors_frame(spark, [1], [None]), dimension=2).collect() == []
    with pytest.raises(Exception, match="26 bits"):
        centroid_bounds.cluster_vectors(vectors_frame(spark, [1], [[1e30, 0.0]]), dimension=2).collect()


def brute_codes(ids, x, parts, entries, rounds):
    y = x.reshape(len(x), parts, -1)
    books = y[np.argsort(ids, kind="stable")[:entries]].transpose(1, 0, 2).copy()
    for r in range(rounds + 1):
        gap = ((y[:, :, None] - books[None]) ** 2).sum(axis=3)
        own = gap.argmin(axis=2)
        if r < rounds:
            for p in range(parts):
                for j in range(books.shape[1]):
                    if (own[:, p] == j).any():
                        books[p, j] = y[own[:, p] == j, p].sum(axis=0) // (own[:, p] == j).sum()
    return ["".join(f"{v:02x}" for v in r) for r in own], gap.min(axis=2).sum(axis=1), books


@pytest.mark.parametrize("kind", ["plain", "copies", "few", "coarse"])
def test_trie_codes_are_the_nearest_entries(spark, kind):
    rng = np.random.default_rng(4)
    x = {"plain": rng.normal(size=(300, 12)), "copies": rng.normal(size=(9, 12))[rng.integers(0, 9, 300)],
         "few": rng.normal(size=(3, 12)), "coarse": rng.integers(-2, 3, size=(500, 12)) / 256.0}[kind]
    ids = rng.permutation(len(x)).tolist()
    labels = [None if i % 3 == 0 else f"l{i % 4}" for i in ids]
    got = part_trie.compress_vectors(vectors_frame(spark, ids, x, labels), parts=4, entries=16).collect()
    code, error, books = brute_codes(np.array(ids), np.floor(256 * x).astype(np.int64), 4, 16, 2)
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    per = {lab: int(sum(e for e, k in zip(error, labels, strict=True) if k == lab)) for lab in labels}
    want = {i: (lab, c, int(e), per[lab], digest) for i, lab, c, e in zip(ids, labels, code, error, strict=True)}
    assert {r["vec_id"]: tuple(r)[1:] for r in got} == want


def test_walk_shares_common_prefixes_across_blocks(monkeypatch):
    rng = np.random.default_rng(5)
    parts = np.unique(rng.integers(0, 4, size=(400, 4)), axis=0)
    place = np.zeros(len(parts), dtype=np.int64)
    books = rng.integers(0, 4, size=(1, 10, 4))
    prefixes = sum(len(np.unique(parts[:, :d], axis=0)) for d in range(1, 5))
    for leaves in (7, 64, 10_000):
        monkeypatch.setattr(part_trie, "LEAVES", leaves)
        trie = part_trie.PartTrie(books)
        entry, gap = trie.walk(place, parts)
        assert trie.nodes == prefixes                      # each node of the trie is entered once
        plain = ((parts[:, None] - books[0][None]) ** 2).sum(axis=2)
        assert (entry == plain.argmin(axis=1)).all() and (gap == plain.min(axis=1)).all()


def test_codes_leave_out_unusable_rows(spark):
    x = [[1.0, 2.0], [1.0, 2.0], None, [1.0, None], [1.0, float("nan")], [3.0], [], [0.5, -0.5], [float("-inf"), 1.0]]
    df = vectors_frame(spark, [1, 1, 2, 3, 4, 5, 6, None, 8], x, list("abcdefghi"))
    df = df.withColumns({c: F.lit("clash") for c in ("x", "v", "id", "code", "error", "place")})
    got = part_trie.compress_vectors(df, parts=2, entries=4)
    assert sorted(str(r["vec_id"]) for r in got.collect()) == ["1", "1", "None"]
    assert part_trie.compress_vectors(df, parts=16).collect() == []            # 16 parts do not divide 2
    assert part_trie.compress_vectors(vectors_frame(spark, [1], [None], ["a"]), parts=2).collect() == []


def test_totals_reach_hot_and_null_keys_beyond_the_broadcast_bound(spark):
    rows = spark.createDataFrame([(i, None if i % 3 == 0 else f"k{i % 5}") for i in range(90)], "id long, label string")
    totals = rows.groupBy("label").agg(F.count("*").alias("n"))
    a = sorted(map(str, attach_totals(rows, "label", totals, "id").collect()))
    assert a == sorted(map(str, attach_totals(rows, "label", totals, "id", small=0, salts=4).collect())) and len(a) == 90


def test_queries_equal_their_sql_by_name(spark):
    for name in ("op11_chat_windows", "op12_centroid_bounds", "op13_part_trie"):
        assert name in queries.QUERIES and name in queries.ORACLES
