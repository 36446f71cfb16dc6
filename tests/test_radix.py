"""Radix select against sorting."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerguard.operators import radix


def test_descending_orders_all_doubles(spark):
    values = [0.0, -0.0, 1.5, -1.5, 1e-300, -1e300, float("inf"), float("-inf"), 0.5, 0.25, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    rows = df.withColumn("k", radix.descending(F.col("v"))).collect()
    got = [r["v"] for r in sorted(rows, key=lambda r: r["k"])]
    want = sorted((v for v in values if v is not None), reverse=True) + [None]
    assert got == want and len({r["k"] for r in rows if r["v"] == 0}) == 1


@pytest.mark.parametrize("spread, rest, histogram", [(3, 1, 64), (10 ** 6, 1, 64), (1 << 62, 5, 1 << 16), (1, 1, 256)])
def test_first_sums_and_cuts(spark, monkeypatch, spread, rest, histogram):
    """Ties in the leading keys, negative keys, several groups, all k at once."""
    monkeypatch.setattr(radix, "HISTOGRAM", histogram)
    rng = random.Random(spread)
    rows = [(g, rng.randrange(-spread, spread), rng.randrange(3), i, rng.randrange(-5, 50)) for g in range(3)
            for i in range(150 * (g + 1))]
    df = spark.createDataFrame(rows, "g int, a long, b long, id long, v long").repartition(3)
    ks = [0, 1, 2, 10, 75, 149, 150, 151, 400, 10_000]
    sums, cuts = radix.first_sums(df, ["a", "b", "id"], ks, ["v"], group="g", rest=rest)
    for g in range(3):
        order = sorted(r[1:] for r in rows if r[0] == g)
        assert sums[g] == {k: (len(order[:k]), sum(r[3] for r in order[:k])) for k in ks if k}
        for k in (1, 75, 151, 10_000):
            held = df.where((F.col("g") == g) & cuts[g][k].holds()).select("id").collect()
            assert {r["id"] for r in held} == {r[2] for r in order[:k]}


def test_empty_table_and_equal_rows(spark):
    df = spark.createDataFrame([], "a long, v long")
    assert radix.first_sums(df, ["a"], [1, 5], ["v"]) == ({}, {})
    same = spark.createDataFrame([(1, 2)] * 9, "a long, v long")
    assert radix.first_sums(same, ["a"], [9, 20], ["v"])[0] == {9: (9, 18), 20: (9, 18)}
    with pytest.raises(ValueError, match="unique"):
        radix.first_sums(same, ["a"], [4], ["v"], rest=1)


def test_passes_move_no_rows(spark):
    """A pass is a partial count: its plan has no sort and exchanges buckets only."""
    df = spark.range(1000).select(F.col("id"), F.xxhash64("id").alias("a"))
    seen = []
    kept = type(df).collect

    def collect(self):
        seen.append(self._jdf.queryExecution().executedPlan().toString())
        return kept(self)
    type(df).collect = collect
    try:
        radix.first_sums(df, ["a", "id"], [100, 500], rest=10)
    finally:
        type(df).collect = kept
    assert len(seen) >= 2 and not any("Sort " in p or "Window" in p for p in seen)
    assert all("rangepartitioning" not in p for p in seen)
