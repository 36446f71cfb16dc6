"""Two loads equal one: the velocity mart and the category codes."""

import datetime as dt
import random

from pyspark.sql import functions as F

from ledgerguard.operators import incremental, warehouse
from ledgerguard.session import ensure_checkpoint_dir
from tests.helpers import T0, card_frame


def rows_of(seed=0, n=240):
    rng = random.Random(seed)
    return [(i, rng.choice([1, 2, 3, 4]), 1, 5411, rng.randrange(1, 900) / 10,
             T0 + dt.timedelta(minutes=rng.choice([0, 30, 600]) + 60 * rng.randrange(24 * 9)), 0.0, 0.0, "CP") for i in range(n)]


def staged(spark, rows):
    """Rows of card 4 have no card."""
    return warehouse.stg_transactions(card_frame(spark, rows).withColumn("card_id", F.expr("nullif(card_id, 4)")))


def same(a, b):
    b = b.select(*[c for c in a.columns if c in b.columns])
    a = a.select(*b.columns)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_loads_in_order_late_and_repeated_equal_one(spark):
    rows = sorted(rows_of(), key=lambda r: r[5])
    whole = warehouse.fct_card_velocity(staged(spark, rows))
    folder = f"{ensure_checkpoint_dir(spark)}/mart-{random.random()}"
    late = rows[60:80]
    incremental.load_velocity(staged(spark, rows[:60] + rows[80:120]), folder)
    incremental.load_velocity(staged(spark, rows[120:200]), folder)
    incremental.load_velocity(staged(spark, late), folder)                    # earlier dates again
    mart = incremental.load_velocity(staged(spark, rows[150:]), folder)       # partly a repeat
    same(mart, whole)
    same(incremental.load_velocity(staged(spark, rows[:1]).where("false"), folder), whole)


def test_a_load_writes_only_its_dates(spark):
    rows = sorted(rows_of(1), key=lambda r: r[5])
    folder = f"{ensure_checkpoint_dir(spark)}/mart-{random.random()}"
    incremental.load_velocity(staged(spark, rows[:150]), folder)
    files = lambda: set(incremental.read_mart(spark, folder).select(F.input_file_name()).distinct().toPandas().iloc[:, 0])
    before = files()
    incremental.load_velocity(staged(spark, rows[150:]), folder)
    kept = before & files()
    first = rows[150][5].date().isoformat()
    assert kept and all(f.split("event_date=")[1][:10] < first for f in kept)
    assert kept == {f for f in before if f.split("event_date=")[1][:10] < first}


def test_codes_never_change(spark):
    folder = f"{ensure_checkpoint_dir(spark)}/codes-{random.random()}"
    one = spark.createDataFrame([(1, 10, "b", "x"), (2, 20, "a", None), (3, 30, "b", "y")], "TransactionID long, ts_us long, p string, q string")
    two = spark.createDataFrame([(4, 5, "c", "z"), (5, 40, "a", "x"), (6, 41, "0", None)], one.schema)
    codes = lambda d: {(r["column_name"], r["value"]): (r["code"], r["load"]) for r in d.collect()}
    first = codes(incremental.grow_codes(one, ["p", "q"], folder))
    assert first == {("p", "b"): (0, 1), ("p", "a"): (1, 1), ("q", "x"): (0, 1), ("q", "y"): (1, 1)}
    second = codes(incremental.grow_codes(two, ["p", "q"], folder))
    assert first.items() <= second.items()
    assert second.keys() - first.keys() == {("p", "c"), ("p", "0"), ("q", "z")}
    assert (second["p", "c"], second["p", "0"], second["q", "z"]) == ((2, 2), (3, 2), (2, 2))
    assert codes(incremental.grow_codes(two, ["p", "q"], folder)) == second
