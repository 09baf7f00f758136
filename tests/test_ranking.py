import random

from pyspark.sql import functions as F

from newsrisk.operators.ranking import global_row_number, global_running_sums


def test_numbers_follow_the_order_over_all_ranges(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(50), i, None if i % 7 == 0 else f"x{rng.randrange(9)}") for i in range(3000)]
    df = spark.createDataFrame(rows, "a int, b long, c string").repartition(9)
    got = global_row_number(df, [F.desc("a"), "c", "b"], "n").orderBy("n").collect()
    want = sorted(rows, key=lambda r: (-r[0], r[2] is not None, r[2] or "", r[1]))  # nulls first
    assert [(r.a, r.b, r.c) for r in got] == want and [r.n for r in got] == list(range(1, 3001))


def test_ties_and_empty_tables(spark):
    df = spark.createDataFrame([(1,)] * 40 + [(0,)] * 5, "a int")
    got = sorted((r.n, r.a) for r in global_row_number(df, ["a"], "n").collect())
    assert got == [(i, 0) for i in range(1, 6)] + [(i, 1) for i in range(6, 46)]
    assert global_row_number(df.where("a > 9"), ["a"], "n").count() == 0


def test_running_sums(spark):
    rows = [(i * 37 % 1000, i % 5) for i in range(1000)]
    df = spark.createDataFrame(rows, "k long, v long").repartition(6)
    got = global_running_sums(df, ["k"], {"s": F.col("v"), "n": F.lit(1)}).orderBy("k").collect()
    total = 0
    for i, (r, (k, v)) in enumerate(zip(got, sorted(rows))):
        total += v
        assert (r.k, r.s, r.n) == (k, total, i + 1)
