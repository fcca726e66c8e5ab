"""Property checks on many generated inputs per Spark job."""

import random
from fractions import Fraction

from pyspark.sql import Window
from pyspark.sql import functions as F

from marquee.functions.scalars import ratio_round_half_even
from marquee.functions.windows import count_in_range, running_totals


def half_even(num, den, digits=1, scale=100):
    x = Fraction(scale * num, den) * 10 ** digits
    q, r = divmod(x.numerator, x.denominator)
    if 2 * r > x.denominator or (2 * r == x.denominator and q % 2 == 1):
        q += 1
    return q / 10 ** digits


def test_ratio_round_half_even_exact(spark):
    rng = random.Random(11)
    pairs = [(rng.randint(0, 500), rng.randint(1, 500)) for _ in range(3000)]
    pairs += [(1, 400), (3, 400), (1, 8), (5, 16), (1, 2000), (3, 2000)]  # exact ties
    df = spark.createDataFrame(pairs, "n long, d long")
    got = df.select("n", "d", ratio_round_half_even(F.col("n"), F.col("d"), 1).alias("r")).collect()
    for row in got:
        assert row["r"] == half_even(row["n"], row["d"]), (row["n"], row["d"], row["r"])


def test_running_totals_random_keys(spark):
    rng = random.Random(5)
    rows = [(rng.choice([0, 0, 0, 1, 2, 3]), i, rng.randint(-5, 9)) for i in range(2000)]
    df = spark.createDataFrame(rows, "k long, t long, v long")
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    ref = sorted(map(tuple, df.withColumn("s", F.sum("v").over(w)).collect()))
    for ranges in (1, 4, 60):
        got = running_totals(df, ["k"], [F.col("t")], {"s": F.col("v")}, ranges=ranges)
        assert sorted(map(tuple, got.select("k", "t", "v", "s").collect())) == ref


def test_count_in_range_random(spark):
    rng = random.Random(9)
    rows = [(rng.choice([0, 0, 1]), rng.randint(0, 5000)) for _ in range(1500)]
    df = spark.createDataFrame(rows, "k long, t long")
    w = Window.partitionBy("k").orderBy("t").rangeBetween(-60, 0)
    ref = sorted(map(tuple, df.withColumn("n", F.count(F.lit(1)).over(w)).collect()))
    for hot in (0, 10**9):
        got = count_in_range(df, ["k"], F.col("t"), 60, 250, out="n", hot_rows=hot)
        assert sorted(map(tuple, got.collect())) == ref
