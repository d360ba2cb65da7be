import random
from decimal import Decimal

from callsift.functions.numeric import percent, round_half_even, two_decimals


def test_rounding_follows_the_stored_value(spark):
    rng = random.Random(7)
    values = [rng.uniform(0, 1.3) for _ in range(3000)]
    values += [i / 1000 + 0.0005 for i in range(1000)]
    values += [i / 2000 for i in range(2000)] + [0.0, 1.0, 0.0625, 2.675, 1e-9]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = df.select("v", *[round_half_even("v", d).alias(f"d{d}") for d in (1, 2, 3)])
    for row in rows.collect():
        assert (row.d1, row.d2, row.d3) == (
            round(row.v, 1),
            round(row.v, 2),
            round(row.v, 3),
        )


def test_two_decimals_is_printf(spark):
    rng = random.Random(8)
    values = [rng.uniform(-1, 1) for _ in range(2000)]
    values += [-0.003, -0.02, 0.0, 0.125, 0.375, 0.005, 0.015, 12.5]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for row in df.select("v", two_decimals("v").alias("t")).collect():
        assert row.t == f"{row.v:.2f}", Decimal(row.v)


def test_percent_rounds_half_even_and_survives_no_total(spark):
    pairs = [(p, t) for t in (0, 3, 8, 50, 80, 200) for p in range(0, t + 1)]
    df = spark.createDataFrame(pairs, "p long, t long")
    for row in df.select("p", "t", percent("p", "t").alias("x")).collect():
        assert row.x == (round(100 * row.p / row.t) if row.t else 0)
