import math
import random
from fractions import Fraction

from pyspark.sql import functions as F

from candlewright.functions.numbers import exact_sums, fixed_text, number_text, to_number


def test_number_text_reads_like_python(spark):
    values = [0.0, -0.0, 1.0, 30.0, 0.0005, 0.0001, 0.00001, 1.5e-7, 1e7, 12345678.9, 123456789012345.6,
              1e16, 2.5e20, -1e-5, -4.2, math.inf, -math.inf, math.nan, 1e100]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", number_text(F.col("v")).alias("t"))
    assert [(r.t) for r in rows.collect()] == [repr(v) for v in values]


def test_fixed_text_rounds_the_exact_binary_value(spark):
    values = [1.125, 1.005, 1.015, 2.675, 0.125, 0.375, 0.005, -1.125, -0.001, 1e9 + 0.125, 99.995, 0.0, 12.5]
    rng = random.Random(7)
    values += [rng.uniform(-1e5, 1e5) for _ in range(500)] + [k / 1000 for k in range(0, 4000, 5)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select(
        "v", fixed_text(F.col("v"), 2).alias("a"), fixed_text(F.col("v"), 4).alias("b")
    )
    for r in rows.collect():
        assert (r.a, r.b) == (f"{r.v:.2f}", f"{r.v:.4f}"), r.v


def test_to_number_accepts_what_float_accepts(spark):
    texts = ["30", " 1.5 ", "-2e3", "1_000", ".5", "5.", "inf", "-Infinity", "nan", "1.0d", "1.0f", "abc", "", "1__0", "0x1", "1e", "_1"]

    def parsed(text):
        try:
            return float(text)
        except ValueError:
            return None

    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", to_number(F.col("t")).alias("v"))
    for r in rows.collect():
        want = parsed(r.t)
        assert r.v == want or (math.isnan(r.v) and math.isnan(want)), (r.t, r.v, want)


def summed(spark, groups, parts=5):
    rows = [(k, v) for k, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "k string, v double").repartition(parts)
    return {r.k: r.s for r in exact_sums(df, ["k"], {"s": F.col("v")}).collect()}


def test_exact_sums_ignore_order(spark):
    rng = random.Random(3)
    groups = {"a": [round(rng.uniform(-1000, 1000), 4) for _ in range(5000)]}
    for parts in (1, 4, 13):
        assert summed(spark, groups, parts) == {"a": math.fsum(groups["a"])}


def test_exact_sums_of_unusual_values(spark):
    inf, nan = math.inf, math.nan
    groups = {
        "nan": [1.0, nan], "inf": [1.0, inf], "both": [inf, -inf], "big": [9e18, 9e18, 1.0], "null": [None, None],
        "some": [None, 2.5], "neg": [-0.1, -0.2], "zero": [0.0, -0.0], "over": [1.7e308, 1.7e308],
    }
    got = summed(spark, groups)
    assert math.isnan(got["nan"]) and math.isnan(got["both"]) and got["inf"] == got["over"] == inf
    assert got["big"] == 1.8e19 and got["null"] is None and got["some"] == 2.5 and got["zero"] == 0.0
    assert got["neg"] == math.fsum([-0.1, -0.2])
    assert exact_sums(spark.createDataFrame([], "k string, v double"), ["k"], {"s": F.col("v")}).count() == 0


def test_exact_sums_hold_all_magnitudes(spark):
    """Equal to the fraction of all values, rounded once: nothing is cut at any size."""
    rng = random.Random(11)
    groups = {
        "tiny": [1e-30] * 10, "atto": [1.23456789012345e-20] * 3, "one": [1e20, 1.0], "far": [1e20, 1e-30],
        "cancelled": [1e20, 1e-30, -1e20], "least": [5e-324] * 7, "most": [1.7e308, 1.7e308, -1.7e308],
        "powers": [2.0 ** k for k in range(-1074, 1000)], "tie": [2.0 ** 53, 1.0], "above": [2.0 ** 53, 1.0, 1e-300],
        "under": [2.0 ** 53, 1.0, -1e-300],
    }
    for i in range(100):
        spread = rng.randint(0, 300)
        groups[f"wide{i}"] = [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randint(-spread, spread) for _ in range(20)]
        values = [rng.random() * 10.0 ** rng.randint(-5, 20) for _ in range(20)]
        groups[f"near{i}"] = values + [-v * (1 + 2.0 ** -52) for v in values]
    want = {k: float(sum(Fraction(v) for v in vs)) for k, vs in groups.items()}
    assert summed(spark, groups, 7) == want


def test_products_keep_their_digits(spark):
    """What the review found cut: a product of two doubles comes out as the product."""
    rows = spark.createDataFrame([("A", 98765.4321, 123.456789)], "k string, price double, quantity double")
    made = exact_sums(rows, ["k"], {"s": F.col("price") * F.col("quantity")}).first()
    assert made.s == 98765.4321 * 123.456789
