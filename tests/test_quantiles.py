"""Quantiles and medians that stay exact at any number of rows."""

import math
import random
import struct

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from marketlens import operators as ops
from marketlens.functions import order_key

FRACTIONS = [0.01, 0.5, 0.9, 0.99, 1.0]


def expected(values, fractions=FRACTIONS):
    known = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v))
    n = len(known)
    return [known[max(1, math.ceil(n * round(f * 100) / 100)) - 1] if n else None for f in fractions]


def found(df, fractions=FRACTIONS):
    return df.sparkSession.range(1).select(ops.exact_quantiles(df, "v", fractions)).first()[0]


def same(a, b):
    return a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))


SPECIAL = [0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, 2.0**1023, 1.7976931348623157e308, math.inf,
           -math.inf, math.nan, 1.0, math.nextafter(1.0, 0), math.nextafter(1.0, 2), 8.0,
           math.nextafter(8.0, 0), None]


@pytest.mark.parametrize("seed", range(3))
def test_values_of_all_magnitudes(spark, seed):
    draw = random.Random(seed)
    values = SPECIAL + [struct.unpack("d", draw.randbytes(8))[0] for _ in range(400)]
    values += [math.nextafter(2.0**draw.randrange(-1000, 1000), 0) for _ in range(100)]
    draw.shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    fractions = [draw.randrange(1, 101) / 100 for _ in range(12)]
    got, want = found(df, fractions), expected(values, fractions)
    assert all(map(same, got, want))


@pytest.mark.parametrize("values", [[], [None], [3.5], [math.nan, 1.0], [2.0] * 1000, [-1.0, -1.0, 7.0]])
def test_small_frames(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert all(map(same, found(df), expected(values)))


def test_above_the_limits_of_a_sketch(spark):
    n = 1_500_000
    df = spark.range(n).select((F.col("id") * 7919 % n / 16).alias("v"))
    assert found(df) == [(math.ceil(n * round(f * 100) / 100) - 1) / 16 for f in FRACTIONS]
    row = ops.distribution_summary(df, "v", digits=4).first()
    assert (row["median_paid"], row["p90"], row["p99"]) == tuple(
        (math.ceil(n * f / 100) - 1) / 16 for f in (50, 90, 99))
    depths = spark.range(300_001).select((F.col("id") % 70_001).cast("int").alias("d"))
    positive = sorted(i % 70_001 for i in range(300_001) if i % 70_001)
    got = ops.discount_summary(depths, "d").first()["median_discount"]
    assert got == positive[math.ceil(len(positive) / 2) - 1]


def test_a_hot_value(spark):
    df = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, 7.25).otherwise(F.col("id") / 1000).alias("v"))
    values = [7.25 if i % 3 == 0 else i / 1000 for i in range(90_000)]
    assert found(df) == expected(values)


def test_no_sketch_and_no_sort_of_values(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    plan = ops.distribution_summary(df, "v")._jdf.queryExecution().executedPlan().toString()
    assert "approx" not in plan and "rangepartitioning" not in plan.lower()


@settings(max_examples=30, deadline=None)
@given(st.lists(st.floats(allow_nan=False), min_size=1, max_size=60))
def test_keys_keep_the_order(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(1)
    rows = sorted(df.select("v", order_key("v").alias("k")).collect())
    assert all(a["k"] <= b["k"] for a, b in zip(rows, rows[1:]))


def test_only_neighbours_share_a_key(spark):
    draw = random.Random(5)
    values = []
    for _ in range(300):
        value = math.ldexp(1 + draw.random(), draw.randrange(-1070, 1020))
        values += [value, math.nextafter(value, 0), value * (1 + 1e-14), 2.0**draw.randrange(-1000, 1000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    held = df.distinct().groupBy(order_key("v").alias("k")).agg(F.min("v"), F.max("v")).collect()
    assert all(r[2] - r[1] <= 4 * math.ulp(r[1]) for r in held)


def lower_median(values):
    known = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v))
    return known[math.ceil(len(known) / 2) - 1] if known else None


@pytest.mark.parametrize("span", [None, (0.0, 1.0)])
def test_medians_per_group_at_any_width(spark, span):
    draw = random.Random(9)
    values = {
        "wide": [draw.choice([-1, 1]) * 10 ** draw.uniform(-3, 12) for _ in range(700)],
        "narrow": [draw.random() for _ in range(301)], "one": [5.0], "none": [None, None],
        "odd": [math.nan, None, 2.0, math.nan, math.nan], None: [1.5, 2.5, None],
        "huge": [1e300, -1e300, 1e300, 0.0],
    }
    rows = [(k, v, i % 3 == 0) for k, some in values.items() for i, v in enumerate(some)]
    df = spark.createDataFrame(rows, "k string, v double, m boolean").repartition(6)
    populations = {"n": ("median", None), "m_n": ("m_median", F.col("m"))}
    got = ops.grouped_medians(df, "k", "v", 2, populations, span=span)
    assert got.columns == ["k", "n", "m_n", "median", "m_median"]
    found = {r["k"]: r for r in got.collect()}
    assert set(found) == set(values)
    for k, some in values.items():
        thirds = [v for i, v in enumerate(some) if i % 3 == 0]
        assert (found[k]["n"], found[k]["m_n"]) == (len(some), len(thirds))
        if k == "huge":
            continue
        for name, part in (("median", some), ("m_median", thirds)):
            want = lower_median(part)
            assert same(found[k][name], want) or found[k][name] == pytest.approx(want, abs=0.0051)
    assert found["huge"]["median"] == 0.0


def test_one_group_of_a_million_values(spark):
    n = 1_000_000
    df = spark.range(n).select(
        F.when(F.col("id") % 10 == 0, F.concat(F.lit("g"), (F.col("id") / 10 % 50).cast("int")))
        .otherwise("hot").alias("k"), (F.col("id") * 7919 % n * 1000 / 8).alias("v"))
    hot = sorted(i * 7919 % n * 125.0 for i in range(n) if i % 10)
    row = ops.grouped_medians(df, "k", "v", 3, {"n": ("median", None)}).filter("k = 'hot'").first()
    assert (row["n"], row["median"]) == (len(hot), hot[math.ceil(len(hot) / 2) - 1])


def test_windows_of_wide_medians_are_short(spark, monkeypatch):
    from marketlens.operators import medians

    longest, below = [], medians._below

    def watched(level, wanted, top):
        rows = below(level, wanted, top)
        longest.append(rows.groupBy("_key", "_population").count().agg(F.max("count")).first()[0])
        return rows

    monkeypatch.setattr(medians, "_below", watched)
    df = spark.range(200_000).select(F.lit("hot").alias("k"), (F.col("id") / 8).alias("v"))
    ops.grouped_medians(df, "k", "v", 3, {"n": ("median", None)})
    assert len(longest) == 5 and 1000 < max(longest) <= 1 << medians.LEVEL_BITS
