"""Scores, bands, label sets and aggregates."""

import math
import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from marketlens.functions import (
    AGE_BANDS,
    AGE_GATED_TAGS,
    GROUP_SIZE_BANDS,
    LIST_LENGTH_BANDS,
    MATURE_TAGS,
    PRICE_BANDS,
    REVIEW_BANDS,
    Bands,
    count_where,
    distinct_values,
    exact_mean,
    grid_point,
    has_any_label,
    pct_where,
    pooled_ratio,
    positive_ratio,
    value_proxy,
    wilson_lower_bound,
)


def textbook_wilson(positive, negative, z=1.96):
    n = positive + negative
    p = positive / n
    centre = p + z * z / (2 * n)
    margin = z * math.sqrt((p * (1 - p) + z * z / (4 * n)) / n)
    return (centre - margin) / (1 + z * z / n)


def test_wilson(spark):
    draw = random.Random(7)
    pairs = [(0, 0), (1, 0), (327, 0), (0, 5), (None, 3), (309441, 3700), (10**12, 10**12)]
    pairs += [(draw.randrange(10**6), draw.randrange(10**6)) for _ in range(500)]
    df = spark.createDataFrame(pairs, "pos long, neg long").select(
        "pos", "neg", positive_ratio("pos", "neg"), wilson_lower_bound("pos", "neg")
    )
    for positive, negative, ratio, score in rows_of(df):
        if positive is None or positive + negative == 0:
            assert ratio is None and score is None
            continue
        assert ratio == positive / (positive + negative)
        assert score == pytest.approx(textbook_wilson(positive, negative), abs=1e-9)
        assert -1e-12 <= score <= ratio + 1e-12


def test_wilson_known_values(spark):
    df = spark.createDataFrame([(1, 0), (327, 0), (0, 5)], "pos long, neg long")
    scores = [row[0] for row in rows_of(df.select(wilson_lower_bound("pos", "neg")))]
    assert scores[0] == pytest.approx(0.2065, abs=1e-4)
    assert scores[1] == pytest.approx(0.9884, abs=1e-4)
    assert scores[2] == pytest.approx(0.0, abs=1e-12)


def test_value_proxy(spark):
    df = spark.createDataFrame([(10000.0, 9.99), (None, 1.0)], "mid double, price double")
    assert rows_of(df.select(value_proxy("mid", "price"))) == [(99900.0,), (None,)]


@pytest.mark.parametrize(
    "bands, cases",
    [
        (
            LIST_LENGTH_BANDS,
            {0: "1", 1: "1", 2: "2-4", 4: "2-4", 5: "5-9", 9: "5-9", 10: "10-14", 14: "10-14"}
            | {15: "15-20", 20: "15-20", 21: "21+", None: "unknown"},
        ),
        (
            GROUP_SIZE_BANDS,
            {1: "1 game", 2: "2-5 games", 5: "2-5 games", 6: "6-20 games", 20: "6-20 games"}
            | {21: "21+ games"},
        ),
        (
            REVIEW_BANDS,
            {1: "1-9", 9: "1-9", 10: "10-99", 99: "10-99", 100: "100-999", 999: "100-999"}
            | {1000: "1 000-9 999", 9999: "1 000-9 999", 10000: "10 000+"},
        ),
        (
            AGE_BANDS,
            {0: "none declared", 1: "1-15", 15: "1-15", 16: "16+", 21: "16+", None: "unparsed"},
        ),
    ],
)
def test_bands(spark, bands, cases):
    df = spark.createDataFrame([(v,) for v in cases], "v int")
    labelled = df.withColumn("rank", bands.rank("v")).select("v", bands.label("rank"))
    assert dict(rows_of(labelled)) == cases


def test_price_bands(spark):
    cases = [
        (0.0, True, "free"),
        (4.99, False, "under $5"),
        (5.0, False, "$5-10"),
        (9.99, False, "$5-10"),
        (10.0, False, "$10-20"),
        (19.99, False, "$10-20"),
        (20.0, False, "$20-40"),
        (39.99, False, "$20-40"),
        (40.0, False, "$40+"),
        (None, None, "unknown"),
        (0.0, False, "under $5"),
    ]
    df = spark.createDataFrame(cases, "price double, free boolean, expected string")
    rank = PRICE_BANDS.rank("price", first=F.col("free"))
    wrong = df.withColumn("rank", rank).filter(PRICE_BANDS.label("rank") != F.col("expected"))
    assert wrong.count() == 0


def test_bands_are_checked():
    with pytest.raises(ValueError):
        Bands((1, 2), ("only", "two"))
    with pytest.raises(ValueError):
        PRICE_BANDS.rank(F.lit(1))


def test_label_sets(spark):
    df = spark.createDataFrame(
        [({"NSFW": 3},), ({"Gore": 1, "Calm": 2},), ({"Calm": 2},), ({},), (None,)],
        "tags map<string, bigint>",
    )
    keys = F.map_keys("tags")
    flags = df.select(has_any_label(keys, AGE_GATED_TAGS), has_any_label(keys, MATURE_TAGS))
    assert rows_of(flags) == [
        (True, True),
        (False, True),
        (False, False),
        (False, False),
        (False, False),
    ]


def test_label_lists():
    assert len(AGE_GATED_TAGS) == 2
    assert len(MATURE_TAGS) == len(set(MATURE_TAGS)) == 27
    assert set(AGE_GATED_TAGS) < set(MATURE_TAGS)


def test_aggregates(spark):
    df = spark.createDataFrame(
        [("a", 1, 3), ("b", 2, 0), (None, None, 1), ("a", 5, None)], "k string, x int, y int"
    )
    big = F.col("x") > 1
    row = df.agg(
        count_where(big),
        pct_where(big),
        distinct_values("k"),
        distinct_values("x"),
        pooled_ratio("x", "y"),
    ).first()
    assert tuple(row) == (2, 66.7, 3, 4, 8 / 12)


def test_aggregates_on_empty_input(spark):
    df = spark.createDataFrame([], "k string, x int, y int")
    row = df.agg(
        count_where(F.col("x") > 1),
        pct_where(F.col("x") > 1),
        distinct_values("k"),
        pooled_ratio("x", "y"),
        exact_mean("x"),
    ).first()
    assert tuple(row) == (0, None, 0, None, None)


def test_pooled_ratio_without_votes(spark):
    df = spark.createDataFrame([(0, 0)], "x int, y int")
    assert df.agg(pooled_ratio("x", "y")).first()[0] is None


def test_exact_mean_ignores_order(spark):
    """1.99 and 2.00 average to a rounding tie, which a sum of doubles may miss."""
    values = [1.99, 2.0] * 5001
    expected = 1.995
    for partitions in (1, 7):
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(partitions)
        assert df.agg(exact_mean("v")).first()[0] == expected
        assert df.agg(F.round(exact_mean("v"), 2)).first()[0] == 2.0


def test_exact_mean_skips_null(spark):
    df = spark.createDataFrame([(1.5,), (None,), (2.5,)], "v double")
    assert df.agg(exact_mean("v")).first()[0] == 2.0


@pytest.mark.parametrize(
    "values",
    [[1.5e11 + 0.125, 1.5e11 - 0.125, -7.25, -0.01], [0.004, 0.004, 0.008], [1e15] * 1000, [1e30, 1e30]],
)
def test_exact_mean_is_the_mean(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    assert df.agg(exact_mean("v")).first()[0] == pytest.approx(sum(values) / len(values), rel=1e-15)


def test_exact_mean_of_nan_and_infinity(spark):
    df = spark.createDataFrame([("a", float("nan")), ("a", 1.0), ("b", float("inf"))], "k string, v double")
    got = dict(map(tuple, df.groupBy("k").agg(exact_mean("v")).collect()))
    assert got["a"] != got["a"] and got["b"] == float("inf")


def test_grid_point_is_round(spark):
    """Ties included: 1.005 and 0.0345 lie just beside their decimal text."""
    draw = random.Random(5)
    values = [draw.random() for _ in range(2000)] + [k / 2000 for k in range(2001)]
    values += [1.005, 2.675, 0.0345, -0.0345, -1.005, 99999.995, 1e6 + 0.0005, 0.0, -0.0]
    values += [a / (a + b) for a in range(40) for b in range(1, 40)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (1, 2, 3):
        differs = F.round("v", digits) != grid_point("v", digits) / 10**digits
        assert df.filter(differs).count() == 0
    ints = spark.createDataFrame([(3,), (-3,), (None,)], "v int").select(grid_point("v", 0))
    assert rows_of(ints) == [(3,), (-3,), (None,)]
