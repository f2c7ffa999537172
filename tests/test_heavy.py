"""Leading labels without counting the others one by one."""

import random
from collections import Counter

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from marketlens import operators as ops
from marketlens.operators.heavy import candidate_buckets


def both(df, k, **options):
    names = {"unit": "n", "share": "pct"}
    return (rows_of(ops.frequent_labels(df, "labels", "label", k=k, **names, **options)),
            rows_of(ops.label_prevalence(df, "labels", "label", k=k, **names)))


@pytest.mark.parametrize("buckets", [1, 7, 1 << 16])
@pytest.mark.parametrize("k", [1, 5, 40, 1000])
def test_the_leaders_are_exact(spark, buckets, k):
    draw = random.Random(k)
    rows = [(list({f"w{int(draw.paretovariate(0.7)) % 400}" for _ in range(8)}),) for _ in range(600)]
    rows += [([],), (None,), ([None, "w1"],)]
    found, expected = both(spark.createDataFrame(rows, "labels array<string>"), k, buckets=buckets)
    assert found == expected


def test_ties_and_empty_frames(spark):
    rows = [([f"t{i}" for i in range(30)],)] * 3
    found, expected = both(spark.createDataFrame(rows, "labels array<string>"), 4)
    assert found == expected and [r[0] for r in found] == ["t0", "t1", "t10", "t11"]
    none = spark.createDataFrame([], "labels array<string>")
    assert both(none, 3) == ([], [])


def test_only_few_labels_are_candidates(spark):
    """100,000 rare labels, each in a few rows, and fifty frequent ones, one in a third of all."""
    rare = spark.range(300_000).select(F.concat(F.lit("rare"), F.col("id") % 100_000).alias("label"))
    common = spark.range(200_000).select(F.concat(F.lit("c"), F.least(
        F.pmod(F.xxhash64("id"), F.lit(75)), F.lit(49))).alias("label"))
    rows = rare.unionByName(common)
    kept = {r[0] for r in candidate_buckets(rows, "label", 20).collect()}
    bucket = F.pmod(F.xxhash64("label"), F.lit(1 << 16)).alias("b")
    labels = Counter(r["b"] in kept for r in rows.distinct().select(bucket).collect())
    assert labels[True] < 0.005 * labels[False]
    exact = rows.groupBy("label").count().orderBy(F.desc("count"), "label").limit(20)
    whole = rows.select(F.array("label").alias("labels"))
    found = ops.frequent_labels(whole, "labels", "label", unit="n")
    assert rows_of(found.select("label", "n")) == rows_of(exact)
