"""Exact quantiles of a whole frame by distributed selection."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window, functions as F

from marketlens.functions.columns import ColumnLike, as_column
from marketlens.functions.ordering import order_key
from marketlens.operators.ranking import few_rows

#: Bits that one pass over the rows settles.
LEVEL_BITS = 16
KEY_BITS = 64


def _rank(total: Column, fraction: float) -> Column:
    """The first rank whose share of ``total`` rows is at least ``fraction``."""
    share = Fraction(str(fraction))
    rank = F.ceil((total * share.numerator).cast("decimal(38,0)") / share.denominator)
    return F.greatest(rank.cast("long"), F.lit(1).cast("long"))


def _level(
    rows: DataFrame, shift: int, wanted: Column | None, fractions: Sequence[float]
) -> DataFrame:
    """One row ``found``: per fraction the prefix of its key, the rank among the rows of that
    prefix, and at the last level the value.

    ``wanted`` holds the prefixes and ranks of the level above, None at the top.
    """
    if wanted is not None:
        inside = F.shiftright("key", shift + LEVEL_BITS)
        rows = rows.filter(F.array_contains(wanted["prefix"], inside))
    # A few neighbours can share a whole key: the last level tells them apart.
    own_value = F.lit(None).cast("double") if shift else F.col("value")
    bins = [F.shiftright("key", shift).alias("prefix"), own_value.alias("value")]
    counts = few_rows(rows.groupBy(*bins).agg(F.count("*").alias("n")))
    above = F.lit(0) if wanted is None else F.shiftright("prefix", LEVEL_BITS)
    counts = counts.withColumn("above", above.cast("long"))
    family = Window.partitionBy("above")
    upto = family.orderBy("prefix", "value").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    counts = counts.withColumn("upto", F.sum("n").over(upto))
    if wanted is None:
        total = F.sum("n").over(family)
        ranks = F.array(*[_rank(total, fraction) for fraction in fractions])
        wanted = F.struct(F.array(*[F.lit(0).cast("long") for _ in fractions]).alias("prefix"),
                          ranks.alias("rank"))
    counts = counts.withColumn("wanted", wanted)
    prefixes, ranks, values = [], [], []
    for i in range(len(fractions)):
        rank, own = F.col("wanted")["rank"][i], F.col("above") == F.col("wanted")["prefix"][i]
        reached = own & (F.col("upto") >= rank)
        before = F.max(F.when(own & (F.col("upto") < rank), F.col("upto")))
        prefixes.append(F.min(F.when(reached, F.col("prefix"))))
        ranks.append(F.max(rank) - F.coalesce(before, F.lit(0).cast("long")))
        values.append(F.min(F.when(reached, F.col("value"))))
    parts = {"prefix": prefixes, "rank": ranks, "value": values}
    return counts.agg(F.struct(*[F.array(*v).alias(k) for k, v in parts.items()]).alias("found"))


def exact_quantiles(df: DataFrame, value: ColumnLike, fractions: Sequence[float]) -> Column:
    """An array: for each of ``fractions`` the smallest value of the frame that at least
    this share of its rows does not exceed, at any number of rows; a scalar subquery.

    Every pass counts the rows per value of the next 16 bits of an integer in the values'
    order, only for rows that share a prefix with one that is wanted, so four passes over
    one column find all of them. A task's state and its shuffled rows are bounded by 65,536
    counts per fraction; no value is sorted, collected or estimated. The plan is lazy.

    Values are compared as doubles; NaN sorts last, NULL does not count. Without any value
    all quantiles are NULL.
    """
    values = df.select(as_column(value).cast("double").alias("value"))
    rows = values.filter(F.col("value").isNotNull()).withColumn("key", order_key("value"))
    shifts = range(KEY_BITS - LEVEL_BITS, -1, -LEVEL_BITS)
    found = _level(rows, shifts[0], None, fractions)
    for shift in shifts[1:]:
        found = _level(rows, shift, found.scalar(), fractions)
    return found.select("found.value").scalar()
