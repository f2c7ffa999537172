"""Scores built from positive and negative counts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from marketlens.functions.columns import ColumnLike, as_column


def positive_ratio(positive: ColumnLike, negative: ColumnLike) -> Column:
    """Share of positives, NULL without any vote."""
    positive, total = as_column(positive), as_column(positive) + as_column(negative)
    return positive / F.when(total > 0, total)


def wilson_lower_bound(positive: ColumnLike, negative: ColumnLike, z: float = 1.96) -> Column:
    """Lower end of the Wilson score interval, NULL without any vote.

    Numerator and denominator of the textbook form are multiplied by n, which
    leaves one division by n and works from the counts instead of their ratio.
    """
    good, bad = as_column(positive).cast("double"), as_column(negative).cast("double")
    n = F.when(good + bad > 0, good + bad)
    margin = z * F.sqrt(good * bad / n + z * z / 4)
    return (good + z * z / 2 - margin) / (n + z * z)


def value_proxy(holders: ColumnLike, list_price: ColumnLike) -> Column:
    """Holders times list price: a sort key, not a revenue."""
    return as_column(holders) * as_column(list_price)
