"""Aggregate expressions with small, mergeable state.

All of them combine on the map side, so a hot group shrinks to one buffer per
task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from marketlens.functions.columns import ColumnLike, as_column

NAN_POINT = (1 << 63) - 1


def count_where(predicate: Column) -> Column:
    """Rows where the predicate holds; 0 (not NULL) on empty input."""
    return F.count_if(predicate)


def pct_where(predicate: Column, digits: int = 1) -> Column:
    """Percentage of rows where the predicate holds; NULL predicates leave the denominator."""
    return F.round(100 * F.avg(predicate.cast("int")), digits)


def pooled_ratio(positive: ColumnLike, negative: ColumnLike) -> Column:
    """Ratio of sums: every vote weighs the same."""
    good, bad = F.sum(as_column(positive)), F.sum(as_column(negative))
    return F.try_divide(good, good + bad)


def grid_point(value: ColumnLike, digits: int) -> Column:
    """``round(value, digits)`` as a whole number of grid steps.

    ``F.round`` works on decimal text, which costs more than the rest of an
    aggregate. Shifting and flooring gives the same integer except next to a
    rounding tie, so only those rows take the slow way. NaN is the last point of all,
    ``NAN_POINT``, as NaN sorts last; other values stop at half of it.
    """
    value = as_column(value)
    steps = value * 10**digits
    tie_distance = F.abs(steps - F.floor(steps) - 0.5)
    near_tie = tie_distance < 1e-9 + F.abs(steps) * 4e-16
    settled = F.when(near_tie, F.round(value, digits) * 10**digits).otherwise(steps)
    last = NAN_POINT // 2
    steep = F.when(settled >= float(last), last).otherwise(F.floor(settled + 0.5))
    return F.when(F.isnan(value), NAN_POINT).otherwise(steep)


def grid_value(point: ColumnLike, digits: int) -> Column:
    """A grid point back on the scale of the measure."""
    point = as_column(point)
    return F.when(point == NAN_POINT, float("nan")).otherwise(point / 10**digits)


def exact_mean(value: ColumnLike) -> Column:
    """Mean that does not depend on the order of the rows.

    A sum of doubles depends on the order in which shuffle blocks arrive, and a
    mean that falls on a rounding tie then flips between runs. Sums of decimals do
    not. Values or sums beyond 26 whole digits, infinities and NaN take the plain
    average.
    """
    value = as_column(value).cast("double")
    amount = value.try_cast("decimal(38,12)")
    exact = F.try_divide(F.try_sum(amount).cast("double"), F.count(value))
    return F.coalesce(F.when(F.count(amount) == F.count(value), exact), F.avg(value))


def distinct_values(column: ColumnLike) -> Column:
    """Distinct values with NULL counted as one value, as ``distinct().count()`` does."""
    column = as_column(column)
    has_null = F.coalesce(F.max(column.isNull().cast("int")), F.lit(0))
    return F.count_distinct(column) + has_null
