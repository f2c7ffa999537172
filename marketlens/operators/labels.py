"""Multi-label facts: one row per (entity, label)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from marketlens.functions.aggregates import count_where, exact_mean
from marketlens.functions.columns import ColumnLike
from marketlens.operators.medians import RATIO, grouped_medians
from marketlens.operators.ranking import top_k


_POSITION = "_label_position"


def _explode(df: DataFrame, kept: Sequence[str], labels: ColumnLike, label: str) -> DataFrame:
    """Inner explode that works the array out once per row.

    For a plain explode the optimizer infers "not null and not empty" filters below
    it, which repeat the array's whole expression twice. The outer form infers
    nothing; a missing position then marks the rows that had no label.
    """
    opened = df.select(*kept, F.posexplode_outer(labels).alias(_POSITION, label))
    return opened.filter(F.col(_POSITION).isNotNull()).drop(_POSITION)


def explode_labels(
    df: DataFrame, labels: str, label: str, keep: Sequence[str] | None = None
) -> DataFrame:
    """One row per (entity, label); entities without a label vanish.

    Name the columns later steps need in ``keep``: every column carried along is
    repeated for each label, and pruning cannot undo that once it is written.
    """
    kept = [name for name in df.columns if name != label] if keep is None else list(keep)
    return _explode(df, kept, labels, label)


def open_map(
    df: DataFrame,
    map_column: str,
    *,
    keep: Sequence[str],
    key: str = "tag",
    value: str = "votes",
    k: int | None = None,
) -> DataFrame:
    """Map -> (key, value) rows; with ``k`` only those with the largest values."""
    # Map keys are never NULL, so a NULL key can only stand for an empty map.
    opened = df.select(*keep, F.explode_outer(map_column).alias(key, value))
    rows = opened.filter(F.col(key).isNotNull())
    if k is None:
        return rows
    return top_k(rows, [F.desc_nulls_last(value), F.asc(key), *keep], k)


def label_prevalence(
    df: DataFrame,
    labels: ColumnLike,
    label: str,
    *,
    unit: str = "games",
    share: str = "pct_of_games",
    k: int | None = 20,
) -> DataFrame:
    """Entities per label and their percentage of all *entities*, so shares add up to over 100.

    ``labels`` must hold every label once per entity.
    """
    rows = _explode(df, [], labels, label)
    return label_shelf(rows, df, label, unit=unit, share=share, k=k)


def label_shelf(
    rows: DataFrame,
    entities: DataFrame,
    label: str,
    *,
    unit: str = "games",
    share: str = "pct_of_catalogue",
    k: int | None = 15,
) -> DataFrame:
    """Rows per label as a percentage of ``entities``.

    The denominator is a scalar subquery: a count that needs none of the
    entity's columns, planned inside the same query.
    """
    everything = entities.agg(F.count("*")).scalar()
    shelf = (
        rows.groupBy(label)
        .agg(F.count("*").alias(unit))
        .withColumn(share, F.round(100 * F.col(unit) / everything, 1))
    )
    order = [F.desc(unit), F.asc(label)]
    return shelf.orderBy(*order) if k is None else top_k(shelf, order, k)


def median_vs_pooled(
    rows: DataFrame,
    label: str,
    *,
    ratio: str,
    positive: str,
    negative: str,
    unit: str = "games",
    min_rows: int = 100,
) -> DataFrame:
    """Per label: the median entity's ratio against the ratio over all votes."""
    populations = {unit: ("median_positive_ratio", None)}
    votes = {"_positive": positive, "_negative": negative}
    pooled = F.try_divide("_positive", F.col("_positive") + F.col("_negative"))
    return (
        grouped_medians(rows, label, ratio, 3, populations, votes, span=RATIO)
        .filter(F.col(unit) >= min_rows)
        .orderBy(F.desc_nulls_last("median_positive_ratio"), label)
        .select(label, unit, "median_positive_ratio", F.round(pooled, 3).alias("pooled_ratio"))
    )


def value_by_label(
    rows: DataFrame,
    label: str,
    *,
    paid: Column,
    price: str,
    value: str,
    unit: str = "games",
    min_rows: int = 150,
) -> DataFrame:
    """Per label: mean price and mean value in millions, over all rows and over paid rows."""
    paid_price, paid_value = (F.when(paid, F.col(name)) for name in (price, value))
    return (
        rows.groupBy(label)
        .agg(
            F.count("*").alias(unit),
            count_where(paid).alias("paid_games"),
            F.round(exact_mean(price), 2).alias("mean_price_usd"),
            F.round(exact_mean(paid_price), 2).alias("mean_price_paid"),
            F.round(exact_mean(value) / 1e6, 2).alias("stock_value_musd"),
            F.round(exact_mean(paid_value) / 1e6, 2).alias("stock_value_paid_musd"),
        )
        .filter(F.col(unit) >= min_rows)
        .orderBy(F.desc_nulls_last("stock_value_paid_musd"), label)
    )


def mix_shift(
    rows: DataFrame,
    period: str,
    periods: tuple[int, int],
    label: str,
    *,
    prefix: str = "pct",
    k: int | None = 12,
) -> DataFrame:
    """Share of every label among the *labelled rows* of two periods, and the change in points.

    A label missing from a period has a NULL share there. The period totals are
    two rows at most, so they are broadcast; the labels stay distributed.
    """
    early, late = periods
    mix = (
        rows.filter(F.col(period).isin(early, late))
        .groupBy(period, label)
        .agg(F.count("*").alias("n"))
    )
    totals = mix.groupBy(period).agg(F.sum("n").alias("total"))
    shares = (
        mix.join(F.broadcast(totals), period)
        .groupBy(label)
        .pivot(period, [early, late])
        .agg(F.max(F.round(100 * F.col("n") / F.col("total"), 1)))
        .withColumnsRenamed({str(year): f"{prefix}_{year}" for year in periods})
    )
    before, after = F.col(f"{prefix}_{early}"), F.col(f"{prefix}_{late}")
    moved = shares.withColumn("shift_pts", F.round(after - before, 1))
    order = [F.desc_nulls_last(f"{prefix}_{late}"), F.asc(label)]
    return moved.orderBy(*order) if k is None else top_k(moved, order, k)
