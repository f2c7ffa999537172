"""Global and per-group top-k with deterministic ties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from marketlens.functions.columns import ColumnLike


def top_k(df: DataFrame, order: Sequence[ColumnLike], k: int) -> DataFrame:
    """First ``k`` rows; end ``order`` with a key so that ties cannot vary.

    Every task keeps k rows, so no full sort takes place.
    """
    return df.orderBy(*order).limit(k)


def few_rows(df: DataFrame) -> DataFrame:
    """An aggregate with one row per band, kept in one partition.

    What its last task reads is one row per band and map task. Windows without a
    key and sorts over it then need no shuffle of their own.
    """
    return df.coalesce(1)


def top_k_per_group(
    df: DataFrame, group: str, order: Sequence[ColumnLike], k: int, rank: str = "rank"
) -> DataFrame:
    """First ``k`` rows of every group. Feed it aggregated rows, never raw ones."""
    position = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn(rank, position).filter(F.col(rank) <= k)


def best_rated(
    df: DataFrame,
    *,
    score: str,
    ratio: str,
    key: str,
    columns: Sequence[Column | str],
    k: int = 15,
    digits: int = 4,
) -> DataFrame:
    """Top rows by confidence-adjusted score, without any floor on the evidence."""
    best = top_k(df, [F.desc_nulls_last(score), F.asc(key)], k)
    rounded = {name: F.round(name, digits) for name in (ratio, score)}
    return best.withColumns(rounded).select(*columns)
