"""Reach and combinations of boolean flags. Filter the frame first to read a cohort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from marketlens.functions.aggregates import count_where, pct_where


def flag_reach(df: DataFrame, flags: Sequence[str], unit: str = "games") -> DataFrame:
    """One row: all rows and the rows carrying each flag."""
    return df.agg(
        F.count("*").alias(unit), *[count_where(F.col(flag)).alias(flag) for flag in flags]
    )


def flag_combinations(df: DataFrame, flags: Sequence[str], unit: str = "games") -> DataFrame:
    """Rows per combination of flags, most frequent first; k flags give 3^k rows at most."""
    combinations = df.groupBy(*flags).agg(F.count("*").alias(unit))
    return combinations.orderBy(F.desc(unit), *flags)


def flag_rate_by_label(
    rows: DataFrame, label: str, flags: Sequence[str], *, unit: str = "games", min_rows: int = 150
) -> DataFrame:
    """Per label with enough rows: percentage of rows carrying each flag."""
    return (
        rows.groupBy(label)
        .agg(
            F.count("*").alias(unit),
            *[pct_where(F.col(flag)).alias(f"pct_{flag}") for flag in flags],
        )
        .filter(F.col(unit) >= min_rows)
        .orderBy(F.desc_nulls_last(f"pct_{flags[0]}"), label)
    )
