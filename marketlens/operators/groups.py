"""Group sizes, their concentration, and what the largest groups favour."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from marketlens.functions.bands import GROUP_SIZE_BANDS, Bands
from marketlens.functions.aggregates import count_where
from marketlens.operators.ranking import few_rows, top_k, top_k_per_group


def group_sizes(df: DataFrame, key: str, unit: str = "games") -> DataFrame:
    """Rows per key; rows without a key belong to no group.

    Counting the key leaves 0 for the NULL group, which goes after the aggregate.
    A NOT NULL filter would be pushed to the scan and work out a derived key twice.
    """
    return df.groupBy(key).agg(F.count(key).alias(unit)).filter(F.col(unit) > 0)


def concentration(
    df: DataFrame,
    key: str,
    *,
    bands: Bands = GROUP_SIZE_BANDS,
    groups: str = "publishers",
    unit: str = "games",
    share: str = "pct_of_catalogue",
    residual: str = "no publisher",
    total: str = "all",
) -> DataFrame:
    """Histogram of group sizes, with a row for keyless rows and a grand total.

    One scan and one shuffle on the key: the keyless rows are the NULL group of
    the same aggregate (absent when there are none) and ROLLUP adds the total.
    From the second aggregate on there is one row per band.
    """
    sizes = df.groupBy(key).agg(F.count("*").alias(unit))
    has_key = F.col(key).isNotNull()
    residual_rank = len(bands.all_labels)
    by_band = (
        sizes.select(
            F.when(has_key, bands.rank(unit)).otherwise(residual_rank).alias("band"),
            has_key.alias("has_key"),
            unit,
        )
        .rollup("band")
        .agg(
            F.grouping("band").alias("is_total"),
            count_where(F.col("has_key")).alias(groups),
            F.sum(unit).alias(unit),
        )
    )
    size = (
        F.when(F.col("is_total") == 1, total)
        .when(F.col("band") == residual_rank, residual)
        .otherwise(bands.label(F.least(F.col("band"), F.lit(residual_rank - 1))))
    )
    # The total row is the largest; the frame holds one row per band.
    catalogue = F.max(unit).over(Window.partitionBy())
    return (
        few_rows(by_band)
        .withColumn(share, F.round(100 * F.col(unit) / catalogue, 1))
        .orderBy(
            (F.col("is_total") == 1) | (F.col("band") == residual_rank), groups, "is_total", "band"
        )
        .select(size.alias("size"), groups, unit, share)
    )


def largest_groups(
    sizes: DataFrame, key: str, *, unit: str = "games", k: int = 8, total: str | None = None
) -> DataFrame:
    """The ``k`` largest groups; ``total`` renames their size."""
    leaders = top_k(sizes, [F.desc(unit), F.asc(key)], k)
    return leaders if total is None else leaders.withColumnRenamed(unit, total)


def keep_members(df: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in ``members``; Spark sizes the join, nothing is collected."""
    return df.join(members.select(key), key, "left_semi")


def members_of_leaders(df: DataFrame, leaders: DataFrame, key: str) -> DataFrame:
    """Rows of the leading groups, each with its group's total.

    ``leaders`` comes from ``largest_groups``, so it has k rows whatever the data
    and is safe to broadcast: rows are cut before anything is exploded or shuffled.
    """
    return df.join(F.broadcast(leaders), key)


def with_total_row(
    counts: DataFrame, label: str, unit: str = "games", total: str = "all"
) -> DataFrame:
    """Counts per label followed by their sum, the columns matched by name.

    Both halves read the same aggregate, whose exchange Spark reuses.
    """
    whole = counts.agg(
        F.coalesce(F.sum(unit), F.lit(0)).alias(unit), F.lit(total).alias(label)
    )
    return counts.select(label, unit).unionByName(whole)


def favourite_labels(
    rows: DataFrame,
    key: str,
    label: str,
    *,
    unit: str = "games",
    group_total: str = "publisher_games",
    share: str = "pct_of_publisher",
    k: int = 3,
    weight: str | None = None,
) -> DataFrame:
    """Each group's most frequent labels and their share of the group's entities.

    ``rows`` holds one row per (entity, label) with the group's number of entities
    in ``group_total``, as ``members_of_leaders`` gives it. Rows that were
    pre-aggregated carry their number in ``weight``.
    """
    size = F.count("*") if weight is None else F.sum(weight)
    counts = rows.groupBy(key, group_total, label).agg(size.alias(unit))
    return (
        top_k_per_group(counts, key, [F.desc(unit), F.asc(label)], k)
        .withColumn(share, F.round(100 * F.col(unit) / F.col(group_total), 1))
        .orderBy(key, "rank")
        .select(key, label, unit, group_total, share)
    )
