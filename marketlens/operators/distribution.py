"""Calendars, bands and one-row summaries of a measure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from marketlens.functions.aggregates import (
    count_where,
    exact_mean,
    pct_where,
)
from marketlens.functions.bands import Bands
from marketlens.functions.columns import ColumnLike, as_column
from marketlens.operators.quantiles import exact_quantiles
from marketlens.operators.ranking import few_rows


def calendar_counts(
    df: DataFrame, part: str, *, unit: str = "games", within: Column | None = None
) -> DataFrame:
    """Rows per calendar part in calendar order; undated rows are left out."""
    dated = df.filter(F.col(part).isNotNull() if within is None else within)
    return dated.groupBy(part).agg(F.count("*").alias(unit)).orderBy(part)


def distribution_summary(
    df: DataFrame,
    value: str,
    *,
    suffix: str = "paid",
    digits: int = 2,
    ending: Column | None = None,
    ending_name: str = "pct_ends_99",
) -> DataFrame:
    """Min, median, mean, deviation, p90, p99, max and the share of a price ending.

    The quantiles are exact at any number of rows: values of the frame, selected together
    in passes of their own over this one column.
    """
    names = {f"median_{suffix}": 0.5, "p90": 0.9, "p99": 0.99}
    measures = {
        f"min_{suffix}": F.round(F.min(value), digits),
        f"mean_{suffix}": F.round(exact_mean(value), digits),
        f"stddev_{suffix}": F.round(F.stddev(value), digits),
        f"max_{suffix}": F.round(F.max(value), digits),
    }
    if ending is not None:
        measures[ending_name] = pct_where(ending)
    summary = df.agg(*[measure.alias(name) for name, measure in measures.items()])
    summary = summary.withColumn("_found", exact_quantiles(df, value, list(names.values())))
    summary = summary.withColumns(
        {name: F.round(F.col("_found")[i], digits) for i, name in enumerate(names)}
    )
    order = [f"{name}_{suffix}" for name in ("min", "median", "mean", "stddev")]
    order += ["p90", "p99", f"max_{suffix}"]
    return summary.select(*order, *([] if ending is None else [ending_name]))


def band_shares(
    df: DataFrame,
    value: ColumnLike,
    bands: Bands,
    *,
    first: Column | None = None,
    band: str = "band",
    unit: str = "games",
    share: str = "pct_games",
) -> DataFrame:
    """Rows and percentage of all rows per band, in band order.

    The bands partition the rows, so the denominator is the sum of the counts: no
    second scan, and the window sees one row per band.
    """
    per_band = df.groupBy(bands.rank(value, first).alias("rank")).agg(F.count("*").alias(unit))
    everything = F.sum(unit).over(Window.partitionBy())
    return (
        few_rows(per_band)
        .withColumn(share, F.round(100 * F.col(unit) / everything, 1))
        .orderBy("rank")
        .select(bands.label("rank").alias(band), unit, share)
    )


def discount_summary(df: DataFrame, discount: str) -> DataFrame:
    """Discounted rows, their share of all rows, mean and median discount.

    The median is exact at any number of rows.
    """
    on_sale = F.col(discount) > 0
    depths = df.select(F.when(on_sale, F.col(discount)).alias("depth"))
    median = exact_quantiles(depths, "depth", [0.5])[0]
    return depths.agg(
        F.count("depth").alias("discounted_games"),
        F.round(F.try_divide(100 * F.count("depth"), F.count("*")), 1).alias("pct_of_catalogue"),
        F.round(F.avg("depth"), 1).alias("mean_discount"),
    ).withColumn("median_discount", median.cast("int"))


def conditional_rate_by_band(
    df: DataFrame,
    value: ColumnLike,
    bands: Bands,
    predicate: Column,
    depth: ColumnLike,
    *,
    first: Column | None = None,
    band: str = "band",
    unit: str = "games",
    hits: str = "discounted",
    rate: str = "pct_discounted",
    mean: str = "mean_discount",
) -> DataFrame:
    """Per band: rows, matching rows, their rate, and the mean of ``depth`` among them."""
    per_band = df.groupBy(bands.rank(value, first).alias("rank")).agg(
        F.count("*").alias(unit),
        count_where(predicate).alias(hits),
        pct_where(predicate).alias(rate),
        F.round(F.avg(F.when(predicate, as_column(depth))), 1).alias(mean),
    )
    labelled = [bands.label("rank").alias(band), unit, hits, rate, mean]
    return few_rows(per_band).orderBy("rank").select(*labelled)


def flag_rates_by_band(
    df: DataFrame,
    value: ColumnLike,
    bands: Bands,
    flags: dict[str, tuple[str, str]],
    *,
    band: str = "age_group",
    unit: str = "games",
) -> DataFrame:
    """Per band: rows, then count and percentage of every flag.

    ``flags`` maps a flag column to the names of its count and its percentage.
    """
    measures = []
    for flag, (hits, rate) in flags.items():
        measures += [count_where(F.col(flag)).alias(hits), pct_where(F.col(flag)).alias(rate)]
    names = [name for pair in flags.values() for name in pair]
    per_band = df.groupBy(bands.rank(value).alias("rank")).agg(F.count("*").alias(unit), *measures)
    return few_rows(per_band).orderBy("rank").select(bands.label("rank").alias(band), unit, *names)
