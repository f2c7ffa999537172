"""A cohort (any predicate) against the whole market."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marketlens.functions.bands import REVIEW_BANDS, Bands
from marketlens.operators.medians import RATIO, grouped_medians
from marketlens.operators.ranking import few_rows


def cohort_vs_market(
    df: DataFrame,
    evidence: str,
    cohort: Column,
    ratio: str,
    *,
    bands: Bands = REVIEW_BANDS,
    band: str = "reviews_band",
    unit: str = "games",
    cohort_name: str = "cohort",
    digits: int = 3,
    span: tuple[float, float] | None = RATIO,
) -> DataFrame:
    """Per evidence band: rows and median ratio of the market and of the cohort.

    Pass ``span=None`` for a measure that is no ratio.
    """
    voted = df.filter(F.col(evidence) > 0).select(
        bands.rank(evidence).alias("rank"), F.col(ratio).alias("ratio"), cohort.alias("member")
    )
    members, member_median = f"{cohort_name}_{unit}", f"{cohort_name}_median"
    populations = {unit: ("median_ratio", None), members: (member_median, F.col("member"))}
    return (
        few_rows(grouped_medians(voted, "rank", "ratio", digits, populations, span=span))
        .orderBy("rank")
        .select(bands.label("rank").alias(band), unit, "median_ratio", members, member_median)
    )


def cohort_by_label(
    rows: DataFrame,
    label: str,
    cohort: Column,
    ratio: str,
    *,
    unit: str = "games",
    cohort_name: str = "cohort",
) -> DataFrame:
    """Per label the cohort appears in: its rows, all rows and the market's median ratio."""
    members = f"{cohort_name}_{unit}"
    populations = {members: ("_member_median", cohort), unit: ("median_positive_ratio", None)}
    return (
        grouped_medians(rows, label, ratio, 3, populations, span=RATIO)
        .filter(F.col(members) > 0)
        .orderBy(F.desc(members), label)
        .select(label, members, unit, "median_positive_ratio")
    )
