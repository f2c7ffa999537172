"""The most frequent labels, with only labels that can be among them counted one by one."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marketlens.functions.columns import ColumnLike
from marketlens.operators.labels import _explode
from marketlens.operators.ranking import top_k

#: Labels are first counted together, in this many buckets.
BUCKETS = 1 << 16
#: Labels of as many of the fullest buckets are counted to find out how frequent the last
#: of the leading labels is at least.
LEADING = 256


def _bucketed(rows: DataFrame, label: str, buckets: int) -> DataFrame:
    return rows.withColumn("_bucket", F.pmod(F.xxhash64(label), F.lit(buckets)))


def candidate_buckets(rows: DataFrame, label: str, k: int, buckets: int = BUCKETS) -> DataFrame:
    """(_bucket): all buckets that can hold one of the ``k`` most frequent labels.

    A label is at most as frequent as its bucket. ``k`` labels of the fullest buckets are
    counted exactly; the least frequent of them is a bound that the last of the leading
    labels reaches, so buckets below it hold none. With fewer than ``k`` labels there
    the bound is zero and every bucket stays: what is counted then is more, never less.
    """
    counts = _bucketed(rows, label, buckets).groupBy("_bucket").agg(F.count("*").alias("_most"))
    fullest = top_k(counts, [F.desc("_most"), F.asc("_bucket")], LEADING).select("_bucket")
    known = _counted(rows, label, fullest, buckets, "_n")
    leaders = known.orderBy(F.desc("_n")).limit(k).agg(
        F.when(F.count("*") >= k, F.min("_n")).otherwise(0))
    return counts.filter(F.col("_most") >= leaders.scalar()).select("_bucket")


def _counted(rows: DataFrame, label: str, kept: DataFrame, buckets: int, unit: str) -> DataFrame:
    """Exact counts of the labels in some buckets, of which there are ``buckets`` at most."""
    own = _bucketed(rows, label, buckets).join(F.broadcast(kept), "_bucket", "left_semi")
    return own.groupBy(label).agg(F.count("*").alias(unit))


def frequent_labels(
    df: DataFrame,
    labels: ColumnLike,
    label: str,
    *,
    unit: str = "games",
    share: str = "pct_of_games",
    k: int = 20,
    buckets: int = BUCKETS,
) -> DataFrame:
    """The ``k`` most frequent labels with exact counts and percentages of the entities.

    The same rows as ``label_prevalence`` gives. That shuffles every label a task has met;
    here the tasks hand on a count per bucket, and then the labels of the few buckets that
    can lead. It reads the entities three times instead of once, so it pays where labels are
    many, mostly rare, and more costly to shuffle than to read.
    """
    rows = _explode(df, [], labels, label)
    counts = _counted(rows, label, candidate_buckets(rows, label, k, buckets), buckets, unit)
    everything = df.agg(F.count("*")).scalar()
    shelf = counts.withColumn(share, F.round(100 * F.col(unit) / everything, 1))
    return top_k(shelf, [F.desc(unit), F.asc(label)], k)
