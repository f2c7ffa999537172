"""Audits: keys, value censuses and the measured effect of cleaning rules.

Each audit is one aggregate over one scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from marketlens.functions.aggregates import count_where
from marketlens.functions.columns import ColumnLike, as_column
from marketlens.operators.ranking import top_k


def key_audit(df: DataFrame, key: str, mirror: str | None = None) -> DataFrame:
    """Rows, distinct keys and, given a second key column, the rows where the two differ."""
    measures = [
        F.count("*").alias("rows"),
        F.count_distinct(key).alias("distinct_keys"),
    ]
    if mirror is not None:
        differs = F.col(mirror) != F.col(key).cast("string")
        measures.append(count_where(differs).alias("mirror_mismatches"))
    return df.agg(*measures)


def value_census(
    df: DataFrame,
    columns: Sequence[str],
    *,
    unit: str = "rows",
    k: int | None = None,
    order_by: Sequence[ColumnLike] | None = None,
) -> DataFrame:
    """Frequency of every value combination, NULL included, most frequent first."""
    counts = df.groupBy(*columns).agg(F.count("*").alias(unit))
    order = list(order_by) if order_by else [F.desc(unit)]
    order += [F.asc_nulls_last(column) for column in columns]
    return counts.orderBy(*order) if k is None else top_k(counts, order, k)


def spelling_census(df: DataFrame, column: str, cleaned: Column) -> DataFrame:
    """Distinct values before and after a cleaning rule; NULL counts as one value.

    ``cleaned`` must depend on ``column`` only: it is then worked out once per
    distinct spelling, not once per row.
    """
    spellings = df.select(column).distinct().select(cleaned.alias("cleaned"))
    forms = spellings.groupBy("cleaned").agg(F.count("*").alias("spellings"))
    return forms.agg(
        F.coalesce(F.sum("spellings"), F.lit(0)).alias("raw_values"),
        F.count("*").alias("clean_values"),
    )


def scope_filter(df: DataFrame, column: str, value: object) -> DataFrame:
    return df.filter(F.col(column) == value)


def price_facts(
    df: DataFrame, *, price: str, free: Column, discounted: Column, below_list: Column
) -> DataFrame:
    return df.agg(
        F.round(F.min(price), 2).alias("min_price"),
        F.round(F.max(price), 2).alias("max_price"),
        count_where(free).alias("free_games"),
        count_where(discounted).alias("discounted"),
        count_where(below_list).alias("price_below_list"),
    )


def date_coverage(df: DataFrame, date: str) -> DataFrame:
    return df.agg(
        F.min(date).alias("first_release"),
        F.max(date).alias("last_release"),
        count_where(F.col(date).isNull()).alias("unparseable"),
    )


def threshold_counts(
    df: DataFrame, conditions: dict[str, Column], *, unit: str = "games"
) -> DataFrame:
    """One row: how many rows meet each named condition, and how many there are."""
    measures = [count_where(condition).alias(name) for name, condition in conditions.items()]
    return df.agg(*measures, F.count("*").alias(unit))


@dataclass(frozen=True)
class Rule:
    """A cleaning rule: its name, what is measured, and which rows it touched.

    The predicate looks at rows in scope, or, with ``out_of_scope``, is replaced
    by "the row was dropped".
    """

    name: str
    measured: str
    touched: Column | None = None


def cleaning_counts(in_scope: Column, rules: Sequence[Rule]) -> list[Column]:
    """One count per rule and the rows in scope, for an aggregate or for ``observe``."""
    kept = F.coalesce(in_scope, F.lit(False))
    touched = [~kept if rule.touched is None else kept & rule.touched for rule in rules]
    hits = [count_where(hit).alias(f"n{position}") for position, hit in enumerate(touched)]
    return [count_where(kept).alias("rows_in"), *hits]


def cleaning_report(df: DataFrame, in_scope: Column, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: rule, rows_in, measured, n.

    All counts come from one aggregate over one scan of the uncut frame; a rule
    without a predicate counts the rows that fall out of scope.
    """
    return cleaning_lines(df.agg(*cleaning_counts(in_scope, rules)), rules)


def cleaning_lines(counts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The report of a row of ``cleaning_counts``."""
    lines = [
        F.struct(
            F.lit(rule.name).alias("rule"),
            F.col("rows_in"),
            F.lit(rule.measured).alias("measured"),
            F.col(f"n{position}").alias("n"),
        )
        for position, rule in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*lines)))


def perfect_score_count(df: DataFrame, ratio: str, name: str = "perfect") -> DataFrame:
    return df.agg(count_where(F.col(ratio) == 1).alias(name))


def perfect_score_examples(
    df: DataFrame, ratio: str, evidence: str, key: str, columns: Sequence[ColumnLike], k: int = 5
) -> DataFrame:
    """The perfect scores that rest on the least evidence."""
    thinnest = top_k(df.filter(F.col(ratio) == 1), [F.asc(evidence), F.asc(key)], k)
    return thinnest.select(*[as_column(column) for column in columns])
