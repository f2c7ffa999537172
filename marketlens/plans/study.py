"""The market study: one function per table of its answers.

``games`` is the cleaned catalogue, ``rows`` its (entity, genre) facts. On a
cluster store both with ``materialise`` first; every function here then reads
only the columns it names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marketlens import operators as ops
from marketlens.functions import (
    AGE_BANDS,
    LIST_LENGTH_BANDS,
    PRICE_BANDS,
    normalise_name,
)
from marketlens.plans.catalogue import (
    ENTITY_TYPE,
    PLATFORMS,
    catalogue_cleaning_report,
    genre_facts,
    with_age_flags,
    with_cleaned_columns,
    with_observed_cleaning,
)
from marketlens.plans.census import market_census, market_tables
from marketlens.sources import describe_schema, materialise, row_count


def publisher_cohort(prefix: str) -> Column:
    """Every publisher whose cleaned name starts with ``prefix``, in any case."""
    return F.col("publisher_clean").rlike(rf"(?i)^\Q{prefix}\E")


# --- loading and cleaning -------------------------------------------------------------


def entity_tags(raw: DataFrame, name: str, k: int = 8) -> DataFrame:
    """The tags of one entity with most votes."""
    return ops.open_map(raw.filter(F.col("name") == name), "tags", keep=["name"], k=k)


def key_check(raw: DataFrame) -> DataFrame:
    return ops.key_audit(raw, "appid", mirror="id")


def type_census(raw: DataFrame) -> DataFrame:
    return ops.value_census(raw, ["type"], unit="count")


def scope_counts(raw: DataFrame) -> DataFrame:
    in_scope = F.coalesce(F.col("type") == ENTITY_TYPE, F.lit(False))
    return ops.threshold_counts(raw, {"kept": in_scope, "dropped": ~in_scope}, unit="rows")


def price_check(games: DataFrame) -> DataFrame:
    return ops.price_facts(
        games,
        price="price_usd",
        free=F.col("is_free"),
        discounted=F.col("discount_pct") > 0,
        below_list=F.col("price") != F.col("initialprice"),
    )


def release_coverage(games: DataFrame) -> DataFrame:
    return ops.date_coverage(games, "release_date_parsed")


def annotated_languages(games: DataFrame) -> DataFrame:
    """Rows whose language list carries a parenthetical note, before and after."""
    return games.filter(F.col("languages").contains("(")).select(
        "name", "languages", "languages_list"
    )


def publisher_spellings(games: DataFrame) -> DataFrame:
    return ops.spelling_census(games, "publisher", normalise_name("publisher"))


def publisher_forms(games: DataFrame, prefix: str) -> DataFrame:
    """Raw against cleaned spelling of one publisher family (case-sensitive prefix)."""
    family = games.filter(F.col("publisher").rlike(rf"^\Q{prefix}\E"))
    return ops.value_census(family, ["publisher", "publisher_clean"], unit="count")


def owner_brackets(games: DataFrame) -> DataFrame:
    return ops.value_census(
        games,
        ["owners", "owners_min", "owners_max"],
        unit="count",
        order_by=[F.asc_nulls_first("owners_min")],
    )


def declared_ages(games: DataFrame, k: int = 25) -> DataFrame:
    return ops.value_census(games, ["required_age", "age_rating"], unit="count", k=k)


def scored_perfect(games: DataFrame, k: int = 5) -> DataFrame:
    return ops.perfect_score_examples(
        games,
        "positive_ratio",
        "reviews",
        "appid",
        ["name", "positive", "negative", "positive_ratio", "wilson_score"],
        k,
    )


# --- the market -----------------------------------------------------------------------


def top_publishers(games: DataFrame, k: int = 20) -> DataFrame:
    sizes = ops.group_sizes(games, "publisher_clean")
    return ops.top_k(sizes, [F.desc("games"), F.asc("publisher_clean")], k)


def publisher_concentration(games: DataFrame) -> DataFrame:
    return ops.concentration(games, "publisher_clean")


def releases_per_year(games: DataFrame) -> DataFrame:
    return ops.calendar_counts(games, "release_year")


def releases_per_month(games: DataFrame, first: int = 2014, last: int = 2021) -> DataFrame:
    complete = F.col("release_year").between(first, last)
    return ops.calendar_counts(games, "release_month", within=complete)


def price_summary(games: DataFrame) -> DataFrame:
    paid = games.filter(~F.col("is_free"))
    ends_99 = F.col("price").try_cast("bigint") % 100 == 99
    return ops.distribution_summary(paid, "price_usd", ending=ends_99)


def price_bands(games: DataFrame) -> DataFrame:
    return ops.band_shares(games, "price_usd", PRICE_BANDS, first=F.col("is_free"))


def discount_overview(games: DataFrame) -> DataFrame:
    return ops.discount_summary(games, "discount_pct")


def discounts_by_band(games: DataFrame) -> DataFrame:
    return ops.conditional_rate_by_band(
        games,
        "price_usd",
        PRICE_BANDS,
        F.col("discount_pct") > 0,
        "discount_pct",
        first=F.col("is_free"),
    )


def language_prevalence(games: DataFrame, k: int = 20) -> DataFrame:
    return ops.label_prevalence(games, "languages_list", "language", k=k)


def language_counts(games: DataFrame) -> DataFrame:
    return ops.band_shares(games, "n_languages", LIST_LENGTH_BANDS, band="languages")


def age_census(games: DataFrame) -> DataFrame:
    return ops.value_census(games, ["age_rating"], unit="games", order_by=["age_rating"])


def age_thresholds(games: DataFrame) -> DataFrame:
    age = F.col("age_rating")
    return ops.threshold_counts(
        games,
        {
            "rated_0": age == 0,
            "rated_above_0": age > 0,
            "rated_16_plus": age >= 16,
            "out_of_range_null": age.isNull(),
        },
    )


def age_group_flags(flagged: DataFrame) -> DataFrame:
    """``flagged`` is the catalogue after ``with_age_flags``."""
    return ops.flag_rates_by_band(
        flagged,
        "age_rating",
        AGE_BANDS,
        {"age_gated": ("age_gated", "pct_gated"), "mature": ("any_mature", "pct_mature")},
    )


def perfect_scores(games: DataFrame) -> DataFrame:
    return ops.perfect_score_count(games, "positive_ratio", "perfect_games")


def best_rated_games(games: DataFrame, k: int = 15) -> DataFrame:
    return ops.best_rated(
        games,
        score="wilson_score",
        ratio="positive_ratio",
        key="appid",
        columns=[
            "name",
            "publisher_clean",
            "reviews",
            "positive_ratio",
            "wilson_score",
            "release_year",
        ],
        k=k,
    )


def cohort_reviews(games: DataFrame, cohort: Column) -> DataFrame:
    return ops.cohort_vs_market(games, "reviews", cohort, "positive_ratio")


# --- genres ---------------------------------------------------------------------------


def genre_shelf(rows: DataFrame, games: DataFrame, k: int = 15) -> DataFrame:
    return ops.label_shelf(rows, games, "genre", k=k)


def genre_satisfaction(rows: DataFrame, min_rows: int = 100) -> DataFrame:
    return ops.median_vs_pooled(
        rows,
        "genre",
        ratio="positive_ratio",
        positive="positive",
        negative="negative",
        min_rows=min_rows,
    )


def cohort_genres(rows: DataFrame, cohort: Column) -> DataFrame:
    return ops.cohort_by_label(rows, "genre", cohort, "positive_ratio")


def publisher_genres(games: DataFrame, top_publishers: int = 8, k: int = 3) -> DataFrame:
    """Reads the catalogue, not its genre facts: only the leaders' lists get exploded."""
    key, total = "publisher_clean", "publisher_games"
    sizes = ops.group_sizes(games, key)
    leaders = ops.largest_groups(sizes, key, k=top_publishers, total=total)
    theirs = ops.members_of_leaders(games, leaders, key)
    rows = ops.explode_labels(theirs, "genres", "genre", keep=[key, total])
    return ops.favourite_labels(rows, key, "genre", group_total=total, k=k)


def genre_value(rows: DataFrame, min_rows: int = 150) -> DataFrame:
    return ops.value_by_label(
        rows,
        "genre",
        paid=~F.col("is_free"),
        price="initial_price_usd",
        value="owners_x_price",
        min_rows=min_rows,
    )


def genre_mix(rows: DataFrame, periods: tuple[int, int] = (2017, 2022), k: int = 12) -> DataFrame:
    return ops.mix_shift(rows, "release_year", periods, "genre", k=k)


# --- platforms ------------------------------------------------------------------------


def platform_reach(games: DataFrame) -> DataFrame:
    return ops.flag_reach(games, PLATFORMS)


def platform_combinations(games: DataFrame) -> DataFrame:
    return ops.flag_combinations(games, PLATFORMS)


def genre_platforms(rows: DataFrame, min_rows: int = 150) -> DataFrame:
    return ops.flag_rate_by_label(rows, "genre", ("mac", "linux"), min_rows=min_rows)


# --- everything at once ---------------------------------------------------------------


def loading_and_cleaning(
    records: DataFrame, games: DataFrame, sample_name: str, prefix: str, report: DataFrame
) -> dict[str, DataFrame]:
    return {
        "schema": describe_schema(records),
        "entity_tags": entity_tags(records, sample_name),
        "key_check": key_check(records),
        "type_census": type_census(records),
        "scope_counts": scope_counts(records),
        "price_check": price_check(games),
        "release_coverage": release_coverage(games),
        "annotated_languages": annotated_languages(games),
        "publisher_spellings": publisher_spellings(games),
        "publisher_forms": publisher_forms(games, prefix),
        "owner_brackets": owner_brackets(games),
        "declared_ages": declared_ages(games),
        "scored_perfect": scored_perfect(games),
        "cleaning_report": report,
    }


def market(games: DataFrame, cohort: Column) -> dict[str, DataFrame]:
    return {
        "top_publishers": top_publishers(games),
        "publisher_concentration": publisher_concentration(games),
        "releases_per_year": releases_per_year(games),
        "releases_per_month": releases_per_month(games),
        "price_summary": price_summary(games),
        "price_bands": price_bands(games),
        "discount_overview": discount_overview(games),
        "discounts_by_band": discounts_by_band(games),
        "language_prevalence": language_prevalence(games),
        "language_counts": language_counts(games),
        "age_census": age_census(games),
        "age_thresholds": age_thresholds(games),
        "age_group_flags": age_group_flags(with_age_flags(games)),
        "perfect_scores": perfect_scores(games),
        "best_rated_games": best_rated_games(games),
        "cohort_reviews": cohort_reviews(games, cohort),
    }


def genres(games: DataFrame, rows: DataFrame, cohort: Column) -> dict[str, DataFrame]:
    return {
        "genre_row_count": row_count(rows, "genre_rows"),
        "genre_shelf": genre_shelf(rows, games),
        "genre_satisfaction": genre_satisfaction(rows),
        "cohort_genres": cohort_genres(rows, cohort),
        "publisher_genres": publisher_genres(games),
        "genre_value": genre_value(rows),
        "genre_mix": genre_mix(rows),
    }


def platforms(games: DataFrame, rows: DataFrame, cohort: Column) -> dict[str, DataFrame]:
    members = games.filter(cohort)
    return {
        "platform_reach": platform_reach(games),
        "platform_combinations": platform_combinations(games),
        "cohort_platform_reach": platform_reach(members),
        "cohort_platform_combinations": platform_combinations(members),
        "genre_platforms": genre_platforms(rows),
    }


def run(
    raw: DataFrame, *, prefix: str, sample_name: str, how: str = "table"
) -> dict[str, DataFrame]:
    """Clean and store the records and their genre facts, then plan every table of the study.

    ``prefix`` names the publisher family compared with the market and
    ``sample_name`` the entity whose tags are opened. The source is parsed once:
    the stored records keep the rows out of scope for the audits, and the
    catalogue is a pushed-down filter over them. The returned tables are lazy. Stored as
    tables, the records are counted for the cleaning report while they are written, and the
    genre facts lie in a folder per year, so that the mix reads two of them. Twelve tables
    come from one census of the catalogue.
    """
    cleaned, rows_by = with_cleaned_columns(raw), ()
    if how == "table":
        cleaned, report = with_observed_cleaning(cleaned)
        rows_by = ("release_year",)
    records = materialise(cleaned, "marketlens_study_records", how)
    report = report() if how == "table" else catalogue_cleaning_report(records)
    games = ops.scope_filter(records, "type", ENTITY_TYPE)
    rows = materialise(genre_facts(games), "marketlens_study_genre_rows", how, rows_by)
    census = materialise(market_census(games), "marketlens_study_census", how)
    cohort = publisher_cohort(prefix)
    return {
        **loading_and_cleaning(records, games, sample_name, prefix, report),
        **market(games, cohort),
        **genres(games, rows, cohort),
        **platforms(games, rows, cohort),
        # What one scan has counted for all of them.
        **market_tables(census),
    }
