"""Many reports from one scan: a census by grouping sets, split up afterwards.

The census has a few hundred rows whatever the size of the catalogue; each table below reads
only them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from marketlens.functions import LIST_LENGTH_BANDS, PRICE_BANDS, Bands, count_where
from marketlens.operators.ranking import few_rows
from marketlens.plans.catalogue import PLATFORMS

KEYS = ("price_rank", "languages_rank", "age_rating", "release_year", "release_month", *PLATFORMS)
PARTS: dict[str, tuple[str, ...]] = {
    "prices": ("price_rank",), "languages": ("languages_rank",), "ages": ("age_rating",),
    "years": ("release_year",), "months": ("release_month",), "platforms": PLATFORMS, "all": (),
}


def _part() -> Column:
    """The name of the grouping set that a row belongs to."""
    absent = {
        part: sum(1 << place for place, key in enumerate(reversed(KEYS)) if key not in keys)
        for part, keys in PARTS.items()
    }
    name = F.lit(None).cast("string")
    for part, number in absent.items():
        name = F.when(F.grouping_id() == number, part).otherwise(name)
    return name


def market_census(games: DataFrame, first: int = 2014, last: int = 2021) -> DataFrame:
    """Counts of the catalogue by price band, length of the language list, age, year, month
    of the complete years ``first`` to ``last``, platforms, and of all rows.

    One scan and one aggregate: each row is counted once in every part, and a task hands on
    a row per value it has met.
    """
    discounted = F.col("discount_pct") > 0
    complete = F.col("release_year").between(first, last)
    facts = games.select(
        PRICE_BANDS.rank("price_usd", F.col("is_free")).alias("price_rank"),
        LIST_LENGTH_BANDS.rank("n_languages").alias("languages_rank"),
        "age_rating", "release_year",
        F.when(complete, F.col("release_month")).alias("release_month"),
        *PLATFORMS,
        F.col("price_usd").alias("_price"), F.col("is_free").alias("_free"),
        discounted.alias("_discounted"),
        F.when(discounted, F.col("discount_pct")).alias("_depth"),
        (F.col("price") != F.col("initialprice")).alias("_below_list"),
        F.col("release_date_parsed").alias("_date"),
        *[F.col(flag).alias(f"_{flag}") for flag in PLATFORMS],
        (F.col("positive_ratio") == 1).alias("_perfect"),
    )
    return facts.groupingSets([list(keys) for keys in PARTS.values()], *KEYS).agg(
        _part().alias("part"), F.count("*").alias("games"),
        count_where(F.col("_free")).alias("free"),
        count_where(F.col("_discounted")).alias("discounted"),
        F.count("_discounted").alias("known_discounts"), F.sum("_depth").alias("depth"),
        count_where(F.col("_below_list")).alias("below_list"),
        F.min("_price").alias("min_price"), F.max("_price").alias("max_price"),
        F.min("_date").alias("first_release"), F.max("_date").alias("last_release"),
        count_where(F.col("_date").isNull()).alias("undated"),
        *[count_where(F.col(f"_{flag}")).alias(f"on_{flag}") for flag in PLATFORMS],
        count_where(F.col("_perfect")).alias("perfect"),
    )


def _banded(rows: DataFrame, rank: str, bands: Bands, band: str) -> DataFrame:
    everything = F.sum("games").over(Window.partitionBy())
    share = F.round(100 * F.col("games") / everything, 1)
    return few_rows(rows).withColumn("pct_games", share).orderBy(rank).select(
        bands.label(rank).alias(band), "games", "pct_games")


def market_tables(census: DataFrame) -> dict[str, DataFrame]:
    """The study's tables that a stored census holds, as its own functions would give them."""
    rows = {part: census.filter(F.col("part") == part) for part in PARTS}
    prices = rows["prices"]
    # An aggregate of the one row, as an empty catalogue has none.
    extremes = ("min_price", "max_price", "first_release", "last_release")
    totals = ("games", "free", "discounted", "below_list", "undated", "perfect",
              *[f"on_{flag}" for flag in PLATFORMS])
    whole = rows["all"].agg(
        *[F.max(name).alias(name) for name in extremes],
        *[F.coalesce(F.sum(name), F.lit(0).cast("long")).alias(name) for name in totals])
    ages = rows["ages"].select("age_rating", "games")
    age, games = F.col("age_rating"), F.col("games")

    def counted(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, games)), F.lit(0).cast("long"))

    rate = F.round(100 * F.try_divide("discounted", "known_discounts"), 1)
    depth = F.round(F.try_divide("depth", "discounted"), 1)
    return {
        "price_check": whole.select(
            F.round("min_price", 2).alias("min_price"), F.round("max_price", 2).alias("max_price"),
            F.col("free").alias("free_games"), "discounted",
            F.col("below_list").alias("price_below_list")),
        "release_coverage": whole.select(
            "first_release", "last_release", F.col("undated").alias("unparseable")),
        "price_bands": _banded(prices, "price_rank", PRICE_BANDS, "band"),
        "discounts_by_band": prices.orderBy("price_rank").select(
            PRICE_BANDS.label("price_rank").alias("band"), "games", "discounted",
            rate.alias("pct_discounted"), depth.alias("mean_discount")),
        "language_counts": _banded(
            rows["languages"], "languages_rank", LIST_LENGTH_BANDS, "languages"),
        "age_census": ages.orderBy("age_rating"),
        "age_thresholds": ages.agg(
            counted(age == 0).alias("rated_0"), counted(age > 0).alias("rated_above_0"),
            counted(age >= 16).alias("rated_16_plus"),
            counted(age.isNull()).alias("out_of_range_null"),
            counted(F.lit(True)).alias("games")),
        "releases_per_year": rows["years"].filter("release_year is not null")
        .select("release_year", "games").orderBy("release_year"),
        "releases_per_month": rows["months"].filter("release_month is not null")
        .select("release_month", "games").orderBy("release_month"),
        "platform_reach": whole.select(
            "games", *[F.col(f"on_{flag}").alias(flag) for flag in PLATFORMS]),
        "platform_combinations": rows["platforms"].select(*PLATFORMS, "games")
        .orderBy(F.desc("games"), *PLATFORMS),
        "perfect_scores": whole.select(F.col("perfect").alias("perfect_games")),
    }
