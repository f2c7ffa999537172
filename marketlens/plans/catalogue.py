"""Raw records -> cleaned entities -> (entity, label) facts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, functions as F

from marketlens.functions import (
    AGE_GATED_TAGS,
    MATURE_TAGS,
    cents_to_units,
    flags_from_struct,
    has_any_label,
    is_integer_text,
    normalise_name,
    parse_bounded_int,
    parse_bracket,
    parse_date_shapes,
    positive_ratio,
    split_list,
    value_proxy,
    wilson_lower_bound,
)
from marketlens.operators import (
    Rule,
    cleaning_counts,
    cleaning_lines,
    cleaning_report,
    explode_labels,
    scope_filter,
)

ENTITY_TYPE = "game"
PLATFORMS = ("windows", "mac", "linux")

# What the label reports read; the other columns are not repeated per label.
LABEL_FACT_COLUMNS = (
    "appid",
    "publisher_clean",
    "release_year",
    "is_free",
    "initial_price_usd",
    "owners_x_price",
    "positive",
    "negative",
    "positive_ratio",
    "windows",
    "mac",
    "linux",
)


def with_cleaned_columns(raw: DataFrame) -> DataFrame:
    """Add every derived column; rows are neither dropped nor reordered."""
    owners_min, owners_max, owners_mid = parse_bracket("owners")
    parsed = raw.withColumns(
        {
            "price_usd": cents_to_units("price"),
            "initial_price_usd": cents_to_units("initialprice"),
            "discount_pct": F.col("discount").try_cast("int"),
            "is_free": F.col("price").try_cast("bigint") == 0,
            "release_date_parsed": parse_date_shapes("release_date"),
            "genres": split_list("genre"),
            "languages_list": split_list("languages"),
            "publisher_clean": normalise_name("publisher"),
            "owners_min": owners_min,
            "owners_max": owners_max,
            "owners_mid": owners_mid,
            "age_rating": parse_bounded_int("required_age", 0, 21),
            "reviews": F.col("positive") + F.col("negative"),
            "positive_ratio": positive_ratio("positive", "negative"),
            "wilson_score": wilson_lower_bound("positive", "negative"),
            **flags_from_struct("platforms", PLATFORMS, "n_platforms"),
        }
    )
    return parsed.withColumns(
        {
            "release_year": F.year("release_date_parsed"),
            "release_month": F.month("release_date_parsed"),
            "n_genres": F.size("genres"),
            "n_languages": F.size("languages_list"),
            "owners_x_price": value_proxy("owners_mid", "initial_price_usd"),
        }
    )


def clean(raw: DataFrame) -> DataFrame:
    return with_cleaned_columns(scope_filter(raw, "type", ENTITY_TYPE))


def with_age_flags(
    games: DataFrame, gated: list[str] = AGE_GATED_TAGS, mature: list[str] = MATURE_TAGS
) -> DataFrame:
    tags = F.map_keys("tags")
    return games.withColumns(
        {"age_gated": has_any_label(tags, gated), "mature": has_any_label(tags, mature)}
    )


def genre_facts(games: DataFrame) -> DataFrame:
    return explode_labels(games, "genres", "genre", keep=LABEL_FACT_COLUMNS)


def catalogue_rules() -> list[Rule]:
    """The nine cleaning rules, as predicates on cleaned records.

    Two rules have a second line for values that look right and are lost: amounts beyond
    the integer range, and dates that no calendar has or no shape fits.
    """
    lost = is_integer_text("price") & F.col("price_usd").isNull()
    lost |= is_integer_text("initialprice") & F.col("initial_price_usd").isNull()
    lost |= is_integer_text("discount") & F.col("discount_pct").isNull()
    undated = F.col("release_date_parsed").isNull()
    no_date = F.coalesce(F.trim("release_date") == "", F.lit(True))
    not_numeric = ~is_integer_text("price") | ~is_integer_text("initialprice")
    not_numeric = not_numeric | ~is_integer_text("discount")
    rewritten = ~F.col("publisher").eqNullSafe(F.col("publisher_clean"))
    # Rule names and what is measured.
    return [
        Rule("2.1   drop type != 'game'", "rows dropped"),
        Rule("2.2   price strings -> USD", "non-numeric source", not_numeric),
        Rule("2.2   price strings -> USD", "out of range -> NULL", lost),
        Rule("2.3   release_date -> date", "source empty -> NULL", undated & no_date),
        Rule("2.3   release_date -> date", "unreadable -> NULL", undated & ~no_date),
        Rule("2.4a  genre -> array", "source empty -> []", F.col("n_genres") == 0),
        Rule("2.4b  languages -> array", "source empty -> []", F.col("n_languages") == 0),
        Rule("2.5   publisher name normalised", "values rewritten", rewritten),
        Rule("2.6   owners bracket -> bounds", "unparsed -> NULL", F.col("owners_min").isNull()),
        Rule(
            "2.7   required_age -> 0-21 or NULL",
            "out of range -> NULL",
            F.col("age_rating").isNull(),
        ),
        Rule("2.8   reviews -> Wilson score", "no reviews -> NULL", F.col("wilson_score").isNull()),
    ]


def catalogue_cleaning_report(cleaned: DataFrame) -> DataFrame:
    """Measured effect of the cleaning rules on all records, in scope or not."""
    return cleaning_report(cleaned, F.col("type") == ENTITY_TYPE, catalogue_rules())


def with_observed_cleaning(cleaned: DataFrame) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """The records, and the cleaning report that is counted while they are stored.

    Store the returned frame before asking for the report; it then reads no record. What is
    counted belongs to the first time that the frame is computed.
    """
    counted = Observation("cleaning")
    rules = catalogue_rules()
    observed = cleaned.observe(counted, *cleaning_counts(F.col("type") == ENTITY_TYPE, rules))

    def report() -> DataFrame:
        found = counted.get
        names = ["rows_in", *(f"n{position}" for position in range(len(rules)))]
        schema = ", ".join(f"{name} long" for name in names)
        row = cleaned.sparkSession.createDataFrame([tuple(found[n] for n in names)], schema)
        return cleaning_lines(row, rules)

    return observed, report
