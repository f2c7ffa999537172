"""Every query the repository offers, bound to tables, with its DuckDB statement."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketlens import operators as ops
from marketlens.functions import (
    GROUP_SIZE_BANDS,
    LIST_LENGTH_BANDS,
    PRICE_BANDS,
    REVIEW_BANDS,
    Bands,
    has_any_label,
    positive_ratio,
    wilson_lower_bound,
)
from marketlens.plans import study
from marketlens.plans.catalogue import (
    catalogue_cleaning_report,
    clean,
    genre_facts,
    with_age_flags,
    with_cleaned_columns,
    with_observed_cleaning,
)
from marketlens.plans.census import PARTS, market_census
from marketlens.plans.dirty_catalogue import nested_records, raw_catalogue, write_json_arrays
from marketlens.plans.oracle_text import (
    any_tag,
    banded,
    mean,
    over_games,
    over_games_and,
    over_raw,
    rounded,
)
from marketlens.sources import (
    NamedTable,
    audit_inferred_keys,
    describe_schema,
    discard,
    flatten_struct,
    literal_rows,
    materialise,
    preview,
    read_catalogue,
    read_json_array,
    row_count,
    shared_folder,
)

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Binding:
    build: Build
    sql: str | None


BINDINGS: dict[str, Binding] = {}


def bind(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    def register(build: Build) -> Build:
        if name in BINDINGS:
            raise ValueError(f"query bound twice: {name}")
        BINDINGS[name] = Binding(build, sql)
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_catalogue(table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem"))


def games_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(raw_of(spark, sf_dir))


def genre_facts_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genre_facts(games_of(spark, sf_dir))


def on_raw(name: str, report: Callable[[DataFrame], DataFrame], sql: str) -> None:
    bind(name, sql)(lambda spark, sf_dir: report(raw_of(spark, sf_dir)))


def on_games(name: str, report: Callable[[DataFrame], DataFrame], sql: str) -> None:
    bind(name, sql)(lambda spark, sf_dir: report(games_of(spark, sf_dir)))


def on_genres(name: str, report: Callable[[DataFrame], DataFrame], sql: str) -> None:
    bind(name, sql)(lambda spark, sf_dir: report(genre_facts_of(spark, sf_dir)))


def scratch(spark: SparkSession, name: str) -> str:
    """A folder of this application that a repeated run overwrites."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}"


#: The last frames each query has stored; earlier ones are given up.
_STORED: dict[str, list[DataFrame]] = {}
_STORED_RUNS = 2


def stored(name: str, frame: DataFrame) -> DataFrame:
    """Remember what a query has stored, so that its repetition leaves no more than the last
    runs' tables and cached blocks behind."""
    frames = [f for f in _STORED.get(name, []) if f.sparkSession.sparkContext._jsc is not None]
    _STORED[name] = [*frames, frame]
    while len(_STORED[name]) > _STORED_RUNS:
        discard(_STORED[name].pop(0))
    return frame


# --- sources and sinks ----------------------------------------------------------------

_SCANNED = [
    "id",
    "appid",
    "name",
    "type",
    "publisher",
    "price",
    "positive",
    "platforms.windows",
    "platforms.linux",
]


def scanned(records: DataFrame) -> DataFrame:
    votes = F.aggregate(F.map_values("tags"), F.lit(0).cast("bigint"), lambda a, b: a + b)
    return records.select(
        *_SCANNED,
        F.size("tags").alias("n_tags"),
        votes.alias("tag_votes"),
        F.col("categories").isNull().alias("no_categories"),
    )


_SCANNED_SQL = over_raw(
    """SELECT id, appid, name, type, publisher, price, positive, windows, linux,
  CAST(len(json_keys(tags_json)) AS INTEGER) AS n_tags,
  CAST(list_sum(CAST(json_extract(tags_json, '$.*') AS BIGINT[])) AS BIGINT) AS tag_votes,
  TRUE AS no_categories FROM cat"""
)


@bind("json_lines_scan", _SCANNED_SQL)
def json_lines_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested records as JSON Lines, the splittable form, read under the declared schema."""
    path = scratch(spark, "json-lines")
    nested_records(raw_of(spark, sf_dir)).write.mode("overwrite").json(path)
    return scanned(read_catalogue(spark, path, multi_line=False))


@bind("json_array_scan", _SCANNED_SQL)
def json_array_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records as array files, each of them split among tasks."""
    path = scratch(spark, "json-arrays")
    write_json_arrays(nested_records(raw_of(spark, sf_dir)), path, key="data.appid")
    return scanned(read_json_array(spark, path, recursiveFileLookup="true"))


@bind(
    "inferred_key_audit",
    over_raw(
        """, tag AS (SELECT DISTINCT unnest(json_keys(tags_json)) AS k FROM cat),
ranked AS (SELECT k, row_number() OVER (ORDER BY k) AS i FROM tag)
SELECT 'data.tags' AS field, COUNT(*) AS n_fields,
  string_agg(k, ', ' ORDER BY k) FILTER (WHERE i <= 5) AS first_fields FROM ranked"""
    ),
)
def inferred_key_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "json-infer")
    keyed = raw_of(spark, sf_dir).select("id", F.struct("appid", "tags").alias("data"))
    keyed.write.mode("overwrite").json(path)
    return audit_inferred_keys(spark, path, "data.tags", multi_line=False)


@bind(
    "struct_flatten",
    over_raw("SELECT id, windows, mac, linux FROM cat"),
)
def struct_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_struct(raw_of(spark, sf_dir).select("id", "platforms"), "platforms")


@bind(
    "schema_report",
    """SELECT CAST(c.ordinal AS INTEGER) AS position, c.name AS "column", c.type AS type, t.n AS rows
FROM (VALUES (1, 'l_orderkey', 'bigint'), (2, 'l_partkey', 'bigint'), (3, 'l_suppkey', 'bigint'),
 (4, 'l_linenumber', 'int'), (5, 'l_quantity', 'double'), (6, 'l_extendedprice', 'double'),
 (7, 'l_discount', 'double'), (8, 'l_tax', 'double'), (9, 'l_returnflag', 'string'),
 (10, 'l_linestatus', 'string'), (11, 'l_shipdate', 'timestamp_ntz')) c(ordinal, name, type),
 (SELECT COUNT(*) AS n FROM lineitem) t""",
)
def schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe_schema(table(spark, sf_dir, "lineitem"))


_PER_TYPE_SQL = over_games(
    """SELECT release_year, is_free, COUNT(*) AS games, CAST(SUM(reviews) AS BIGINT) AS reviews
FROM games GROUP BY release_year, is_free"""
)


def _per_type(games: DataFrame) -> DataFrame:
    return games.groupBy("release_year", "is_free").agg(
        F.count("*").alias("games"), F.sum("reviews").alias("reviews")
    )


@bind("materialised_table", _PER_TYPE_SQL)
def materialised_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    narrow = games_of(spark, sf_dir).select("release_year", "is_free", "reviews")
    return _per_type(stored("games", materialise(narrow, "marketlens_games")))


@bind("materialised_checkpoint", _PER_TYPE_SQL)
def materialised_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    narrow = games_of(spark, sf_dir).select("release_year", "is_free", "reviews")
    return _per_type(materialise(narrow, "games", how="checkpoint"))


@bind("materialised_cache", _PER_TYPE_SQL)
def materialised_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    narrow = games_of(spark, sf_dir).select("release_year", "is_free", "reviews")
    return _per_type(stored("cached games", materialise(narrow, "games", how="cache")))


@bind(
    "materialised_genre_facts",
    over_games(
        """SELECT COUNT(*) AS genre_rows, COUNT(DISTINCT genre) AS genres,
  COUNT(DISTINCT appid) AS games FROM genre_rows"""
    ),
)
def materialised_genre_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = genre_facts_of(spark, sf_dir)
    rows = stored("genre rows", materialise(facts, "marketlens_genre_rows"))
    # Two levels instead of two distinct counts in one, which would triple the rows.
    per_game = rows.groupBy("appid").agg(F.count("*").alias("n"))
    games = per_game.agg(F.sum("n").alias("genre_rows"), F.count("*").alias("games"))
    genres = rows.agg(F.count_distinct("genre")).scalar()
    return games.select("genre_rows", genres.alias("genres"), "games")


@bind("named_table", _PER_TYPE_SQL)
def named_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One name, written twice with different columns; the last content counts."""
    games = NamedTable(spark, "marketlens_games")
    narrow = games_of(spark, sf_dir).select("release_year", "is_free", "reviews")
    games.write(narrow.select("release_year"))
    games.write(narrow)
    games.drop_old(keep=3)
    return _per_type(games.read())


on_games(
    "bounded_preview",
    lambda games: preview(
        games.select("appid", "name", "age_rating", "release_year").orderBy("appid"), 1000
    ),
    over_games("SELECT appid, name, age_rating, release_year FROM games ORDER BY appid LIMIT 1000"),
)
bind("events_row_count", "SELECT COUNT(*) AS rows FROM events")(
    lambda spark, sf_dir: row_count(table(spark, sf_dir, "events"))
)

# --- cleaning -------------------------------------------------------------------------

on_raw(
    "entity_tags",
    lambda raw: study.entity_tags(raw, "small ring"),
    over_raw(
        """, opened AS (SELECT name, unnest(json_keys(tags_json)) AS tag, tags_json FROM cat
 WHERE name = 'small ring')
SELECT name, tag, CAST(json_extract(tags_json, '$.' || tag) AS BIGINT) AS votes
FROM opened ORDER BY votes DESC, tag LIMIT 8"""
    ),
)
on_raw(
    "tag_votes",
    lambda raw: ops.open_map(raw, "tags", keep=["appid"]),
    over_raw(
        """, opened AS (SELECT appid, unnest(json_keys(tags_json)) AS tag, tags_json FROM cat)
SELECT appid, tag, CAST(json_extract(tags_json, '$.' || tag) AS BIGINT) AS votes FROM opened"""
    ),
)
on_raw(
    "key_audit",
    study.key_check,
    over_raw(
        """SELECT COUNT(*) AS rows, COUNT(DISTINCT appid) AS distinct_keys,
  COUNT(*) FILTER (WHERE id <> CAST(appid AS VARCHAR)) AS mirror_mismatches FROM cat"""
    ),
)
on_raw(
    "type_census",
    study.type_census,
    over_raw('SELECT type, COUNT(*) AS "count" FROM cat GROUP BY type'),
)
on_raw(
    "scope_counts",
    study.scope_counts,
    over_raw(
        """SELECT COUNT(*) FILTER (WHERE type = 'game') AS kept,
  COUNT(*) FILTER (WHERE type IS DISTINCT FROM 'game') AS dropped, COUNT(*) AS rows FROM cat"""
    ),
)
on_games(
    "price_facts",
    study.price_check,
    over_games(
        f"""SELECT {rounded("MIN(price_usd)", 2)} AS min_price, {rounded("MAX(price_usd)", 2)} AS max_price,
  COUNT(*) FILTER (WHERE is_free) AS free_games,
  COUNT(*) FILTER (WHERE discount_pct > 0) AS discounted,
  COUNT(*) FILTER (WHERE price <> initialprice) AS price_below_list FROM games"""
    ),
)
on_games(
    "release_coverage",
    study.release_coverage,
    over_games(
        """SELECT MIN(release_date_parsed) AS first_release, MAX(release_date_parsed) AS last_release,
  COUNT(*) FILTER (WHERE release_date_parsed IS NULL) AS unparseable FROM games"""
    ),
)
on_games(
    "parsed_dates",
    lambda games: games.select(
        "appid", "release_date", "release_date_parsed", "release_year", "release_month"
    ),
    over_games(
        "SELECT appid, release_date, release_date_parsed, release_year, release_month FROM games"
    ),
)
on_games(
    "parsed_lists",
    lambda games: games.select(
        "appid",
        F.array_join("genres", "|").alias("genres"),
        "n_genres",
        F.array_join("languages_list", "|").alias("languages"),
        "n_languages",
    ),
    over_games(
        """SELECT appid, array_to_string(genres, '|') AS genres, n_genres,
  array_to_string(languages_list, '|') AS languages, n_languages FROM games"""
    ),
)
on_games(
    "annotated_languages",
    lambda games: study.annotated_languages(games).withColumn(
        "languages_list", F.array_join("languages_list", "|")
    ),
    over_games(
        """SELECT name, languages, array_to_string(languages_list, '|') AS languages_list FROM games
 WHERE contains(languages, '(')"""
    ),
)
on_games(
    "normalised_publishers",
    lambda games: games.select("appid", "publisher", "publisher_clean"),
    over_games("SELECT appid, publisher, publisher_clean FROM games"),
)
on_games(
    "publisher_spellings",
    study.publisher_spellings,
    over_games(
        """SELECT (SELECT COUNT(*) FROM (SELECT DISTINCT publisher FROM games)) AS raw_values,
  (SELECT COUNT(*) FROM (SELECT DISTINCT publisher_clean FROM games)) AS clean_values"""
    ),
)
on_games(
    "publisher_forms",
    lambda games: study.publisher_forms(games, "  Brand#2"),
    over_games(
        """SELECT publisher, publisher_clean, COUNT(*) AS "count" FROM games
 WHERE regexp_matches(publisher, '^  Brand#2') GROUP BY publisher, publisher_clean"""
    ),
)
on_games(
    "owner_brackets",
    study.owner_brackets,
    over_games(
        """SELECT owners, owners_min, owners_max, COUNT(*) AS "count" FROM games
 GROUP BY owners, owners_min, owners_max"""
    ),
)
on_games(
    "declared_ages",
    study.declared_ages,
    over_games(
        """SELECT required_age, age_rating, COUNT(*) AS "count" FROM games GROUP BY required_age, age_rating
 ORDER BY "count" DESC, required_age NULLS LAST LIMIT 25"""
    ),
)
on_games(
    "review_scores",
    lambda games: games.select(
        "appid",
        "reviews",
        F.round("positive_ratio", 9).alias("positive_ratio"),
        F.round("wilson_score", 9).alias("wilson_score"),
    ),
    over_games(
        f"""SELECT appid, reviews, {rounded("positive_ratio", 9)} AS positive_ratio,
  {rounded("wilson_score", 9)} AS wilson_score FROM games"""
    ),
)
on_games(
    "platform_flags",
    lambda games: games.select("appid", "windows", "mac", "linux", "n_platforms"),
    over_games("SELECT appid, windows, mac, linux, n_platforms FROM games"),
)
on_games(
    "value_proxy",
    lambda games: games.select(
        "appid", "owners_mid", "initial_price_usd", F.round("owners_x_price", 2).alias("value")
    ),
    over_games(
        f"""SELECT appid, owners_mid, initial_price_usd, {rounded("owners_x_price", 2)} AS value
 FROM games"""
    ),
)
on_games(
    "perfect_score_examples",
    lambda games: study.scored_perfect(games).withColumn(
        "wilson_score", F.round("wilson_score", 6)
    ),
    over_games(
        f"""SELECT name, positive, negative, positive_ratio, {rounded("wilson_score", 6)} AS wilson_score
 FROM (SELECT * FROM games WHERE positive_ratio = 1 ORDER BY reviews, appid LIMIT 5)"""
    ),
)
on_raw(
    "cleaning_report",
    lambda raw: catalogue_cleaning_report(with_cleaned_columns(raw)),
    over_games(
        "".join(
            [
                "SELECT rule, (SELECT COUNT(*) FROM games) AS rows_in, measured, n FROM (",
                " UNION ALL ".join(
                    f"SELECT '{rule}' AS rule, '{measured}' AS measured,"
                    f" (SELECT COUNT(*) FROM {source}) AS n"
                    for rule, measured, source in [
                        (
                            "2.1   drop type != ''game''",
                            "rows dropped",
                            "cat WHERE type IS DISTINCT FROM 'game'",
                        ),
                        (
                            "2.2   price strings -> USD",
                            "non-numeric source",
                            "games WHERE NOT regexp_matches(price, '^-?\\d+$') OR NOT"
                            " regexp_matches(initialprice, '^-?\\d+$') OR NOT"
                            " regexp_matches(discount, '^-?\\d+$')",
                        ),
                        (
                            "2.2   price strings -> USD",
                            "out of range -> NULL",
                            "games WHERE regexp_matches(price, '^-?\\d+$')"
                            " AND TRY_CAST(price AS BIGINT) IS NULL",
                        ),
                        (
                            "2.3   release_date -> date",
                            "source empty -> NULL",
                            "games WHERE release_date = ''",
                        ),
                        (
                            "2.3   release_date -> date",
                            "unreadable -> NULL",
                            "games WHERE release_date <> '' AND release_date_parsed IS NULL",
                        ),
                        (
                            "2.4a  genre -> array",
                            "source empty -> []",
                            "games WHERE n_genres = 0",
                        ),
                        (
                            "2.4b  languages -> array",
                            "source empty -> []",
                            "games WHERE n_languages = 0",
                        ),
                        (
                            "2.5   publisher name normalised",
                            "values rewritten",
                            "games WHERE publisher IS DISTINCT FROM publisher_clean",
                        ),
                        (
                            "2.6   owners bracket -> bounds",
                            "unparsed -> NULL",
                            "games WHERE owners_min IS NULL",
                        ),
                        (
                            "2.7   required_age -> 0-21 or NULL",
                            "out of range -> NULL",
                            "games WHERE age_rating IS NULL",
                        ),
                        (
                            "2.8   reviews -> Wilson score",
                            "no reviews -> NULL",
                            "games WHERE wilson_score IS NULL",
                        ),
                    ]
                ),
                ")",
            ]
        )
    ),
)

# --- the market -----------------------------------------------------------------------

on_games(
    "top_publishers",
    study.top_publishers,
    over_games(
        """SELECT publisher_clean, COUNT(*) AS games FROM games WHERE publisher_clean IS NOT NULL
 GROUP BY publisher_clean ORDER BY games DESC, publisher_clean LIMIT 20"""
    ),
)


def _concentration_sql(sizes: str, labels: tuple[str, ...], names: tuple[str, str, str], residual: str) -> str:
    """``sizes`` is a SELECT of (k, n), one row per key including the NULL key."""
    groups, unit, share = names
    size = banded("n", GROUP_SIZE_BANDS.edges, labels, first=("k IS NULL", residual))
    return f""", sizes AS ({sizes}),
bands AS (SELECT {size} AS size, COUNT(k) AS g, CAST(SUM(n) AS BIGINT) AS u FROM sizes GROUP BY 1),
everything AS (SELECT SUM(u) AS total FROM bands)
SELECT size, g AS {groups}, u AS {unit}, {rounded("100 * u / total", 1)} AS {share} FROM bands, everything
UNION ALL SELECT 'all', CAST(SUM(g) AS BIGINT), CAST(SUM(u) AS BIGINT),
 {rounded("100 * SUM(u) / MAX(total)", 1)} FROM bands, everything HAVING COUNT(*) > 0"""


on_games(
    "publisher_concentration",
    study.publisher_concentration,
    over_games(
        _concentration_sql(
            "SELECT publisher_clean AS k, COUNT(*) AS n FROM games GROUP BY 1",
            GROUP_SIZE_BANDS.labels,
            ("publishers", "games", "pct_of_catalogue"),
            "no publisher",
        )
    ),
)
on_games(
    "releases_per_year",
    study.releases_per_year,
    over_games(
        """SELECT release_year, COUNT(*) AS games FROM games WHERE release_year IS NOT NULL
 GROUP BY release_year"""
    ),
)
on_games(
    "releases_per_month",
    study.releases_per_month,
    over_games(
        """SELECT release_month, COUNT(*) AS games FROM games WHERE release_year BETWEEN 2014 AND 2021
 GROUP BY release_month"""
    ),
)
on_games(
    "price_summary",
    study.price_summary,
    over_games(
        f"""SELECT {rounded("MIN(price_usd)", 2)} AS min_paid,
  {rounded("quantile_disc(price_usd, 0.5)", 2)} AS median_paid,
  {rounded(mean("price_usd"), 2)} AS mean_paid,
  {rounded("stddev_samp(price_usd)", 2)} AS stddev_paid,
  {rounded("quantile_disc(price_usd, 0.9)", 2)} AS p90,
  {rounded("quantile_disc(price_usd, 0.99)", 2)} AS p99,
  {rounded("MAX(price_usd)", 2)} AS max_paid,
  {rounded("100 * AVG(CAST(TRY_CAST(price AS BIGINT) % 100 = 99 AS INTEGER))", 1)} AS pct_ends_99
FROM games WHERE NOT is_free"""
    ),
)
_PRICE_BAND = banded("price_usd", PRICE_BANDS.edges, PRICE_BANDS.labels, ("is_free", "free"), "unknown")
on_games(
    "price_bands",
    study.price_bands,
    over_games(
        f"""SELECT {_PRICE_BAND} AS band, COUNT(*) AS games,
  {rounded("100 * COUNT(*) / (SELECT COUNT(*) FROM games)", 1)} AS pct_games FROM games GROUP BY 1"""
    ),
)
on_games(
    "discount_summary",
    study.discount_overview,
    over_games(
        f"""SELECT COUNT(*) AS discounted_games,
  {rounded("100 * COUNT(*) / (SELECT COUNT(*) FROM games)", 1)} AS pct_of_catalogue,
  {rounded("AVG(discount_pct)", 1)} AS mean_discount,
  quantile_disc(discount_pct, 0.5) AS median_discount FROM games WHERE discount_pct > 0"""
    ),
)
def _census_sql() -> str:
    """The same counts as one SELECT per part."""
    ranks = {
        "price_rank": f"list_position([{', '.join(map(repr, PRICE_BANDS.all_labels))}], {_PRICE_BAND}) - 1",
        "languages_rank": f"""list_position([{', '.join(map(repr, LIST_LENGTH_BANDS.all_labels))}], {
            banded("n_languages", LIST_LENGTH_BANDS.edges, LIST_LENGTH_BANDS.labels, None, "unknown")}) - 1""",
    }
    month = "CASE WHEN release_year BETWEEN 2014 AND 2021 THEN release_month END"
    columns = {"price_rank": "INTEGER", "languages_rank": "INTEGER", "age_rating": "INTEGER",
               "release_year": "INTEGER", "release_month": "INTEGER", "windows": "BOOLEAN",
               "mac": "BOOLEAN", "linux": "BOOLEAN"}
    given = {name: f"CAST({ranks.get(name, month if name == 'release_month' else name)} AS {kind})"
             for name, kind in columns.items()}
    selects = []
    for part, keys in PARTS.items():
        shown = [f"{given[n] if n in keys else f'CAST(NULL AS {kind})'} AS {n}"
                 for n, kind in columns.items()]
        grouped = f"GROUP BY {', '.join(given[k] for k in keys)}" if keys else ""
        selects.append(f"""SELECT {', '.join(shown)}, '{part}' AS part, COUNT(*) AS games,
  COUNT(*) FILTER (WHERE is_free) AS free, COUNT(*) FILTER (WHERE discount_pct > 0) AS discounted,
  COUNT(discount_pct) AS known_discounts,
  CAST(SUM(discount_pct) FILTER (WHERE discount_pct > 0) AS BIGINT) AS depth,
  COUNT(*) FILTER (WHERE price <> initialprice) AS below_list,
  MIN(price_usd) AS min_price, MAX(price_usd) AS max_price,
  MIN(release_date_parsed) AS first_release, MAX(release_date_parsed) AS last_release,
  COUNT(*) FILTER (WHERE release_date_parsed IS NULL) AS undated,
  COUNT(*) FILTER (WHERE windows) AS on_windows, COUNT(*) FILTER (WHERE mac) AS on_mac,
  COUNT(*) FILTER (WHERE linux) AS on_linux,
  COUNT(*) FILTER (WHERE positive_ratio = 1) AS perfect FROM games {grouped}""")
    return " UNION ALL ".join(selects)


on_games("market_census", market_census, over_games(_census_sql()))
on_games(
    "discounts_by_band",
    study.discounts_by_band,
    over_games(
        f"""SELECT {_PRICE_BAND} AS band, COUNT(*) AS games,
  COUNT(*) FILTER (WHERE discount_pct > 0) AS discounted,
  {rounded("100 * AVG(CAST(discount_pct > 0 AS INTEGER))", 1)} AS pct_discounted,
  {rounded("AVG(discount_pct) FILTER (WHERE discount_pct > 0)", 1)} AS mean_discount
FROM games GROUP BY 1"""
    ),
)
on_games(
    "language_prevalence",
    study.language_prevalence,
    over_games_and(
        "spoken AS (SELECT unnest(languages_list) AS language FROM games)",
        f"""SELECT language, COUNT(*) AS games,
  {rounded("100 * COUNT(*) / (SELECT COUNT(*) FROM games)", 1)} AS pct_of_games
FROM spoken GROUP BY language ORDER BY games DESC, language LIMIT 20""",
    ),
)
on_games(
    "language_counts",
    study.language_counts,
    over_games(
        f"""SELECT {banded("n_languages", LIST_LENGTH_BANDS.edges, LIST_LENGTH_BANDS.labels, missing="unknown")} AS languages,
  COUNT(*) AS games, {rounded("100 * COUNT(*) / (SELECT COUNT(*) FROM games)", 1)} AS pct_games
FROM games GROUP BY 1"""
    ),
)
on_games(
    "age_census",
    study.age_census,
    over_games("SELECT age_rating, COUNT(*) AS games FROM games GROUP BY age_rating"),
)
on_games(
    "age_thresholds",
    study.age_thresholds,
    over_games(
        """SELECT COUNT(*) FILTER (WHERE age_rating = 0) AS rated_0,
  COUNT(*) FILTER (WHERE age_rating > 0) AS rated_above_0,
  COUNT(*) FILTER (WHERE age_rating >= 16) AS rated_16_plus,
  COUNT(*) FILTER (WHERE age_rating IS NULL) AS out_of_range_null, COUNT(*) AS games FROM games"""
    ),
)
# The derived tags are part types and brands, so these stand in for the tag lists.
_GATED = ["Brand2", "Brand17"]
_MATURE = _GATED + ["Brand12", "PROMO", "LARGE"]
_GATED_SQL, _MATURE_SQL = any_tag(_GATED), any_tag(_MATURE)
on_games(
    "tag_flags",
    lambda games: with_age_flags(games, _GATED, _MATURE).select("appid", "age_gated", "mature"),
    over_games(f"SELECT appid, {_GATED_SQL} AS age_gated, {_MATURE_SQL} AS mature FROM games"),
)
on_games(
    "age_group_flags",
    lambda games: study.age_group_flags(with_age_flags(games, _GATED, _MATURE)),
    over_games(
        f"""SELECT CASE WHEN age_rating = 0 THEN 'none declared' WHEN age_rating < 16 THEN '1-15'
    WHEN age_rating >= 16 THEN '16+' ELSE 'unparsed' END AS age_group,
  COUNT(*) AS games, COUNT(*) FILTER (WHERE {_GATED_SQL}) AS age_gated,
  {rounded(f"100 * AVG(CAST({_GATED_SQL} AS INTEGER))", 1)} AS pct_gated,
  COUNT(*) FILTER (WHERE {_MATURE_SQL}) AS any_mature,
  {rounded(f"100 * AVG(CAST({_MATURE_SQL} AS INTEGER))", 1)} AS pct_mature
FROM games GROUP BY 1"""
    ),
)
on_games(
    "perfect_scores",
    study.perfect_scores,
    over_games("SELECT COUNT(*) FILTER (WHERE positive_ratio = 1) AS perfect_games FROM games"),
)
on_games(
    "best_rated_games",
    study.best_rated_games,
    over_games(
        f"""SELECT name, publisher_clean, reviews, {rounded("positive_ratio", 4)} AS positive_ratio,
  {rounded("wilson_score", 4)} AS wilson_score, release_year
FROM (SELECT * FROM games ORDER BY wilson_score DESC NULLS LAST, appid LIMIT 15)"""
    ),
)
_COHORT = "brand#1"
_COHORT_SQL = "regexp_matches(publisher_clean, '(?i)^brand#1')"


def cohort() -> Column:
    return study.publisher_cohort(_COHORT)


on_games(
    "cohort_reviews",
    lambda games: study.cohort_reviews(games, cohort()),
    over_games(
        f"""SELECT {banded("reviews", REVIEW_BANDS.edges, REVIEW_BANDS.labels)} AS reviews_band,
  COUNT(*) AS games, {rounded("quantile_disc(positive_ratio, 0.5)", 3)} AS median_ratio,
  COUNT(*) FILTER (WHERE {_COHORT_SQL}) AS cohort_games,
  {rounded(f"quantile_disc(positive_ratio, 0.5) FILTER (WHERE {_COHORT_SQL})", 3)} AS cohort_median
FROM games WHERE reviews > 0 GROUP BY 1"""
    ),
)

# --- genres ---------------------------------------------------------------------------

bind(
    "genre_shelf",
    over_games(
        f"""SELECT genre, COUNT(*) AS games,
  {rounded("100 * COUNT(*) / (SELECT COUNT(*) FROM games)", 1)} AS pct_of_catalogue
FROM genre_rows GROUP BY genre ORDER BY games DESC, genre LIMIT 15"""
    ),
)(lambda spark, sf_dir: study.genre_shelf(genre_facts_of(spark, sf_dir), games_of(spark, sf_dir)))
on_genres(
    "genre_facts",
    lambda rows: rows.select("appid", "genre", "publisher_clean", "release_year", "is_free"),
    over_games("SELECT appid, genre, publisher_clean, release_year, is_free FROM genre_rows"),
)
on_genres(
    "genre_satisfaction",
    study.genre_satisfaction,
    over_games(
        f"""SELECT genre, COUNT(*) AS games,
  {rounded("quantile_disc(positive_ratio, 0.5)", 3)} AS median_positive_ratio,
  {rounded("SUM(positive) / (SUM(positive) + SUM(negative))", 3)} AS pooled_ratio
FROM genre_rows GROUP BY genre HAVING COUNT(*) >= 100"""
    ),
)
on_genres(
    "cohort_genres",
    lambda rows: study.cohort_genres(rows, cohort()),
    over_games(
        f"""SELECT genre, COUNT(*) FILTER (WHERE {_COHORT_SQL}) AS cohort_games, COUNT(*) AS games,
  {rounded("quantile_disc(positive_ratio, 0.5)", 3)} AS median_positive_ratio
FROM genre_rows GROUP BY genre HAVING cohort_games > 0"""
    ),
)
on_games(
    "publisher_genres",
    study.publisher_genres,
    over_games_and(
        """sizes AS (SELECT publisher_clean, COUNT(*) AS publisher_games FROM games
  WHERE publisher_clean IS NOT NULL GROUP BY 1 ORDER BY publisher_games DESC, publisher_clean LIMIT 8),
counts AS (SELECT publisher_clean, genre, COUNT(*) AS games FROM genre_rows
  WHERE publisher_clean IN (SELECT publisher_clean FROM sizes) GROUP BY 1, 2)""",
        f"""SELECT publisher_clean, genre, games, publisher_games,
  {rounded("100 * games / publisher_games", 1)} AS pct_of_publisher
FROM counts JOIN sizes USING (publisher_clean)
QUALIFY row_number() OVER (PARTITION BY publisher_clean ORDER BY games DESC, genre) <= 3""",
    ),
)
on_genres(
    "genre_value",
    study.genre_value,
    over_games(
        f"""SELECT genre, COUNT(*) AS games, COUNT(*) FILTER (WHERE NOT is_free) AS paid_games,
  {rounded(mean("initial_price_usd"), 2)} AS mean_price_usd,
  {rounded(mean("initial_price_usd", where="NOT is_free"), 2)} AS mean_price_paid,
  {rounded(mean("owners_x_price") + " / 1e6", 2)} AS stock_value_musd,
  {rounded(mean("owners_x_price", "NOT is_free") + " / 1e6", 2)} AS stock_value_paid_musd
FROM genre_rows GROUP BY genre HAVING COUNT(*) >= 150"""
    ),
)


def _mix_sql(mix: str, label: str, early: int, late: int, tail: str) -> str:
    """``mix`` is a SELECT of (p, label, n)."""
    return f""", mix AS ({mix}),
share AS (SELECT p, {label}, {rounded("100 * n / SUM(n) OVER (PARTITION BY p)", 1)} AS pct FROM mix),
wide AS (SELECT {label}, MAX(pct) FILTER (WHERE p = {early}) AS pct_{early},
  MAX(pct) FILTER (WHERE p = {late}) AS pct_{late} FROM share GROUP BY {label})
SELECT *, {rounded(f"pct_{late} - pct_{early}", 1)} AS shift_pts FROM wide {tail}"""


on_genres(
    "genre_mix",
    study.genre_mix,
    over_games(
        _mix_sql(
            """SELECT release_year AS p, genre, COUNT(*) AS n FROM genre_rows
 WHERE release_year IN (2017, 2022) GROUP BY 1, 2""",
            "genre",
            2017,
            2022,
            "ORDER BY pct_2022 DESC NULLS LAST, genre LIMIT 12",
        )
    ),
)



@bind("stored_genre_mix", BINDINGS["genre_mix"].sql)
def stored_genre_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of two years over facts that lie in a folder per year."""
    facts = genre_facts_of(spark, sf_dir).select("release_year", "genre")
    by_year = materialise(facts, "marketlens_genre_years", partition_by=["release_year"])
    return study.genre_mix(stored("genre years", by_year))


@bind("observed_cleaning_report", BINDINGS["cleaning_report"].sql)
def observed_cleaning_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaning report as counted while the records were stored."""
    cleaned, report = with_observed_cleaning(with_cleaned_columns(raw_of(spark, sf_dir)))
    stored("records", materialise(cleaned, "marketlens_records"))
    return report()


# --- platforms ------------------------------------------------------------------------

_REACH = """COUNT(*) AS games, COUNT(*) FILTER (WHERE windows) AS windows,
  COUNT(*) FILTER (WHERE mac) AS mac, COUNT(*) FILTER (WHERE linux) AS linux"""
on_games("platform_reach", study.platform_reach, over_games(f"SELECT {_REACH} FROM games"))
on_games(
    "platform_combinations",
    study.platform_combinations,
    over_games(
        "SELECT windows, mac, linux, COUNT(*) AS games FROM games GROUP BY windows, mac, linux"
    ),
)
on_games(
    "cohort_platform_reach",
    lambda games: study.platform_reach(games.filter(cohort())),
    over_games(f"SELECT {_REACH} FROM games WHERE {_COHORT_SQL}"),
)
on_games(
    "cohort_platform_combinations",
    lambda games: study.platform_combinations(games.filter(cohort())),
    over_games(
        f"""SELECT windows, mac, linux, COUNT(*) AS games FROM games WHERE {_COHORT_SQL}
 GROUP BY windows, mac, linux"""
    ),
)
on_genres(
    "genre_platforms",
    study.genre_platforms,
    over_games(
        f"""SELECT genre, COUNT(*) AS games, {rounded("100 * AVG(CAST(mac AS INTEGER))", 1)} AS pct_mac,
  {rounded("100 * AVG(CAST(linux AS INTEGER))", 1)} AS pct_linux
FROM genre_rows GROUP BY genre HAVING COUNT(*) >= 150"""
    ),
)

# --- the same operators on the large tables -------------------------------------------


@bind(
    "order_key_audit",
    "SELECT COUNT(*) AS rows, COUNT(DISTINCT o_orderkey) AS distinct_keys FROM orders",
)
def order_key_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.key_audit(table(spark, sf_dir, "orders"), "o_orderkey")


@bind(
    "line_status_census",
    """SELECT l_returnflag, l_linestatus, COUNT(*) AS lines FROM lineitem
 GROUP BY l_returnflag, l_linestatus""",
)
def line_status_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return ops.value_census(lines, ["l_returnflag", "l_linestatus"], unit="lines")


_ORDER_BANDS = Bands(GROUP_SIZE_BANDS.edges, ("1 order", "2-5 orders", "6-20 orders", "21+ orders"))


@bind(
    "customer_order_concentration",
    "WITH one AS (SELECT 1)"
    + _concentration_sql(
        "SELECT o_custkey AS k, COUNT(*) AS n FROM orders GROUP BY 1",
        _ORDER_BANDS.labels,
        ("customers", "orders", "pct_of_orders"),
        "no customer",
    ),
)
def customer_order_concentration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.concentration(
        table(spark, sf_dir, "orders"),
        "o_custkey",
        bands=_ORDER_BANDS,
        groups="customers",
        unit="orders",
        share="pct_of_orders",
        residual="no customer",
    )


@bind(
    "largest_customers",
    """SELECT o_custkey, COUNT(*) AS orders FROM orders GROUP BY o_custkey
 ORDER BY orders DESC, o_custkey LIMIT 20""",
)
def largest_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = ops.group_sizes(table(spark, sf_dir, "orders"), "o_custkey", "orders")
    return ops.top_k(sizes, [F.desc("orders"), F.asc("o_custkey")], 20)


@bind(
    "orders_per_year",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, COUNT(*) AS orders FROM orders
 WHERE o_orderdate IS NOT NULL GROUP BY 1""",
)
def orders_per_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("order_year"))
    return ops.calendar_counts(orders, "order_year", unit="orders")


@bind(
    "shipments_per_month",
    """SELECT CAST(month(l_shipdate) AS INTEGER) AS ship_month, COUNT(*) AS lines FROM lineitem
 WHERE year(l_shipdate) BETWEEN 1996 AND 2000 GROUP BY 1""",
)
def shipments_per_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_shipdate", F.month("l_shipdate").alias("ship_month")
    )
    # A range on the column itself, unlike one on its year, reaches the Parquet reader.
    complete = F.col("l_shipdate").between(
        F.lit("1996-01-01").cast("timestamp_ntz"),
        F.lit("2000-12-31 23:59:59.999999").cast("timestamp_ntz"),
    )
    return ops.calendar_counts(lines, "ship_month", unit="lines", within=complete)


_QUANTITY_BANDS = Bands((10, 20, 30, 40), ("1-9", "10-19", "20-29", "30-39", "40+"))
_QUANTITY_BAND = banded("l_quantity", _QUANTITY_BANDS.edges, _QUANTITY_BANDS.labels)


@bind(
    "quantity_bands",
    f"""SELECT {_QUANTITY_BAND} AS band, COUNT(*) AS lines,
  {rounded("100 * COUNT(*) / (SELECT COUNT(*) FROM lineitem)", 1)} AS pct_lines
FROM lineitem GROUP BY 1""",
)
def quantity_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return ops.band_shares(lines, "l_quantity", _QUANTITY_BANDS, unit="lines", share="pct_lines")


@bind(
    "line_discounts_by_quantity",
    f"""SELECT {_QUANTITY_BAND} AS band, COUNT(*) AS lines,
  COUNT(*) FILTER (WHERE l_discount > 0.04) AS deep,
  {rounded("100 * AVG(CAST(l_discount > 0.04 AS INTEGER))", 1)} AS pct_deep,
  {rounded("AVG(CAST(round(l_discount * 100) AS INTEGER)) FILTER (WHERE l_discount > 0.04)", 1)}
    AS mean_discount
FROM lineitem GROUP BY 1""",
)
def line_discounts_by_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.conditional_rate_by_band(
        table(spark, sf_dir, "lineitem"),
        "l_quantity",
        _QUANTITY_BANDS,
        F.col("l_discount") > 0.04,
        F.round(F.col("l_discount") * 100).cast("int"),
        unit="lines",
        hits="deep",
        rate="pct_deep",
    )


@bind(
    "quantity_summary",
    f"""SELECT {rounded("MIN(l_quantity)", 2)} AS min_qty,
  {rounded("quantile_disc(l_quantity, 0.5)", 2)} AS median_qty,
  {rounded(mean("l_quantity"), 2)} AS mean_qty, {rounded("stddev_samp(l_quantity)", 2)} AS stddev_qty,
  {rounded("quantile_disc(l_quantity, 0.9)", 2)} AS p90,
  {rounded("quantile_disc(l_quantity, 0.99)", 2)} AS p99, {rounded("MAX(l_quantity)", 2)} AS max_qty
FROM lineitem""",
)
def quantity_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return ops.distribution_summary(lines, "l_quantity", suffix="qty")


@bind(
    "order_price_summary",
    f"""SELECT {rounded("MIN(o_totalprice)", 2)} AS min_price,
  {rounded("quantile_disc(o_totalprice, 0.5)", 2)} AS median_price,
  {rounded(mean("o_totalprice"), 2)} AS mean_price,
  {rounded("stddev_samp(o_totalprice)", 2)} AS stddev_price,
  {rounded("quantile_disc(o_totalprice, 0.9)", 2)} AS p90,
  {rounded("quantile_disc(o_totalprice, 0.99)", 2)} AS p99,
  {rounded("MAX(o_totalprice)", 2)} AS max_price FROM orders""",
)
def order_price_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return ops.distribution_summary(orders, "o_totalprice", suffix="price")


#: How urgent each order priority is; a small dimension that no table holds.
PRIORITY_CLASSES = (
    ("1-URGENT", "rush"), ("2-HIGH", "rush"), ("3-MEDIUM", "normal"),
    ("4-NOT SPECIFIED", "normal"), ("5-LOW", "normal"),
)
_CLASS_SQL = f"""WITH counts AS (SELECT class, COUNT(*) AS orders FROM orders JOIN (VALUES
  {", ".join(str(row) for row in PRIORITY_CLASSES)}) c(o_orderpriority, class)
  USING (o_orderpriority) GROUP BY class) """


@bind("priority_classes", _CLASS_SQL + "SELECT class, orders FROM counts")
def priority_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per class of a literal dimension; counted before they meet it."""
    classes = literal_rows(spark, PRIORITY_CLASSES, ["o_orderpriority", "class"])
    orders = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    return orders.join(classes, "o_orderpriority").groupBy("class").agg(F.sum("n").alias("orders"))


@bind(
    "priority_class_totals",
    _CLASS_SQL + """SELECT class, orders FROM counts
UNION ALL SELECT 'all', CAST(SUM(orders) AS BIGINT) FROM counts""",
)
def priority_class_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.with_total_row(priority_classes(spark, sf_dir), "class", "orders")


@bind(
    "priority_mix_shift",
    "WITH one AS (SELECT 1)"
    + _mix_sql(
        """SELECT CAST(year(o_orderdate) AS INTEGER) AS p, o_orderpriority, COUNT(*) AS n FROM orders
 WHERE year(o_orderdate) IN (1996, 2000) GROUP BY 1, 2""",
        "o_orderpriority",
        1996,
        2000,
        "",
    ),
)
def priority_mix_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("order_year"), "o_orderpriority"
    )
    return ops.mix_shift(orders, "order_year", (1996, 2000), "o_orderpriority", k=None)


@bind(
    "supplier_part_types",
    f"""WITH sizes AS (SELECT l_suppkey, COUNT(*) AS supplier_lines FROM lineitem GROUP BY 1
  ORDER BY supplier_lines DESC, l_suppkey LIMIT 8),
counts AS (SELECT l_suppkey, p_type, COUNT(*) AS lines FROM lineitem JOIN part ON l_partkey = p_partkey
  WHERE l_suppkey IN (SELECT l_suppkey FROM sizes) GROUP BY 1, 2)
SELECT l_suppkey, p_type, lines, supplier_lines,
  {rounded("100 * lines / supplier_lines", 1)} AS pct_of_supplier
FROM counts JOIN sizes USING (l_suppkey)
QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY lines DESC, p_type) <= 3""",
)
def supplier_part_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey")
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    sizes = ops.group_sizes(lines, "l_suppkey", "lines")
    leaders = ops.largest_groups(sizes, "l_suppkey", unit="lines", total="supplier_lines")
    # Cut to eight suppliers, then collapse repeated parts: a part ordered on a third of
    # all lines reaches the join to parts as at most eight rows.
    repeats = (
        ops.members_of_leaders(lines, leaders, "l_suppkey")
        .groupBy("l_suppkey", "supplier_lines", "l_partkey")
        .agg(F.count("*").alias("repeats"))
    )
    return ops.favourite_labels(
        repeats.join(parts, "l_partkey"),
        "l_suppkey",
        "p_type",
        unit="lines",
        group_total="supplier_lines",
        share="pct_of_supplier",
        weight="repeats",
    )


@bind(
    "largest_customers_orders",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey IN (
  SELECT o_custkey FROM orders GROUP BY o_custkey ORDER BY COUNT(*) DESC, o_custkey LIMIT 8)""",
)
def largest_customers_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    leaders = ops.largest_groups(ops.group_sizes(orders, "o_custkey"), "o_custkey")
    kept = ops.keep_members(orders, leaders, "o_custkey")
    return kept.select("o_orderkey", "o_custkey", "o_totalprice")


def _line_flags(lines: DataFrame) -> DataFrame:
    return lines.select(
        (F.col("l_returnflag") == "R").alias("returned"),
        (F.col("l_linestatus") == "O").alias("open"),
        (F.col("l_discount") > 0).alias("discounted"),
    )


_LINE_FLAGS = ("returned", "open", "discounted")
_LINE_FLAGS_SQL = """(SELECT l_returnflag = 'R' AS returned, l_linestatus = 'O' AS "open",
 l_discount > 0 AS discounted FROM lineitem)"""


@bind(
    "line_flag_reach",
    f"""SELECT COUNT(*) AS lines, COUNT(*) FILTER (WHERE returned) AS returned,
  COUNT(*) FILTER (WHERE "open") AS "open", COUNT(*) FILTER (WHERE discounted) AS discounted
FROM {_LINE_FLAGS_SQL}""",
)
def line_flag_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.flag_reach(_line_flags(table(spark, sf_dir, "lineitem")), _LINE_FLAGS, "lines")


@bind(
    "line_flag_combinations",
    f"""SELECT returned, "open", discounted, COUNT(*) AS lines FROM {_LINE_FLAGS_SQL}
GROUP BY returned, "open", discounted""",
)
def line_flag_combinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.flag_combinations(
        _line_flags(table(spark, sf_dir, "lineitem")), _LINE_FLAGS, "lines"
    )


@bind(
    "event_flag_rates",
    f"""SELECT event_type, COUNT(*) AS events,
  {rounded("100 * AVG(CAST(value > 10 AS INTEGER))", 1)} AS pct_costly,
  {rounded("100 * AVG(CAST(hour(ts) < 6 AS INTEGER))", 1)} AS pct_night
FROM events GROUP BY event_type HAVING COUNT(*) >= 100""",
)
def event_flag_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_type",
        (F.col("value") > 10).alias("costly"),
        (F.hour("ts") < 6).alias("night"),
    )
    return ops.flag_rate_by_label(
        events, "event_type", ("costly", "night"), unit="events", min_rows=100
    )


@bind(
    "event_properties",
    """SELECT event_id, 'k' AS property, CAST(json_extract(props, '$.k') AS BIGINT) AS amount FROM events
 WHERE json_extract(props, '$.k') IS NOT NULL ORDER BY amount DESC, event_id LIMIT 8""",
)
def event_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties of any type; those that are whole numbers are ranked."""
    events = event_objects(spark, sf_dir)
    opened = ops.open_object(events, "props", keep=["event_id"], key="property")
    amount = F.try_variant_get("value", "$", "bigint")
    amounts = opened.select("event_id", "property", amount.alias("amount"))
    return ops.top_k(amounts, [F.desc_nulls_last("amount"), "property", "event_id"], 8)


def event_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select("event_id", F.try_parse_json("props").alias("props"))


#: Besides the given property, one whose values are of four types.
_MIXED_PROPS = """concat('{"k": ', json_extract(props, '$.k'), ', "mixed": ',
  CASE event_id % 4 WHEN 0 THEN '"text"' WHEN 1 THEN '12' WHEN 2 THEN '{"a": [1]}' ELSE '[true]' END,
  '}')"""


@bind(
    "event_property_types",
    f"""WITH p AS (SELECT {_MIXED_PROPS} AS props FROM events),
o AS (SELECT unnest(json_keys(props)) AS property, props FROM p),
t AS (SELECT property, json_type(json_extract(props, '$.' || property)) AS kind FROM o)
SELECT property, CASE kind WHEN 'VARCHAR' THEN 'STRING' WHEN 'UBIGINT' THEN 'BIGINT' ELSE kind END
  AS type, COUNT(*) AS events FROM t GROUP BY 1, 2""",
)
def event_property_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often every property occurs with which type of value."""
    events = table(spark, sf_dir, "events")
    mixed = F.expr(_MIXED_PROPS.replace("json_extract", "get_json_object"))
    objects = events.select(F.try_parse_json(mixed).alias("props"))
    return ops.key_census(objects, "props", key="property", unit="events")


@bind(
    "event_property_values",
    f"""WITH p AS (SELECT event_id, json_extract({_MIXED_PROPS}, '$.mixed') AS v FROM events)
SELECT event_id, CASE json_type(v) WHEN 'VARCHAR' THEN 'STRING' WHEN 'UBIGINT' THEN 'BIGINT'
    ELSE json_type(v) END AS type,
  CASE WHEN json_type(v) = 'UBIGINT' THEN CAST(v AS DOUBLE) END AS number,
  CASE WHEN json_type(v) = 'VARCHAR' THEN v ->> '$' END AS text,
  CASE WHEN json_type(v) IN ('OBJECT', 'ARRAY') THEN CAST(v AS VARCHAR) END AS json FROM p""",
)
def event_property_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One property's values, whatever their types."""
    mixed = F.expr(_MIXED_PROPS.replace("json_extract", "get_json_object"))
    events = table(spark, sf_dir, "events").select(
        "event_id", F.try_parse_json(mixed).alias("props"))
    opened = ops.open_object(events, "props", keep=["event_id"]).filter("key = 'mixed'")
    parts = [part.alias(name) for name, part in ops.typed_parts("value").items()]
    return opened.select("event_id", *parts)


@bind(
    "segment_value",
    f"""WITH c AS (SELECT c_mktsegment, c_acctbal, c_acctbal * 1000 AS stock, c_acctbal > 0 AS paid
 FROM customer)
SELECT c_mktsegment, COUNT(*) AS customers, COUNT(*) FILTER (WHERE paid) AS paid_games,
  {rounded(mean("c_acctbal"), 2)} AS mean_price_usd,
  {rounded(mean("c_acctbal", where="paid"), 2)} AS mean_price_paid,
  {rounded(mean("stock") + " / 1e6", 2)} AS stock_value_musd,
  {rounded(mean("stock", "paid") + " / 1e6", 2)} AS stock_value_paid_musd
FROM c GROUP BY c_mktsegment HAVING COUNT(*) >= 10""",
)
def segment_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").withColumn("stock", F.col("c_acctbal") * 1000)
    return ops.value_by_label(
        customers,
        "c_mktsegment",
        paid=F.col("c_acctbal") > 0,
        price="c_acctbal",
        value="stock",
        unit="customers",
        min_rows=10,
    )


@bind(
    "customer_cohort_orders",
    f"""WITH c AS (SELECT o_custkey, COUNT(*) AS n, COUNT(*) FILTER (WHERE o_orderstatus = 'F') / COUNT(*) AS ratio
  FROM orders GROUP BY o_custkey),
m AS (SELECT n, ratio, c_mktsegment = 'BUILDING' AS member FROM c JOIN customer ON o_custkey = c_custkey)
SELECT {banded("n", REVIEW_BANDS.edges, REVIEW_BANDS.labels)} AS orders_band, COUNT(*) AS customers,
  {rounded("quantile_disc(ratio, 0.5)", 3)} AS median_ratio,
  COUNT(*) FILTER (WHERE member) AS building_customers,
  {rounded("quantile_disc(ratio, 0.5) FILTER (WHERE member)", 3)} AS building_median
FROM m GROUP BY 1""",
)
def customer_cohort_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    finished = F.col("o_orderstatus") == "F"
    votes = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count_if(finished).alias("done"), F.count_if(~finished).alias("pending"))
    )
    customers = votes.join(
        table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), "c_custkey"
    ).select(
        (F.col("done") + F.col("pending")).alias("orders"),
        positive_ratio("done", "pending").alias("ratio"),
        "c_mktsegment",
    )
    return ops.cohort_vs_market(
        customers,
        "orders",
        F.col("c_mktsegment") == "BUILDING",
        "ratio",
        band="orders_band",
        unit="customers",
        cohort_name="building",
    )


@bind(
    "order_price_medians",
    f"""SELECT o_orderpriority, COUNT(*) AS orders,
  {rounded("quantile_disc(o_totalprice, 0.5)", 2)} AS median_price,
  COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS finished_orders,
  {rounded("quantile_disc(o_totalprice, 0.5) FILTER (WHERE o_orderstatus = 'F')", 2)} AS finished_median
FROM orders GROUP BY 1""",
)
def order_price_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians of a wide measure: nearly every order has a price of its own."""
    finished = F.col("o_orderstatus") == "F"
    populations = {"orders": ("median_price", None), "finished_orders": ("finished_median", finished)}
    medians = ops.grouped_medians(
        table(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice", 2, populations)
    return medians.select(
        "o_orderpriority", "orders", "median_price", "finished_orders", "finished_median")


@bind(
    "best_rated_sources",
    f"""WITH v AS (SELECT source, COUNT(*) FILTER (WHERE quality = 1) AS good,
  COUNT(*) FILTER (WHERE quality <> 1) AS bad FROM documents JOIN labels USING (doc_id) GROUP BY source),
w AS (SELECT source, good, bad, good + bad AS n, good / (good + bad) AS p FROM v)
SELECT source, good, bad, {rounded("p", 4)} AS ratio, {rounded(
        "(p + 1.96::DOUBLE*1.96/(2*n) - 1.96*sqrt((p*(1-p) + 1.96::DOUBLE*1.96/(4*n))/n))"
        " / (1 + 1.96::DOUBLE*1.96/n)", 4)} AS score
FROM w ORDER BY (p + 1.96::DOUBLE*1.96/(2*n) - 1.96*sqrt((p*(1-p) + 1.96::DOUBLE*1.96/(4*n))/n))
  / (1 + 1.96::DOUBLE*1.96/n) DESC, source LIMIT 10""",
)
def best_rated_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = F.col("quality") == 1
    votes = (
        table(spark, sf_dir, "documents")
        .select("doc_id", "source")
        .join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
        .groupBy("source")
        .agg(F.count_if(good).alias("good"), F.count_if(~good).alias("bad"))
        .withColumns(
            {"ratio": positive_ratio("good", "bad"), "score": wilson_lower_bound("good", "bad")}
        )
    )
    return ops.best_rated(
        votes,
        score="score",
        ratio="ratio",
        key="source",
        columns=["source", "good", "bad", "ratio", "score"],
        k=10,
    )


_WORDS = r"[ \n\t\r]+"


def _words(text: str) -> Column:
    return F.array_remove(F.split(text, _WORDS), "")


_WORDS_SQL = f"list_filter(regexp_split_to_array(text, '{_WORDS}'), lambda w: w <> '')"


@bind(
    "word_prevalence",
    f"""WITH w AS (SELECT unnest(list_distinct({_WORDS_SQL})) AS word FROM documents)
SELECT word, COUNT(*) AS documents,
  {rounded("100 * COUNT(*) / (SELECT COUNT(*) FROM documents)", 1)} AS pct_of_documents
FROM w GROUP BY word ORDER BY documents DESC, word LIMIT 20""",
)
def word_prevalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return ops.label_prevalence(
        documents,
        F.array_distinct(_words("text")),
        "word",
        unit="documents",
        share="pct_of_documents",
    )


@bind("frequent_words", BINDINGS["word_prevalence"].sql)
def frequent_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same leaders; rare words are never shuffled one by one."""
    return ops.frequent_labels(
        table(spark, sf_dir, "documents"), F.array_distinct(_words("text")), "word",
        unit="documents", share="pct_of_documents")


_LENGTH_BANDS = Bands((500, 2000, 10000), ("short", "medium", "long", "very long"))
_ARTICLES = ["The", "the", "Der", "der"]
_SMALL_WORDS = _ARTICLES + ["And", "and", "Und", "und"]


def _any_word_sql(words: list[str]) -> str:
    return f"list_has_any({_WORDS_SQL}, [{', '.join(repr(word) for word in words)}])"


@bind(
    "document_word_flags",
    f"""SELECT {banded("n_chars", _LENGTH_BANDS.edges, _LENGTH_BANDS.labels)} AS length,
  COUNT(*) AS documents, COUNT(*) FILTER (WHERE {_any_word_sql(_ARTICLES)}) AS with_article,
  {rounded(f"100 * AVG(CAST({_any_word_sql(_ARTICLES)} AS INTEGER))", 1)} AS pct_article,
  COUNT(*) FILTER (WHERE {_any_word_sql(_SMALL_WORDS)}) AS with_small_word,
  {rounded(f"100 * AVG(CAST({_any_word_sql(_SMALL_WORDS)} AS INTEGER))", 1)} AS pct_small_word
FROM documents GROUP BY 1""",
)
def document_word_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = _words("text")
    flagged = table(spark, sf_dir, "documents").select(
        "n_chars",
        has_any_label(words, _ARTICLES).alias("article"),
        has_any_label(words, _SMALL_WORDS).alias("small_word"),
    )
    return ops.flag_rates_by_band(
        flagged,
        "n_chars",
        _LENGTH_BANDS,
        {
            "article": ("with_article", "pct_article"),
            "small_word": ("with_small_word", "pct_small_word"),
        },
        band="length",
        unit="documents",
    )
