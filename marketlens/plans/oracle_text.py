"""Pieces of the DuckDB statements that the queries are checked against."""

from __future__ import annotations

from marketlens.plans.dirty_catalogue import duckdb_sql


def rounded(expression: str, digits: int) -> str:
    """Half-up on the shortest decimal text of a double, as Spark rounds."""
    return f"CAST(round(CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def mean(expression: str, where: str = "TRUE") -> str:
    """The average, summed with compensation so that the order of rows does not show."""
    return f"favg(CAST({expression} AS DOUBLE)) FILTER (WHERE {where})"


def any_tag(tags: list[str]) -> str:
    wanted = ", ".join(f"'{tag}'" for tag in tags)
    return f"list_has_any(json_keys(tags_json), [{wanted}])"


def _labels(column: str) -> str:
    """Trimmed pieces of a comma-separated column, still with blanks and repeats."""
    bare = f"regexp_replace({column}, '\\([^)]*\\)|[;*]', '', 'g')"
    return f"list_transform(string_split({bare}, ','), lambda x: trim(x))"


def _deduped(pieces: str) -> str:
    return f"list_filter({pieces}, lambda x, i: x <> '' AND list_position({pieces}, x) = i)"


# 1.96 is the normal quantile of a 95 % interval.
_WILSON = """CASE WHEN reviews > 0 THEN
  (positive_ratio + 1.96::DOUBLE*1.96/(2*reviews)
   - 1.96 * sqrt((positive_ratio*(1-positive_ratio) + 1.96::DOUBLE*1.96/(4*reviews))/reviews))
  / (1 + 1.96::DOUBLE*1.96/reviews) END"""

_CLEANED = f"""cleaned AS (
  SELECT *, CAST(year(release_date_parsed) AS INTEGER) AS release_year,
    CAST(month(release_date_parsed) AS INTEGER) AS release_month,
    CAST(len(genres) AS INTEGER) AS n_genres, CAST(len(languages_list) AS INTEGER) AS n_languages,
    (owners_min + owners_max) / 2 AS owners_mid,
    (owners_min + owners_max) / 2 * initial_price_usd AS owners_x_price,
    CASE WHEN age BETWEEN 0 AND 21 THEN age END AS age_rating,
    {_WILSON} AS wilson_score
  FROM (
    SELECT *, {_deduped("genre_pieces")} AS genres, {_deduped("language_pieces")} AS languages_list
    FROM (
      SELECT *, TRY_CAST(price AS BIGINT) / 100 AS price_usd,
        TRY_CAST(initialprice AS BIGINT) / 100 AS initial_price_usd,
        TRY_CAST(discount AS INTEGER) AS discount_pct, TRY_CAST(price AS BIGINT) = 0 AS is_free,
        CASE WHEN regexp_matches(release_date, '^\\d{{4}}/\\d{{1,2}}/\\d{{1,2}}$')
               THEN CAST(try_strptime(release_date, '%Y/%m/%d') AS DATE)
             WHEN regexp_matches(release_date, '^\\d{{4}}/\\d{{1,2}}$')
               THEN CAST(try_strptime(release_date || '/1', '%Y/%m/%d') AS DATE)
             END AS release_date_parsed,
        {_labels("genre")} AS genre_pieces, {_labels("languages")} AS language_pieces,
        NULLIF(trim(regexp_replace(regexp_replace(publisher, '[®™]', '', 'g'), '\\s+', ' ', 'g')), '')
          AS publisher_clean,
        TRY_CAST(regexp_extract(replace(owners, ',', ''), '^(\\d+)', 1) AS BIGINT) AS owners_min,
        TRY_CAST(regexp_extract(replace(owners, ',', ''), '\\.\\.\\s*(\\d+)$', 1) AS BIGINT)
          AS owners_max,
        TRY_CAST(regexp_extract(required_age, '(\\d+)', 1) AS INTEGER) AS age,
        positive + negative AS reviews,
        CASE WHEN positive + negative > 0 THEN positive / (positive + negative) END AS positive_ratio,
        CAST(windows AS INTEGER) + CAST(mac AS INTEGER) + CAST(linux AS INTEGER) AS n_platforms
      FROM cat)))"""

_CAT = f"cat AS ({duckdb_sql()})"
_GAMES = "games AS (SELECT * FROM cleaned WHERE type = 'game')"
_ROWS = "genre_rows AS (SELECT * EXCLUDE (genre), unnest(genres) AS genre FROM games)"


def over_raw(body: str) -> str:
    return f"WITH {_CAT} {body}"


def over_games(body: str) -> str:
    """``cleaned`` (all rows), ``games`` (in scope) and ``genre_rows`` are in reach of ``body``."""
    return f"WITH {_CAT}, {_CLEANED}, {_GAMES}, {_ROWS} {body}"


def over_games_and(ctes: str, body: str) -> str:
    return over_games(f", {ctes} {body}")


def banded(
    value: str, edges: tuple, labels: tuple, first: tuple[str, str] | None = None,
    missing: str | None = None,
) -> str:
    """CASE text of a banding; NULL falls into ``missing``, or else into the last band."""
    head = f"WHEN {first[0]} THEN '{first[1]}' " if first else ""
    body = " ".join(f"WHEN {value} < {edge} THEN '{text}'" for edge, text in zip(edges, labels))
    if missing is not None:
        head += f"WHEN {value} IS NULL THEN '{missing}' "
    return f"CASE {head}{body} ELSE '{labels[-1]}' END"
