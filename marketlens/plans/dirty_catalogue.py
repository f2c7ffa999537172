"""A dirty catalogue derived from ``part`` and ``lineitem``.

Every column is one SQL expression that Spark and DuckDB both read, so the
operators and their oracles start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marketlens.sources import RECORD_SCHEMA

COLUMNS = {
    "appid": "p.p_partkey",
    "id": "CAST(p.p_partkey AS {STR})",
    "name": "p.p_name",
    "type": "CASE WHEN p.p_partkey % 100 = 99 THEN 'demo' ELSE 'game' END",
    "publisher": """CASE WHEN p.p_partkey % 50 = 0 THEN '   '
        WHEN p.p_partkey % 8 IN (1, 3) THEN concat('Solo ', CAST(p.p_partkey AS {STR}))
        WHEN p.p_partkey % 8 = 5 THEN concat('Team ', CAST(p.p_partkey % 160 AS {STR}))
        WHEN p.p_partkey % 8 = 7 THEN concat('Duo ', CAST(p.p_partkey % 800 AS {STR}))
        ELSE concat('  ', p.p_brand, CASE WHEN p.p_partkey % 3 = 0 THEN '™' ELSE '' END, '  ') END""",
    "genre": """CASE WHEN p.p_partkey % 97 = 0 THEN ''
        ELSE concat(p.p_type, ' (note), ', replace(p.p_name, ' ', ', '),
                    CASE WHEN p.p_partkey % 7 = 0 THEN concat(',', p.p_type, ';') ELSE '' END) END""",
    "languages": """CASE p.p_partkey % 5 WHEN 0 THEN 'English, French, German'
        WHEN 1 THEN 'English (full audio), French' WHEN 2 THEN 'English,English' ELSE 'English' END""",
    "tags_json": """concat('{"', p.p_type, '": ', CAST(p.p_size AS {STR}), ', "',
        replace(p.p_brand, '#', ''), '": ', CAST(p.p_size % 7 AS {STR}), '}')""",
    "owners": """CASE WHEN p.p_size <= 30 THEN '0 .. 20,000' WHEN p.p_size <= 45 THEN '20,000 .. 50,000'
        ELSE '10,000,000 .. 20,000,000' END""",
    "initialprice": """CAST(CASE WHEN p.p_partkey % 10 = 0 THEN 0
        ELSE (p.p_size * 100 - 1) END AS {STR})""",
    "price": """CASE WHEN p.p_partkey % 200 = 57 THEN '99999999999999999999'
        WHEN p.p_partkey % 200 = 58 THEN 'n/a' ELSE CAST(CASE WHEN p.p_partkey % 10 = 0 THEN 0 WHEN p.p_partkey % 20 = 1
        THEN (p.p_size * 50) ELSE (p.p_size * 100 - 1) END AS {STR}) END""",
    "discount": "CASE WHEN p.p_partkey % 20 = 1 THEN '50' ELSE '0' END",
    "release_date": """CASE WHEN p.p_partkey % 100 = 12 THEN '2020/06/31' ELSE CASE p.p_partkey % 4
        WHEN 0 THEN concat(CAST(2014 + p.p_size % 9 AS {STR}), '/06/18')
        WHEN 1 THEN concat(CAST(2014 + p.p_size % 9 AS {STR}), '/10/8')
        WHEN 2 THEN concat(CAST(2014 + p.p_size % 9 AS {STR}), '/0', CAST(1 + p.p_size % 9 AS {STR}))
        ELSE '' END END""",
    "required_age": """CASE p.p_partkey % 40 WHEN 0 THEN '180' WHEN 1 THEN 'MA 15+'
        WHEN 2 THEN '21+' WHEN 3 THEN '16' ELSE '0' END""",
    "windows": "(p.p_partkey % 500 <> 0)",
    "mac": "(p.p_size % 4 = 0)",
    "linux": "(p.p_size % 6 = 0)",
    "positive": "COALESCE(r.positive, 0)",
    "negative": "COALESCE(r.negative, 0)",
}


def _expressions(string_type: str) -> list[str]:
    return [f"{sql.replace('{STR}', string_type)} AS {name}" for name, sql in COLUMNS.items()]


def duckdb_sql() -> str:
    """The same catalogue as one SELECT for the oracle."""
    return f"""SELECT {", ".join(_expressions("VARCHAR"))}
FROM part p LEFT JOIN (
  SELECT l_partkey, CAST(SUM(CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END) AS BIGINT) AS positive,
         CAST(SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS negative
  FROM lineitem GROUP BY l_partkey) r ON r.l_partkey = p.p_partkey"""


def dirty_catalogue(part: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Flat rows with JSON text tags.

    Reports that read no review column lose the ``lineitem`` side altogether: the
    optimizer drops an outer join to unique keys that feeds nothing.
    """
    returned = F.col("l_returnflag") == "R"
    reviews = (
        lineitem.groupBy("l_partkey")
        .agg(
            F.count_if(~returned).alias("positive"),
            F.count_if(returned).alias("negative"),
        )
    )
    matched = F.col("r.l_partkey") == F.col("p.p_partkey")
    joined = part.alias("p").join(reviews.alias("r"), matched, "left")
    return joined.selectExpr(*_expressions("STRING"))


def raw_catalogue(part: DataFrame, lineitem: DataFrame) -> DataFrame:
    """The catalogue in the shape of a flattened JSON record: the declared 23 columns."""
    flat = dirty_catalogue(part, lineitem)
    given = {
        "tags": F.from_json("tags_json", RECORD_SCHEMA["tags"].dataType),
        "platforms": F.struct("windows", "mac", "linux"),
        **{name: F.col(name) for name in flat.columns},
    }
    return flat.select(
        "id",
        *[
            given.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name)
            for field in RECORD_SCHEMA
        ],
    )


def nested_records(raw: DataFrame) -> DataFrame:
    """The catalogue as ``{"id": ..., "data": {...}}`` records."""
    return raw.select("id", F.struct(*RECORD_SCHEMA.names).alias("data"))


def write_json_arrays(records: DataFrame, path: str, key: str, per_file: int = 20000) -> None:
    """Write records as JSON array files of at most ``per_file`` records, one array per file.

    ``key`` is a unique integer column path; a slice of it makes one file. A file
    of unbounded size would have to be parsed, and held, by a single task.
    """
    chunk = F.expr(f"{key} div {per_file}").alias("chunk")
    text = F.to_json(F.struct(*[F.col(name) for name in records.columns]))
    arrays = records.groupBy(chunk).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list(text), ","), F.lit("]")).alias("value")
    )
    # One row per chunk: partitionBy gives every array a directory and file of its own.
    arrays.write.mode("overwrite").partitionBy("chunk").text(path)


