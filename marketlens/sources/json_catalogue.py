"""Semi-structured JSON catalogues: ``{"id": ..., "data": {...}}`` per record."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, LongType, MapType, StringType, StructType

# The fields of one record. ``tags`` is an object with an open key
# set, so it is a map: inference would turn every key ever seen into a column.
_TAGS = MapType(StringType(), LongType())
_PLATFORMS = StructType().add("windows", "boolean").add("mac", "boolean").add("linux", "boolean")
RECORD_FIELDS = {
    "appid": "long",
    "name": "string",
    "short_description": "string",
    "developer": "string",
    "publisher": "string",
    "genre": "string",
    "tags": _TAGS,
    "type": "string",
    "categories": ArrayType(StringType()),
    "owners": "string",
    "positive": "long",
    "negative": "long",
    "price": "string",
    "initialprice": "string",
    "discount": "string",
    "ccu": "long",
    "languages": "string",
    "platforms": _PLATFORMS,
    "release_date": "string",
    "required_age": "string",
    "website": "string",
    "header_image": "string",
}
RECORD_SCHEMA = StructType()
for _name, _type in RECORD_FIELDS.items():
    RECORD_SCHEMA.add(_name, _type)
CATALOGUE_SCHEMA = StructType().add("id", "string").add("data", RECORD_SCHEMA)


def flatten_struct(df: DataFrame, struct: str) -> DataFrame:
    """Put the struct's fields in its place, next to the other columns."""
    return df.select(*[f"`{name}`.*" if name == struct else f"`{name}`" for name in df.columns])


def read_catalogue(
    spark: SparkSession,
    path: str,
    schema: StructType = CATALOGUE_SCHEMA,
    *,
    multi_line: bool = True,
    nested: str | None = "data",
    spread: int | None = None,
    **options: str,
) -> DataFrame:
    """Read JSON under a declared schema, which spares the inference pass.

    ``multi_line`` reads files that hold one array (or one pretty-printed object)
    each; one task parses all of such a file. ``read_json_array`` splits large arrays
    among tasks. ``spread`` deals the rows out to that many partitions, so that cleaning
    does not stay on the task that parsed them.
    """
    reader = spark.read.schema(schema).option("multiLine", multi_line).options(**options)
    records = reader.json(path)
    if spread:
        records = records.repartition(spread)
    return flatten_struct(records, nested) if nested else records
