"""Objects with open key sets and mixed values, as VARIANT columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from marketlens.functions.columns import ColumnLike, as_column
from marketlens.operators.ranking import top_k


def value_type(value: ColumnLike) -> Column:
    """OBJECT, ARRAY, STRING, BIGINT, DECIMAL, DOUBLE, BOOLEAN, or VOID for a JSON null."""
    return F.regexp_extract(F.schema_of_variant(value), r"\A(\w+)", 1)


def typed_parts(value: ColumnLike) -> dict[str, Column]:
    """A value of any type as columns: its type, and the value as a number or as text if it
    is one, else as JSON. Strings that look like numbers stay text."""
    value = as_column(value)
    kind = value_type(value)
    number = kind.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")
    nested = kind.isin("OBJECT", "ARRAY", "BOOLEAN")
    return {
        "type": kind,
        "number": F.when(number, F.try_variant_get(value, "$", "double")),
        "text": F.when(kind == "STRING", F.try_variant_get(value, "$", "string")),
        "json": F.when(nested, F.to_json(value)),
    }


def open_object(
    df: DataFrame, variant: str, *, keep: Sequence[str], key: str = "key", value: str = "value"
) -> DataFrame:
    """Object -> (key, value) rows, each value a VARIANT of its own type.

    Arrays, scalars, NULL and empty objects give no row. The keys are rows from the start,
    so their number is bounded by no schema.
    """
    exploded = df.sparkSession.tvf.variant_explode(F.col(variant).outer())
    exploded = exploded.select(F.col("key").alias("_key"), F.col("value").alias("_value"))
    # The elements of an array come without a key.
    opened = df.lateralJoin(exploded).filter(F.col("_key").isNotNull())
    return opened.select(*keep, F.col("_key").alias(key), F.col("_value").alias(value))


def key_census(
    df: DataFrame, variant: str, *, key: str = "key", unit: str = "rows", k: int | None = None
) -> DataFrame:
    """How often every key of an object occurs with which type of value.

    Counts are combined before their shuffle; with ``k`` only the most frequent stay.
    """
    opened = open_object(df.select(variant), variant, keep=[], key=key, value="_opened")
    counts = opened.groupBy(key, value_type("_opened").alias("type")).agg(
        F.count("*").alias(unit))
    return counts if k is None else top_k(counts, [F.desc(unit), F.asc(key), F.asc("type")], k)


def inferred_fields(df: DataFrame, variant: str, first: int = 5) -> DataFrame:
    """The columns that schema inference would make of an object's keys: their number, and
    the names of the ``first`` of them in one row.

    As in inference there are none if any value is neither an object nor null. The keys are
    counted as rows, so no schema of their number is ever built.
    """
    given = df.select(variant).filter(F.col(variant).isNotNull() & ~F.is_variant_null(variant))
    other = given.filter(value_type(variant) != "OBJECT").agg(F.count("*")).scalar()
    keys = open_object(given, variant, keep=[]).select("key").distinct()
    leading = top_k(keys, ["key"], first).agg(F.array_sort(F.collect_list("key"))).scalar()
    return keys.agg(F.count("*").alias("n")).select(
        F.when(other > 0, 0).otherwise(F.col("n")).alias("n_fields"),
        F.when(other > 0, "").otherwise(F.array_join(leading, ", ")).alias("first_fields"),
    )
