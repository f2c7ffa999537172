"""What schema inference would make of objects with open key sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from marketlens.operators.objects import inferred_fields
from marketlens.sources.json_arrays import json_array_texts


def json_texts(spark: SparkSession, path: str, *, multi_line: bool = True) -> DataFrame:
    """(value): the text of every record, of array files or of JSON Lines."""
    if multi_line:
        return json_array_texts(spark, path)
    return spark.read.text(path).filter(F.trim("value") != "")


def audit_inferred_keys(
    spark: SparkSession, path: str, field_path: str, *, multi_line: bool = True, first: int = 5
) -> DataFrame:
    """How many columns schema inference would invent for a keyed object, and the first few.

    Returns one row ``(field, n_fields, first_fields)``. The records are parsed to VARIANT and
    the object's keys counted as rows, so no schema of all keys is merged on the driver. An
    unreadable record, also one that repeats a key, counts as one without the object.
    """
    texts = json_texts(spark, path, multi_line=multi_line)
    parts = "".join(f'["{part}"]' for part in field_path.split("."))
    objects = texts.select(
        F.try_variant_get(F.try_parse_json("value"), f"${parts}", "variant").alias("object"))
    found = inferred_fields(objects, "object", first)
    return found.select(F.lit(field_path).alias("field"),
                        F.col("n_fields").cast("bigint").alias("n_fields"), "first_fields")
