"""One JSON array in many tasks: cut at closing braces, whole records restored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from marketlens.sources.json_catalogue import CATALOGUE_SCHEMA, flatten_struct

_PLACE = ["_file", "_block"]


def _outside(text: Column, inside: bool) -> Column:
    """Text without what stands in quotes; ``inside`` if it begins within quotes."""
    if inside:
        text = F.regexp_replace(text, r'\A[^"]*(?:"|\z)', "")
    return F.regexp_replace(text, r'"[^"]*(?:"|\z)', "")


def _scanned_pieces(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The text between closing braces, with its place, its quotes, and by how much the depth
    changes up to the next piece if this one begins outside or inside of quotes."""
    pieces = spark.read.options(**options).option("lineSep", "}").text(path)
    pieces = pieces.select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
        "value",
    )
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    quotes = F.length(plain) - F.length(F.translate(plain, '"', ""))
    change = []
    for inside in (False, True):
        opened = _outside(plain, inside)
        opens = F.length(opened) - F.length(F.translate(opened, "{", ""))
        closes = ((quotes + int(inside)) % 2 == 0).cast("int")
        change.append((opens - closes).cast("long"))
    return pieces.select("*", (quotes % 2).alias("_quotes"),
                         change[0].alias("_if_outside"), change[1].alias("_if_inside"))


def json_array_texts(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """(value): the text of every object that stands in the top-level array of each file.

    Files are cut like lines of text, at every closing brace, so a large file is many tasks'
    work. Whether a piece begins in a string, and how deep, follows from all quotes and
    braces before it: they are summed up per file block, then over the blocks of a file,
    of which there are few, and then within each block. Pieces travel once, to the others
    of their block; only records that cross a block's end meet in a second step.

    Braces, delimiters and escaped quotes within strings do not count. Elements that are no
    objects are left out. ``options`` go to the text reader.
    """
    block = Window.partitionBy(*_PLACE).orderBy("_at")
    upto = block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = block.rowsBetween(Window.unboundedPreceding, -1)
    pieces = _scanned_pieces(spark, path, **options)
    quoted = F.coalesce(F.sum("_quotes").over(before), F.lit(0)) % 2 == 1
    # The state at the start of the block decides which of two cases is meant.
    pieces = pieces.select(
        *_PLACE, "_at", "value", "_quotes", quoted.alias("_quoted"),
        F.when(quoted, F.col("_if_inside")).otherwise(F.col("_if_outside")).alias("_change_0"),
        F.when(quoted, F.col("_if_outside")).otherwise(F.col("_if_inside")).alias("_change_1"),
    )
    blocks = pieces.groupBy(*_PLACE).agg(
        F.sum("_quotes").alias("_quotes"),
        *[F.sum(f"_change_{i}").alias(f"_change_{i}") for i in (0, 1)],
    )
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    blocks = blocks.withColumn("_inside", F.coalesce(F.sum("_quotes").over(earlier), zero) % 2 == 1)
    change = F.when(F.col("_inside"), F.col("_change_1")).otherwise(F.col("_change_0"))
    blocks = blocks.withColumn("_change", change)
    blocks = blocks.select(*_PLACE, "_inside",
                           F.coalesce(F.sum("_change").over(earlier), zero).alias("_depth"))
    pieces = pieces.join(blocks, _PLACE).withColumn("_change", change)
    pieces = pieces.withColumn("_after", F.col("_depth") + F.sum("_change").over(upto))
    in_text = F.col("_quoted") != F.col("_inside")
    starts = ~in_text & (F.col("_after") - F.col("_change") == 0)
    pieces = pieces.withColumns({
        "_record": F.sum(starts.cast("int")).over(upto),
        # A string that is an element itself can hold a brace, too.
        "_open": (F.col("_after") > 0) | (in_text != (F.col("_quotes") == 1)),
    })

    ordered = F.array_sort(F.collect_list(F.struct("_at", "value")))
    text = F.concat(F.array_join(F.transform(ordered, lambda p: p["value"]), "}"), F.lit("}"))
    parts = pieces.groupBy(*_PLACE, "_record").agg(
        text.alias("value"), F.max_by("_open", "_at").alias("_open"))
    closed = (F.col("_record") > 0) & ~F.col("_open")
    whole = parts.filter(closed)
    # What a block ends with, and what the next ones begin with until it is closed.
    order = Window.partitionBy("_file").orderBy("_block", "_record")
    crossing = parts.filter(~closed).withColumn(
        "_number", F.sum((F.col("_record") > 0).cast("int")).over(order))
    ordered = F.array_sort(F.collect_list(F.struct("_block", "value")))
    joined = crossing.groupBy("_file", "_number").agg(
        F.array_join(F.transform(ordered, lambda p: p["value"]), "").alias("value"))
    texts = whole.select("value").unionByName(joined.select("value"))
    own = F.regexp_replace("value", r'\A(?s:[^"{]|"(?:[^"\\]|\\.)*+")*+', "")
    return texts.select(own.alias("value")).filter(F.col("value").startswith("{"))


def read_json_array(
    spark: SparkSession,
    path: str,
    schema: StructType = CATALOGUE_SCHEMA,
    *,
    nested: str | None = "data",
    **options: str,
) -> DataFrame:
    """Records of array files under a declared schema, as ``read_catalogue`` gives them, with
    every file split among tasks. Files need not be of moderate size."""
    texts = json_array_texts(spark, path, **options)
    records = texts.select(F.from_json("value", schema).alias("_record")).select("_record.*")
    return flatten_struct(records, nested) if nested else records
