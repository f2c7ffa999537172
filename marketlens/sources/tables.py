"""Derived tables, previews and schema reports."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder


def materialise(
    df: DataFrame, name: str, how: str = "table", partition_by: Sequence[str] = ()
) -> DataFrame:
    """Compute a frame that later steps re-read once, and return the stored form.

    ``table`` writes a Parquet table to the shared folder: it cuts lineage, survives
    lost executors and is what a cluster should use. Every call has a table and a
    folder of its own, ``name`` and a fresh suffix, so earlier results stay readable;
    ``discard`` removes one. ``checkpoint`` does the same without a table name;
    ``cache`` keeps lineage and recomputes lost blocks. For a name that lasts, see
    ``NamedTable``.

    A table can be ``partition_by`` columns that later steps select on: they then read the
    folders of the values they ask for. Rows are dealt out by these columns first, large
    values to several tasks, so that the folders hold few files.
    """
    spark = df.sparkSession
    if how == "cache":
        return df.cache()
    if how == "checkpoint":
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(shared_folder(spark))
        return df.checkpoint()
    if how != "table":
        raise ValueError(f"unknown way to materialise: {how}")
    unique = f"{name}_{uuid.uuid4().hex}"
    location = f"{shared_folder(spark)}/tables/{spark.sparkContext.applicationId}/{unique}"
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    writer = rows.write.format("parquet").option("path", location)
    writer = writer.partitionBy(*partition_by) if partition_by else writer
    writer.saveAsTable(unique)
    stored = spark.table(unique).select(df.columns)
    stored.stored_as = (unique, location)
    return stored


def discard(stored: DataFrame) -> None:
    """Give up a stored frame: drop its table and files, or its cached blocks."""
    spark = stored.sparkSession
    if not hasattr(stored, "stored_as"):
        stored.unpersist()
        return
    unique, location = stored.stored_as
    spark.sql(f"DROP TABLE IF EXISTS {unique}")
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def preview(df: DataFrame, n: int = 1000) -> DataFrame:
    """At most ``n`` rows; nullable integers stay integers because nothing leaves Spark."""
    return df.limit(n)


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def literal_rows(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    """A handful of Python tuples as a frame, for small reports."""
    return spark.createDataFrame(list(rows), list(names))


def describe_schema(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, and the table's row count."""
    entries = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(field.name).alias("column"),
            F.lit(field.dataType.simpleString()).alias("type"),
        )
        for position, field in enumerate(df.schema.fields, start=1)
    ]
    return row_count(df).select(F.inline(F.array(*entries)), "rows")
