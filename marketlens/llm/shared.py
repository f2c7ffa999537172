"""Stored intermediate tables, global row numbers and bounded units of pairwise work."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ROW_BITS = 33


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it; a test without one gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="shared-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def ship(spark: SparkSession) -> None:
    """Give the executors' Python this package, once an application."""
    context = spark.sparkContext
    if getattr(context, "_shipped", None) == context.applicationId:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    above = os.path.dirname(package)
    archive = os.path.join(tempfile.mkdtemp(), "package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, above))
    context.addPyFile(archive)
    context._shipped = context.applicationId


class Shared:
    """Tables in the shared folder: they cut lineage and outlive lost executors."""

    def __init__(self, spark: SparkSession):
        ship(spark)
        self.spark = spark
        application = spark.sparkContext.applicationId
        self.root = f"{shared_folder(spark)}/llm/{application}/{uuid.uuid4().hex}"
        self._paths: dict[int, str] = {}

    def path(self) -> str:
        return f"{self.root}/{uuid.uuid4().hex}"

    def put(self, df: DataFrame) -> DataFrame:
        """Compute a frame once; later steps read the stored rows."""
        path = self.path()
        df.write.parquet(path)
        stored = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(stored)] = path
        return stored

    def drop(self, *frames: DataFrame) -> None:
        """Delete stored tables that nothing reads any more."""
        for frame in frames:
            self.remove(self._paths.pop(id(frame)))

    def remove(self, path: str) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


def numbered(shared: Shared, df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Rows with consecutive numbers from 0 in a global order, stored.

    Range partitions are sorted and numbered one by one; only one count per
    partition is summed up, so no task sees more than its own range.
    """
    local = df.repartitionByRange(*order).sortWithinPartitions(*order)
    local = shared.put(local.withColumn("_m", F.monotonically_increasing_id()))
    part = F.shiftright("_m", ROW_BITS)
    row = F.col("_m").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    counts = sorted(tuple(r) for r in local.groupBy(part.alias("p")).count().collect())
    before, starts = 0, []
    for p, n in counts:
        starts.append((p, before))
        before += n
    offsets = F.broadcast(shared.spark.createDataFrame(starts, "_p long, _start long"))
    rows = local.withColumn("_p", part).join(offsets, "_p")
    return rows.withColumn(name, F.col("_start") + row).drop("_p", "_start", "_m")


def work_units(
    shared: Shared, rows: DataFrame, keys: list[str], item: str, cap: int, unit_rows: int
) -> DataFrame:
    """Deal rows out so that any two rows of one key meet in exactly one bounded unit.

    Small groups share units. A group of more than ``cap`` rows is cut into pieces
    by ``item``; the unit (lo, hi) holds two of them, ``side`` 0 and 1, and the unit
    (lo, lo) one. Group the result by ``unit``, ``lo`` and ``hi``.
    """
    total = rows.count()
    units = max(1, -(-total // unit_rows))
    key = F.xxhash64(*keys)
    hot = (
        rows.groupBy(*keys).count().filter(F.col("count") > cap)
        .select(*[F.col(k).alias(f"_{k}") for k in keys],
                F.ceil(F.col("count") / cap).cast("int").alias("_pieces"))
    )
    hot = shared.put(hot)
    same = [F.col(k) == F.col(f"_{k}") for k in keys]
    joined = rows.join(hot, same, "left").drop(*[f"_{k}" for k in keys])
    piece = F.pmod(F.xxhash64(F.col(item), F.lit(7)), F.col("_pieces")).cast("int")
    others = F.when(F.col("_pieces").isNull(), F.array(F.lit(None).cast("int"))).otherwise(
        F.sequence(F.lit(0), F.col("_pieces") - 1)
    )
    dealt = joined.withColumn("_piece", piece).withColumn("_other", F.explode(others))
    cold = F.col("_pieces").isNull()
    return dealt.select(
        *rows.columns,
        F.when(cold, F.pmod(key, F.lit(units))).otherwise(key).alias("unit"),
        F.when(cold, -1).otherwise(F.least("_piece", "_other")).alias("lo"),
        F.when(cold, -1).otherwise(F.greatest("_piece", "_other")).alias("hi"),
        F.when(cold | (F.col("_piece") <= F.col("_other")), 0).otherwise(1).alias("side"),
    )
