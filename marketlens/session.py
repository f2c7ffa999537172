"""Session helper for tests and the benchmark; on a cluster pass your own session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName("marketlens")
        .master(f"local[{cores}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # Recording the Python call site of every expression dominates short queries.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
