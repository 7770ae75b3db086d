"""Spark session for tests, the benchmark and the command line."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(app: str = "tallyward", cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A local session. On a cluster, use the session the cluster gives instead."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
