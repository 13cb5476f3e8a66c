"""A local session for benchmarks; on a cluster the given session is used."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: int, name: str = "fleetscope") -> SparkSession:
    session = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session
