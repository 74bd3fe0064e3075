"""Spark sessions and the settings the jobs expect."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

# What the jobs rely on, on any cluster: adaptive execution picks join sides by measured
# size, merges small shuffle partitions and splits skewed ones.
EXPECTED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(
    cpus: int = 8, memory: str = "12g", name: str = "shelfmark", more: Mapping[str, str] = {}
) -> SparkSession:
    """A one-machine session for tests and the benchmark: few, small partitions."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    settings = {
        **EXPECTED,
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.sql.files.maxPartitionBytes": "2m",
        "spark.sql.files.openCostInBytes": "256k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
        **more,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
