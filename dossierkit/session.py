"""Session settings that the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int, memory: str = "8g") -> SparkSession:
    """Session on one machine: as many shuffle partitions as cores, small partitions kept apart."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("dossierkit")
    local = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": memory,
        "spark.sql.shuffle.partitions": str(cores),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    }
    for key, value in {**SETTINGS, **local}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
