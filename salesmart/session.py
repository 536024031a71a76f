"""Session settings shared by tests, bench and jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # spares a stack walk per column expression
    "spark.sql.dataFrameQueryContext.enabled": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cpus: int | str = "*", name: str = "salesmart", **extra: str) -> SparkSession:
    """A local session; on a cluster the session comes from spark-submit and keeps its own sizing."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    settings = SETTINGS | {
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g",
        "spark.driver.host": "127.0.0.1",
        "spark.driver.bindAddress": "127.0.0.1",
    } | extra
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
