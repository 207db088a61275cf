"""A session with the settings that the plans expect; on a cluster they come from spark-submit."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", partitions: int = 8, memory: str = "20g") -> SparkSession:
    """Adaptive execution decides joins and coalesces; times are UTC; the UI is off."""
    session = (
        SparkSession.builder.master(master).appName("gridloom")
        .config("spark.sql.shuffle.partitions", partitions).config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true").config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session
