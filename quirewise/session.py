"""Session defaults for local use; on a cluster the session given by the caller is used as it is."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with adaptive execution, UTC and Arrow transfer."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("quirewise")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
