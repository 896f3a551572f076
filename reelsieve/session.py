"""Session defaults for local runs and tests; a cluster brings its own session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, partitions: int = 8, memory: str = "12g", app: str = "reelsieve") -> SparkSession:
    """A local session with the settings the queries expect (UTC, AQE, Arrow)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
