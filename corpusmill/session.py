"""Session helper used by the command line, the tests and bench.py; jobs on a cluster bring their own session."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(app: str = "corpusmill", cores: int | str | None = None, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with AQE on and UTC as its time zone, the settings that the queries assume."""
    cores = cores or os.environ.get("BENCH_CPUS") or "*"
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
