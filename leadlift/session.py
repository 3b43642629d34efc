"""Session settings for local runs; a cluster brings its own session."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | None = None, app: str = "leadlift") -> SparkSession:
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
