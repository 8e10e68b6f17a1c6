"""Session builder used by tests, the bench and interactive runs."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", partitions: int = 8, memory: str = "12g", **conf: str) -> SparkSession:
    """A local session with adaptive execution and UTC timestamps.

    On a cluster the session comes from spark-submit; nothing in the library depends on this builder.
    """
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("massquarry")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("MASSQUARRY_DRIVER_MEMORY", memory))
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
