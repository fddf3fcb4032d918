"""Session settings the operators expect."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(app: str = "cauce", master: str | None = None, **settings: str) -> SparkSession:
    """A session in UTC with adaptive execution and skew-join handling on.

    On a cluster leave ``master`` unset and let spark-submit name it, together with
    ``spark.checkpoint.dir`` (a shared folder) and ``spark.sql.shuffle.partitions``.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # plans of many windows compile more classes than the default of 100 holds
        .config("spark.sql.codegen.cache.maxEntries", "2000")
    )
    if master:
        builder = builder.master(master)
    if master and master.startswith("local"):
        builder = (
            builder.config("spark.ui.enabled", "false")
            .config("spark.driver.memory", os.environ.get("CAUCE_DRIVER_MEMORY", "12g"))
            .config("spark.sql.shuffle.partitions", "8")
        )
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()
