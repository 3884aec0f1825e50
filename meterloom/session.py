"""Sessions: time zone pinned, adaptive execution on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "meterloom", master: str | None = None, driver_memory: str | None = None, time_zone: str = "UTC", shuffle_partitions: int | None = None, **more: str) -> SparkSession:
    """A session; a cluster's own settings stand wherever an argument is None. Adaptive execution sizes and splits partitions."""
    wanted = {
        "spark.master": master,
        "spark.driver.memory": driver_memory,
        "spark.sql.session.timeZone": time_zone,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": shuffle_partitions and str(shuffle_partitions),
    }
    builder = SparkSession.builder.appName(app)
    for key, value in (wanted | {k.replace("__", "."): v for k, v in more.items()}).items():
        if value is not None:
            builder = builder.config(key, value)
    return builder.getOrCreate()
