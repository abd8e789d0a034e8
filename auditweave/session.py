"""Session settings the plans are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# The plans never size a shuffle or choose a join themselves. They rely on adaptive
# execution to split skewed join partitions, to merge small ones and to broadcast a side
# only when its measured size allows it.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build(app: str, **settings: str) -> SparkSession:
    """A session with ``SETTINGS``, then ``settings`` (dots written as ``__``)."""
    builder = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
