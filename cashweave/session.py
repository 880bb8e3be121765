"""Session settings the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime settings only, so they can be applied to a session a cluster hands us.
_RUNTIME = {
    # Dates become timestamps at UTC midnight.
    "spark.sql.session.timeZone": "UTC",
    # Joins carry no fixed hints: Spark picks broadcast or sort-merge from
    # measured sizes and splits the partitions of hot keys.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings above and return the same session."""
    for key, value in _RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark
