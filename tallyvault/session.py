"""Session settings the engine expects."""

from __future__ import annotations

from pyspark.sql import SparkSession


def configured(builder: SparkSession.Builder) -> SparkSession.Builder:
    """UTC dates, and adaptive execution: it sizes shuffles by what they hold and splits
    oversized join partitions. Cluster size, memory and shared folders are the caller's."""
    return (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
