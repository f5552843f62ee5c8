"""Generated hour spine."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.clock import calendar_parts, hour_key


def hour_spine(
    spark: SparkSession, start: datetime, end: datetime, name: str = "full_timestamp"
) -> DataFrame:
    """Every hour from ``start`` to ``end``, both included.

    A range is generated in parallel, whereas one ``sequence`` array would be a single row.
    """
    hours = int((end - start).total_seconds() // 3600) + 1
    first = F.to_timestamp(F.lit(start.strftime("%Y-%m-%d %H:%M:%S")))
    return spark.range(max(hours, 0)).select(
        F.timestamp_add("HOUR", F.col("id"), first).alias(name)
    )


def time_dimension(spark: SparkSession, start: datetime, end: datetime) -> DataFrame:
    """Hour spine with its key and calendar attributes."""
    ts = F.col("full_timestamp")
    return hour_spine(spark, start, end).select(
        hour_key(ts).alias("time_key"),
        ts,
        *[part.alias(name) for name, part in calendar_parts(ts).items()],
    )
