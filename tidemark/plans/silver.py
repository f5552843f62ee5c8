"""Cleaned, deduplicated rows with surrogate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.clock import load_stamp, trunc_hour
from tidemark.functions.keys import surrogate_key
from tidemark.operators.dedup import dedup_latest


def _remaining(df: DataFrame, *used: str) -> list[str]:
    return [name for name in df.columns if name not in used]


def stg_weather_hourly(bronze: DataFrame, loaded_at=None) -> DataFrame:
    """Latest ingested row per city and hour."""
    latest = dedup_latest(
        bronze.withColumn("observation_hour", trunc_hour(F.col("hour").cast("timestamp"))),
        ["city", "observation_hour"],
        "ingested_at",
        tie_break=["hour", *_remaining(bronze, "city", "hour", "ingested_at")],
    )
    return latest.select(
        surrogate_key("city", "observation_hour").alias("weather_id"),
        F.col("city").cast("string"),
        F.col("country").cast("string"),
        F.col("latitude").cast("double"),
        F.col("longitude").cast("double"),
        F.col("timezone").cast("string"),
        "observation_hour",
        F.col("temperature_2m").cast("double"),
        F.col("windspeed_10m").cast("double"),
        F.col("weathercode").cast("int"),
        F.col("precipitation").cast("double"),
        F.col("source").cast("string").alias("_source"),
        F.col("ingested_at").cast("timestamp").alias("_ingested_at"),
        load_stamp(loaded_at).alias("_loaded_at"),
    )


def stg_energy_intensity(bronze: DataFrame, loaded_at=None) -> DataFrame:
    """Latest ingested row per zone and measurement hour, with units in the names."""
    hour = trunc_hour(F.col("measurement_at").cast("timestamp"))
    latest = dedup_latest(
        bronze.withColumn("measurement_hour", hour),
        ["zone", "measurement_hour"],
        "ingested_at",
        tie_break=["measurement_at", *_remaining(bronze, "zone", "measurement_at", "ingested_at")],
    )
    return latest.select(
        surrogate_key("zone", "ingested_at").alias("energy_id"),
        F.col("zone").cast("string"),
        F.col("country").cast("string"),
        F.col("city").cast("string"),
        F.col("carbon_intensity").cast("double").alias("carbon_intensity_gco2eq"),
        F.col("fossil_free_pct").cast("double"),
        F.col("renewable_pct").cast("double"),
        F.col("day_ahead_price_eur_mwh").cast("double"),
        "measurement_hour",
        F.col("source").cast("string").alias("_source"),
        F.col("ingested_at").cast("timestamp").alias("_ingested_at"),
        load_stamp(loaded_at).alias("_loaded_at"),
    )
