"""Dimensions, the hourly fact and its two reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.clock import hour_key, key_to_date, load_stamp
from tidemark.functions.keys import surrogate_key
from tidemark.functions.numbers import band, null_default
from tidemark.operators.dedup import dedup_latest
from tidemark.operators.rollup import Measure, Partial, dominant_of_counts
from tidemark.operators.scd import VERSION, current_versions
from tidemark.sources.fixed import weather_conditions
from tidemark.sources.spine import time_dimension

# What the location history watches, the default spine, the two thresholds, and the
# measures of the two reports.
LOCATION_CHECKS = ["latitude", "longitude", "timezone", "electricity_zone"]
SPINE_START = datetime(2024, 1, 1, 0)
SPINE_END = datetime(2025, 12, 31, 23)
WARM_FROM = 15
CLEAN_UP_TO = 200

MONTHS = ["year", "month", "month_name"]
DAILY = [
    Measure("avg_temperature", "avg", "temperature_2m"),
    Measure("max_temperature", "max", "temperature_2m"),
    Measure("min_temperature", "min", "temperature_2m"),
    Measure("total_precipitation_mm", "sum", "precipitation"),
    Measure("avg_windspeed", "avg", "windspeed_10m"),
    Measure("avg_carbon_intensity", "avg", "carbon_intensity"),
    Measure("avg_renewable_pct", "avg", "renewable_pct"),
    Measure("avg_fossil_free_pct", "avg", "fossil_free_pct"),
    Measure("reading_count", "count"),
    Measure("missing_energy_readings", "count_null", "carbon_intensity"),
]
MONTHLY = [
    Measure("avg_temp_c", "avg", "temperature_2m"),
    Measure("max_temp_c", "max", "temperature_2m"),
    Measure("min_temp_c", "min", "temperature_2m"),
    Measure("avg_carbon_intensity", "avg", "carbon_intensity"),
    Measure("avg_renewable_pct", "avg", "renewable_pct"),
    Measure("avg_fossil_free_pct", "avg", "fossil_free_pct"),
    Measure("avg_hourly_precipitation", "avg", "precipitation", 3),
    Measure("reading_count", "count"),
]


def dim_location(history: DataFrame) -> DataFrame:
    """Current location versions; the key is stable over versions."""
    return current_versions(history, "city", "location_key").select(
        "location_key",
        F.col("city").cast("string"),
        F.col("country").cast("string"),
        F.col("latitude").cast("double"),
        F.col("longitude").cast("double"),
        F.col("timezone").cast("string"),
        F.col("electricity_zone").cast("string"),
        *VERSION,
    )


def dim_time(
    spark: SparkSession, start: datetime = SPINE_START, end: datetime = SPINE_END
) -> DataFrame:
    return time_dimension(spark, start, end)


def dim_weather_condition(spark: SparkSession) -> DataFrame:
    return weather_conditions(spark)


def locate(weather: DataFrame, locations: DataFrame) -> DataFrame:
    """Weather rows of known cities with their location key and electricity zone.

    No join hint: Spark broadcasts the dimension while it is below its size limit, and beyond
    it sorts both sides and splits hot cities.
    """
    return weather.join(
        locations.select("city", "location_key", "electricity_zone"), "city", "inner"
    )


def latest_energy(energy: DataFrame) -> DataFrame:
    """One energy row per zone and hour, also after several runs within one hour."""
    return dedup_latest(energy, ["zone", "measurement_hour"], "_ingested_at", ["energy_id"])


def pending_weather(
    weather: DataFrame, energy: DataFrame, locations: DataFrame, mark: DataFrame
) -> DataFrame:
    """Weather loaded above the fact's mark, plus the hours whose energy was."""
    fresh = energy.where(F.col("_loaded_at") > mark.scalar()).select(
        F.col("zone").alias("electricity_zone"),
        F.col("measurement_hour").alias("observation_hour"),
        F.lit(True).alias("_fresh"),
    )
    marked = locate(weather, locations).join(
        fresh.distinct(), ["electricity_zone", "observation_hour"], "left"
    )
    pending = marked.where((F.col("_loaded_at") > mark.scalar()) | F.col("_fresh"))
    return pending.select(*weather.columns)


def fact_energy_readings(
    weather: DataFrame,
    energy: DataFrame,
    locations: DataFrame,
    times: DataFrame,
    loaded_at=None,
    date_col: str | None = None,
) -> DataFrame:
    """One row per city and hour: keys, weather and, where there is any, energy measures.

    ``date_col`` names an extra column with the date, to partition a stored fact by.
    """
    readings = latest_energy(energy).select(
        F.col("zone").alias("electricity_zone"),
        F.col("measurement_hour").alias("observation_hour"),
        F.col("carbon_intensity_gco2eq").alias("carbon_intensity"),
        "fossil_free_pct",
        "renewable_pct",
        "day_ahead_price_eur_mwh",
        F.col("_ingested_at").alias("energy_ingested_at"),
    )
    located = locate(weather, locations).withColumn("_hour_key", hour_key("observation_hour"))
    timed = located.join(
        times.select("time_key"), F.col("_hour_key") == F.col("time_key"), "left"
    )
    joined = timed.join(readings, ["electricity_zone", "observation_hour"], "left")
    return joined.select(
        surrogate_key("city", "observation_hour").alias("fact_id"),
        "location_key",
        "time_key",
        F.col("weathercode").alias("weathercode_key"),
        "temperature_2m",
        "windspeed_10m",
        "precipitation",
        "carbon_intensity",
        "fossil_free_pct",
        "renewable_pct",
        "day_ahead_price_eur_mwh",
        F.col("_ingested_at").alias("weather_ingested_at"),
        "energy_ingested_at",
        load_stamp(loaded_at).alias("_loaded_at"),
        *([F.to_date("observation_hour").alias(date_col)] if date_col else []),
    )


def agg_daily_energy(
    fact: DataFrame, locations: DataFrame, exact_scale: int | None = None
) -> DataFrame:
    """City and day. The fact is grouped by its own keys before the location is joined."""
    day = key_to_date("time_key").alias("agg_date")
    keys = ["agg_date", "city", "country"]
    return (
        Partial.of(fact, ["location_key", day], DAILY, exact_scale)
        .lookup(locations.select("location_key", "city", "country"), ["location_key"])
        .merge(keys)
        .result(*keys)
    )


def rpt_weather_energy_correlation(
    fact: DataFrame,
    locations: DataFrame,
    times: DataFrame,
    conditions: DataFrame,
    exact_scale: int | None = None,
) -> DataFrame:
    """City and month with the dominant weather category and a profile label.

    One pass over the fact: it is grouped by month and weather code first; measures and
    category counts are then both merged from those groups.
    """
    calendar = times.select("time_key", *MONTHS)
    by_code = Partial.of(
        fact.join(calendar, "time_key", "left"),
        ["location_key", *MONTHS, F.col("weathercode_key").alias("weathercode")],
        MONTHLY,
        exact_scale,
    )
    return _monthly(by_code, locations, conditions)


def reading_states(
    fact: DataFrame, times: DataFrame, partition_col: str, exact_scale: int | None = None
) -> DataFrame:
    """Sums, counts and extremes of both reports per partition, location, day, month and weather
    code. A day's states depend on that day's readings only."""
    calendar = times.select("time_key", *MONTHS)
    keys = [
        "location_key",
        key_to_date("time_key").alias("agg_date"),
        *MONTHS,
        F.col("weathercode_key").alias("weathercode"),
        partition_col,
    ]
    states = Partial.of(fact.join(calendar, "time_key", "left"), keys, [*DAILY, *MONTHLY], exact_scale).df
    return states.select(*[c for c in states.columns if c != partition_col], partition_col)


def daily_of_states(
    states: DataFrame, locations: DataFrame, exact_scale: int | None = None
) -> DataFrame:
    """``agg_daily_energy`` from stored states."""
    keys = ["agg_date", "city", "country"]
    by_day = Partial.stored(states, DAILY, exact_scale).merge(["location_key", "agg_date"])
    places = locations.select("location_key", "city", "country")
    return by_day.lookup(places, ["location_key"]).merge(keys).result(*keys)


def monthly_of_states(
    states: DataFrame, locations: DataFrame, conditions: DataFrame, exact_scale: int | None = None
) -> DataFrame:
    """``rpt_weather_energy_correlation`` from stored states."""
    by_code = Partial.stored(states, MONTHLY, exact_scale)
    return _monthly(by_code.merge(["location_key", *MONTHS, "weathercode"]), locations, conditions)


def _monthly(by_code: Partial, locations: DataFrame, conditions: DataFrame) -> DataFrame:
    """The monthly report from states per location, month and weather code."""
    keys = ["city", "country", *MONTHS]
    by_category = (
        by_code.lookup(conditions.select("weathercode", "condition_category"), ["weathercode"])
        .lookup(locations.select("location_key", "city", "country"), ["location_key"])
        .merge([*keys, "condition_category"])
    )
    monthly = by_category.merge(
        keys, dominant_of_counts("condition_category", "_rows").alias("_category")
    )
    known = F.col("city").isNotNull() & F.col("year").isNotNull() & F.col("month").isNotNull()
    category = null_default(F.when(known, F.col("_category")), "unknown")
    report = monthly.result(*keys, category.alias("dominant_weather_category"))
    measures = [m.name for m in MONTHLY]
    return report.select(
        *keys,
        *measures,
        "dominant_weather_category",
        temp_carbon_profile("avg_temp_c", "avg_carbon_intensity").alias("temp_carbon_profile"),
    )


def temp_carbon_profile(temperature: str, carbon: str):
    """Four bands on temperature and carbon intensity; unknown where either is missing."""
    warm, clean = F.col(temperature) >= WARM_FROM, F.col(carbon) <= CLEAN_UP_TO
    return band(
        [
            (warm & clean, "warm_clean"),
            (warm & ~clean, "warm_carbon"),
            (~warm & clean, "cool_clean"),
            (~warm & ~clean, "cool_carbon"),
        ],
        "unknown",
    )
