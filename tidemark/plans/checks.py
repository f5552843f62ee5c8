"""Declared data tests of every stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators.contracts import Contract, run_contract
from tidemark.sources.fixed import CATEGORIES, SEVERITIES

# Which columns may not be NULL, must be unique or come from a list.
CONTRACTS = {
    "bronze_weather": Contract(not_null=["city", "country", "hour", "source"]),
    "bronze_energy": Contract(not_null=["zone", "country", "ingested_at", "source"]),
    "stg_weather_hourly": Contract(
        not_null=[
            "weather_id",
            "city",
            "country",
            "observation_hour",
            "temperature_2m",
            "_source",
            "_ingested_at",
            "_loaded_at",
        ],
        unique=["weather_id"],
    ),
    "stg_energy_intensity": Contract(
        not_null=["energy_id", "zone", "country", "city", "_source", "_ingested_at", "_loaded_at"],
        unique=["energy_id"],
    ),
    "dim_location": Contract(
        not_null=["location_key", "city", "country", "electricity_zone"], unique=["location_key"]
    ),
    "dim_time": Contract(
        not_null=["time_key", "full_timestamp", "year", "month", "day", "hour", "is_weekend"],
        unique=["time_key"],
    ),
    "dim_weather_condition": Contract(
        not_null=["weathercode", "condition_label", "condition_category", "severity"],
        unique=["weathercode"],
        accepted={"condition_category": CATEGORIES, "severity": SEVERITIES},
    ),
    "fact_energy_readings": Contract(
        not_null=["fact_id", "location_key", "time_key"], unique=["fact_id"]
    ),
    "agg_daily_energy": Contract(not_null=["agg_date", "city"]),
    "rpt_weather_energy_correlation": Contract(not_null=["city", "country", "year", "month"]),
    "snap_dim_location": Contract(not_null=["city", "scd_id"], unique=["scd_id"]),
}


def check_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """Results of all declared tests of the given tables."""
    result = None
    for name, df in tables.items():
        tested = run_contract(name, df, CONTRACTS[name])
        result = tested if result is None else result.unionByName(tested)
    return result
