"""Landed payloads to checked raw rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.clock import from_epoch_millis, ingest_date, local_to_utc, parse_iso
from tidemark.functions.nested import (
    first_element,
    flatten_parallel_arrays,
    last_element,
    last_non_null_pair,
    share_of,
)
from tidemark.operators.contracts import enforce
from tidemark.operators.dedup import top_rank
from tidemark.operators.rollup import union_sources

WEATHER_SCHEMA = (
    "city string not null, country string not null, latitude double not null, "
    "longitude double not null, timezone string not null, hour timestamp not null, "
    "temperature_2m double, windspeed_10m double, weathercode int, precipitation double, "
    "ingested_at timestamp not null, ingested_date date not null, source string not null"
)
ENERGY_SCHEMA = (
    "zone string not null, country string not null, city string not null, "
    "carbon_intensity double, fossil_free_pct double, renewable_pct double, "
    "day_ahead_price_eur_mwh double, measurement_at timestamp, "
    "ingested_at timestamp not null, ingested_date date not null, source string not null"
)

WEATHER_PAYLOAD = (
    "hourly struct<time: array<string>, temperature_2m: array<double>, "
    "windspeed_10m: array<double>, weathercode: array<double>, precipitation: array<double>>"
)
INTENSITY_PAYLOAD = (
    "data array<struct<`from`: string, intensity: struct<actual: double, forecast: double>>>"
)
GENERATION_PAYLOAD = "data struct<generationmix: array<struct<fuel: string, perc: double>>>"
INDEX_PAYLOAD = "timestamps array<bigint>"
CHUNK_PAYLOAD = "series array<array<double>>"

# Lineage names written to every row, and the fuels of the two shares.
WEATHER_SOURCE = "open_meteo"
RENEWABLE_FUELS = ["wind", "solar", "hydro", "biomass"]
FOSSIL_FREE_FUELS = ["wind", "solar", "hydro", "biomass", "nuclear"]


def weather_rows(landed: DataFrame, cities: DataFrame, hours_are_utc: bool = False) -> DataFrame:
    """One checked row per city and hour. ``landed`` comes from ``read_landed``.

    Payload hours are the city's wall-clock time and are stored as UTC, unless they are
    declared to be UTC already.
    """
    hourly = landed.select(
        "city", "ingested_at", "payload_error", F.col("payload.hourly").alias("hourly")
    )
    values = ["temperature_2m", "windspeed_10m", "weathercode", "precipitation"]
    rows = flatten_parallel_arrays(hourly, "hourly", "time", values, keep_empty=True)
    located = rows.join(cities, "city", "left")
    hour = parse_iso("time")
    if not hours_are_utc:
        hour = local_to_utc(hour, "timezone")
    typed = located.withColumns(
        {
            "hour": hour,
            "ingested_date": ingest_date("ingested_at"),
            "source": F.lit(WEATHER_SOURCE),
        }
    )
    return enforce(typed, WEATHER_SCHEMA, extra=F.col("payload_error"))


def one_document(landed: DataFrame, keys: list[str], **values: Column) -> DataFrame:
    """``values`` of one document per key, so that copies do not multiply in a join.

    Sound documents come first, then the one with the highest hash. The values and the hash are
    taken before the ranks, which therefore sort and shuffle neither payloads nor their text.
    """
    picked = landed.select(
        *keys, "payload_error", F.xxhash64("payload").alias("_hash"), *[v.alias(n) for n, v in values.items()]
    )
    order = [F.asc_nulls_first("payload_error"), F.desc_nulls_last("_hash")]
    return top_rank(picked, keys, order).drop("_hash")


def intensity_reading(intensity: DataFrame, generation: DataFrame) -> DataFrame:
    """Carbon intensity and fuel shares from two documents of one city and ingest time."""
    keys = ["city", "ingested_at"]
    first = first_element("payload.data")
    left = one_document(
        intensity,
        keys,
        _from=F.nullif(first["from"], F.lit("")),
        # An actual of zero is a reading; only a missing one gives way to the forecast.
        _carbon=F.coalesce(first["intensity"]["actual"], first["intensity"]["forecast"]),
        _size=F.size("payload.data"),
        _left=F.lit(True),
    ).withColumnRenamed("payload_error", "_left_error")
    right = one_document(
        generation,
        keys,
        _fossil_free=share_of("payload.data.generationmix", FOSSIL_FREE_FUELS),
        _renewable=share_of("payload.data.generationmix", RENEWABLE_FUELS),
        _right=F.lit(True),
    ).withColumnRenamed("payload_error", "_right_error")
    start = F.col("_from")
    error = F.coalesce(
        "_left_error",
        "_right_error",
        F.when(F.isnull("_left"), "intensity: missing document"),
        F.when(F.isnull("_right"), "generation: missing document"),
        F.when(F.col("_size") == 0, "intensity: no data"),
    )
    return left.join(right, keys, "full").select(
        *keys,
        F.col("_carbon").alias("carbon_intensity"),
        F.col("_fossil_free").alias("fossil_free_pct"),
        F.col("_renewable").alias("renewable_pct"),
        F.coalesce(parse_iso(start), "ingested_at").alias("measurement_at"),
        F.coalesce(error, _unreadable(start)).alias("payload_error"),
    )


def _unreadable(text: Column) -> Column:
    return F.when(text.isNotNull() & parse_iso(text).isNull(), "intensity: bad timestamp")


def latest_chunk(index: DataFrame, chunks: DataFrame, key: str = "city") -> DataFrame:
    """Each index document with the series of its last listed chunk.

    Chunks have ``key``, ``chunk_ts`` and a payload. An empty index gives a NULL series.
    """
    last = index.withColumn("chunk_ts", last_element("payload.timestamps")).drop("payload")
    series = one_document(
        chunks, [key, "chunk_ts"], series=F.col("payload.series"), _found=F.lit(True)
    ).withColumnRenamed("payload_error", "_chunk_error")
    joined = last.join(series, [key, "chunk_ts"], "left")
    missing = F.when(
        F.col("chunk_ts").isNotNull() & F.isnull("_found"), "chunk: missing document"
    )
    error = F.coalesce("payload_error", "_chunk_error", missing)
    return joined.withColumn("payload_error", error).drop("_chunk_error", "_found")


def price_reading(index: DataFrame, chunks: DataFrame) -> DataFrame:
    """Last known price of each index document's latest chunk."""
    pair = last_non_null_pair("series")
    return latest_chunk(index, chunks).select(
        "city",
        "ingested_at",
        F.get(pair, F.lit(1)).alias("day_ahead_price_eur_mwh"),
        F.coalesce(from_epoch_millis(F.get(pair, F.lit(0))), "ingested_at").alias("measurement_at"),
        "payload_error",
    )


def energy_rows(readings: list[DataFrame], zones: DataFrame) -> DataFrame:
    """Checked rows of all sources under one schema; measures a source lacks are NULL."""
    located = union_sources(*readings).join(zones, "city", "left")
    typed = located.withColumn("ingested_date", ingest_date("ingested_at"))
    return enforce(typed, ENERGY_SCHEMA, extra=F.col("payload_error"))
