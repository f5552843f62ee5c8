"""The provided tables in the roles of the data set.

``events`` plays the raw readings (purchases are the energy readings), ``customer`` with
nation and region the locations.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.clock import ingest_date, run_id, trunc_hour
from tidemark.operators.audit import FAILED, RUNNING, SUCCESS
from tidemark.operators.dedup import dedup_latest
from tidemark.operators.scd import first_versions
from tidemark.plans import gold, silver

LOADED_AT = datetime(2024, 3, 1)
HISTORY_START = datetime(2024, 1, 1)
HISTORY_CHANGE = datetime(2024, 1, 15)
DAY = date(2024, 1, 10)
MIDDLE = datetime(2024, 1, 15)


# The provided tables' columns, declared so that no scan has to infer them first.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A provided table; its zone-less timestamps are read as UTC."""
    df = spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")
    local = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({name: F.col(name).cast("timestamp") for name in local}) if local else df


def k_value() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").withColumn("k", k_value())


def weather_bronze(spark: SparkSession, folder: str) -> DataFrame:
    """Readings that are not purchases, as raw weather rows."""
    return (
        events(spark, folder)
        .where("event_type <> 'purchase'")
        .select(
            F.col("user_id").cast("string").alias("city"),
            F.concat(F.lit("C"), F.length("event_type").cast("string")).alias("country"),
            F.col("user_id").cast("double").alias("latitude"),
            F.col("k").cast("double").alias("longitude"),
            F.lit("UTC").alias("timezone"),
            F.col("ts").alias("hour"),
            F.col("value").alias("temperature_2m"),
            F.col("k").cast("double").alias("windspeed_10m"),
            F.col("k").alias("weathercode"),
            F.col("value").alias("precipitation"),
            F.col("ts").alias("ingested_at"),
            ingest_date("ts").alias("ingested_date"),
            F.col("event_type").alias("source"),
        )
    )


def regions(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as the seed of locations."""
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    return (
        table(spark, folder, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").cast("string").alias("city"),
            F.col("n_name").alias("country"),
            F.col("c_acctbal").alias("latitude"),
            F.col("c_nationkey").cast("double").alias("longitude"),
            F.col("c_mktsegment").alias("timezone"),
            F.col("r_name").alias("electricity_zone"),
        )
    )


def energy_bronze(spark: SparkSession, folder: str) -> DataFrame:
    """Purchases as raw energy rows of their customer's region."""
    zones = regions(spark, folder).select("city", "country", "electricity_zone")
    return (
        events(spark, folder)
        .where("event_type = 'purchase'")
        .withColumn("city", F.col("user_id").cast("string"))
        .join(zones, "city")
        .select(
            F.col("electricity_zone").alias("zone"),
            "country",
            "city",
            F.col("value").alias("carbon_intensity"),
            (F.lit(100) - F.col("k")).cast("double").alias("fossil_free_pct"),
            F.col("k").cast("double").alias("renewable_pct"),
            F.col("value").alias("day_ahead_price_eur_mwh"),
            F.col("ts").alias("measurement_at"),
            F.col("ts").alias("ingested_at"),
            ingest_date("ts").alias("ingested_date"),
            F.col("event_type").alias("source"),
        )
    )


def silver_weather(spark: SparkSession, folder: str) -> DataFrame:
    return silver.stg_weather_hourly(weather_bronze(spark, folder), LOADED_AT)


def silver_energy(spark: SparkSession, folder: str) -> DataFrame:
    return silver.stg_energy_intensity(energy_bronze(spark, folder), LOADED_AT)


def locations(spark: SparkSession, folder: str) -> DataFrame:
    history = first_versions(regions(spark, folder), "city", HISTORY_START)
    return gold.dim_location(history)


def fact(spark: SparkSession, folder: str) -> DataFrame:
    return gold.fact_energy_readings(
        silver_weather(spark, folder),
        silver_energy(spark, folder),
        locations(spark, folder),
        gold.dim_time(spark),
        LOADED_AT,
    )


def regions_before(spark: SparkSession, folder: str) -> DataFrame:
    """An earlier state of the seed: one country missing, some attributes different."""
    earlier = F.when(F.col("latitude") < 0, "EARLIER").otherwise(F.col("timezone"))
    return (
        regions(spark, folder).where("country <> 'NATION_3'").withColumn("timezone", earlier)
    )


def regions_after(spark: SparkSession, folder: str) -> DataFrame:
    """The present seed, from which another country is gone."""
    return regions(spark, folder).where("country <> 'NATION_5'")


def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """One run per user and day: a RUNNING row, and an end unless the day has one event."""
    runs = (
        events(spark, folder)
        .groupBy("user_id", ingest_date("ts").alias("day"))
        .agg(
            F.min("ts").alias("started_at"),
            F.max("ts").alias("ended_at"),
            F.count(F.lit(1)).alias("n"),
            F.max("k").alias("k"),
        )
        .withColumn("run_id", F.concat_ws("_", F.col("user_id"), run_id("started_at")))
    )
    failed = F.col("k") < 50
    row = [F.col("run_id"), F.col("started_at")]
    entries = F.array(
        F.struct(
            *row,
            F.lit(None).cast("timestamp").alias("ended_at"),
            F.lit(RUNNING).alias("status"),
            F.lit(None).cast("string").alias("error"),
        ),
        F.struct(
            *row,
            F.col("ended_at"),
            F.when(failed, FAILED).otherwise(SUCCESS).alias("status"),
            F.when(failed, "low").alias("error"),
        ),
    )
    kept = F.filter(entries, lambda e: (e["status"] == RUNNING) | (F.col("n") > 1))
    return runs.select(F.inline(kept))


def user_hour(df: DataFrame) -> DataFrame:
    return df.withColumn("hour", trunc_hour("ts"))


# --- payload documents, one per event ----------------------------------------------------


def weather_documents(spark: SparkSession, folder: str) -> DataFrame:
    """A day of hours per event; some value arrays are short, some long."""
    start = F.date_trunc("day", "ts")
    hours = F.transform(
        F.sequence(F.lit(0), F.lit(23)),
        lambda i: F.date_format(F.timestamp_add("HOUR", i, start), "yyyy-MM-dd'T'HH:mm"),
    )

    def ramp(length: Column, base: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), length - 1), lambda i: base + i)

    k = F.col("k")
    hourly = F.struct(
        hours.alias("time"),
        ramp(F.lit(24) - k % 5, F.col("value")).alias("temperature_2m"),
        ramp(F.lit(24) + k % 3, k.cast("double")).alias("windspeed_10m"),
        ramp(F.lit(12), k.cast("double")).alias("weathercode"),
        F.when(k >= 10, ramp(F.lit(24), F.lit(0.0))).alias("precipitation"),
    )
    return events(spark, folder).select(
        "event_id",
        F.col("user_id").cast("string").alias("city"),
        F.col("ts").alias("ingested_at"),
        F.to_json(F.struct(hourly.alias("hourly"))).alias("payload"),
    )


def fuel_mix() -> Column:
    """Entries with a repeated fuel, whose last share counts."""
    k = F.col("k")
    shares = [
        ("wind", k),
        ("solar", k % 7),
        ("coal", 100 - k),
        ("nuclear", k % 5),
        ("wind", k % 11),
    ]
    return F.array(
        *[F.struct(F.lit(f).alias("fuel"), s.cast("double").alias("perc")) for f, s in shares]
    )


def intensity_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Actual readings are sometimes missing and sometimes zero; some starts are missing."""
    k = F.col("k")
    actual = F.when(k % 3 == 0, F.lit(0.0)).when(k % 3 == 1, F.col("value") + 1)
    entry = F.struct(
        F.when(k >= 20, F.date_format(trunc_hour("ts"), "yyyy-MM-dd'T'HH:mm'Z'")).alias("from"),
        F.struct(actual.alias("actual"), F.col("value").alias("forecast")).alias("intensity"),
    )
    data = F.when(k == 99, F.array().cast(f"array<{_entry_type()}>")).otherwise(F.array(entry))
    return events(spark, folder).select(
        F.col("user_id").cast("string").alias("city"),
        F.col("ts").alias("ingested_at"),
        F.to_json(F.struct(data.alias("data"))).alias("payload"),
    )


def _entry_type() -> str:
    return "struct<`from`: string, intensity: struct<actual: double, forecast: double>>"


def generation_documents(spark: SparkSession, folder: str) -> DataFrame:
    data = F.struct(fuel_mix().alias("generationmix"))
    return events(spark, folder).select(
        F.col("user_id").cast("string").alias("city"),
        F.col("ts").alias("ingested_at"),
        F.to_json(F.struct(data.alias("data"))).alias("payload"),
    )


def hour_millis(ts: Column) -> Column:
    return F.unix_millis(trunc_hour(ts))


HOUR = 3_600_000


def index_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Lists of none to three chunk times, the last at most the event's own hour."""
    hour = hour_millis(F.col("ts"))
    listed = F.array(hour - 2 * HOUR, hour - HOUR, hour)
    timestamps = F.slice(listed, F.lit(1), F.col("k") % 4)
    return events(spark, folder).select(
        "event_id",
        F.col("user_id").cast("string").alias("city"),
        F.col("ts").alias("ingested_at"),
        F.to_json(F.struct(timestamps.alias("timestamps"))).alias("payload"),
    )


def chunk_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One chunk per user and hour; some end in NULL prices, some have no price at all."""
    latest = dedup_latest(user_hour(events(spark, folder)), ["user_id", "hour"], "ts", ["event_id"])
    at = F.unix_millis("ts").cast("double")
    price = F.when(F.col("k") >= 10, F.col("value"))
    empty = F.lit(None).cast("double")
    series = F.array(F.array(at, price), F.array(at + 1, empty))
    return latest.select(
        F.col("user_id").cast("string").alias("city"),
        hour_millis(F.col("ts")).alias("chunk_ts"),
        F.to_json(F.struct(series.alias("series"))).alias("payload"),
    )
