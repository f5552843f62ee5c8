"""One query per operator, bound to the provided tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemark.catalog import bindings as b
from tidemark.functions import clock, keys, nested, numbers
from tidemark.operators import audit, contracts, rollup, scd, skew, tables, upsert as up
from tidemark.operators.dedup import dedup_latest, high_water_mark, since_last
from tidemark.operators.export import export
from tidemark.operators.history import StoredHistory
from tidemark.operators.ledger import FileLedger
from tidemark.plans import bronze, checks, gold, reports
from tidemark.plans.medallion import SERVED
from tidemark.session import configure, new_folder
from tidemark.sources import files, fixed, spine
from tidemark.sources.landed import landed_stream, read_landed, with_payload
from tidemark.streaming import incremental, stateful

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

SCALE = 2
NOW = datetime(2024, 1, 20, 12)
INGESTED_AT = datetime(2024, 2, 1)
CODE = "weathercode"


def query(fn: Query) -> Query:
    """Register under the function's name. Results carry zone-less timestamps."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        df = fn(configure(spark), folder)
        stamps = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
        return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in stamps})

    REGISTRY[fn.__name__] = run
    return fn


def new_table(spark: SparkSession) -> str:
    """Name of a new table in a database of this session's own shared folder."""
    folder = new_folder(spark, "db")
    name = f"tables_{folder.rsplit('/', 1)[1]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}'")
    return f"{name}.t"


# --- A: scans and sources ----------------------------------------------------------------


@query
def scan_landed_json(spark, folder):
    path = new_folder(spark, "landed")
    b.events(spark, folder).select(
        F.col("user_id").cast("string").alias("city"),
        F.col("ts").alias("ingested_at"),
        F.col("props").alias("payload"),
    ).write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path)
    return read_landed(spark, path, "k int").select(
        "city", "ingested_at", F.col("payload.k").alias("k"), "payload_error"
    )


@query
def flatten_hourly(spark, folder):
    docs = with_payload(b.weather_documents(spark, folder), bronze.WEATHER_PAYLOAD)
    values = ["temperature_2m", "windspeed_10m", CODE, "precipitation"]
    hourly = docs.select("event_id", F.col("payload.hourly").alias("hourly"))
    return nested.flatten_parallel_arrays(hourly, "hourly", "time", values)


@query
def uk_reading(spark, folder):
    return bronze.intensity_reading(
        with_payload(b.intensity_documents(spark, folder), bronze.INTENSITY_PAYLOAD),
        with_payload(b.generation_documents(spark, folder), bronze.GENERATION_PAYLOAD),
    )


@query
def mix_share(spark, folder):
    mix = b.events(spark, folder).select("event_id", b.fuel_mix().alias("mix"))
    return mix.select(
        "event_id",
        nested.share_of("mix", bronze.RENEWABLE_FUELS).alias("renewable_pct"),
        nested.share_of("mix", bronze.FOSSIL_FREE_FUELS).alias("fossil_free_pct"),
    )


def _chunked(spark, folder):
    return (
        with_payload(b.index_documents(spark, folder), bronze.INDEX_PAYLOAD),
        with_payload(b.chunk_documents(spark, folder), bronze.CHUNK_PAYLOAD),
    )


@query
def latest_chunk(spark, folder):
    return bronze.latest_chunk(*_chunked(spark, folder)).select(
        "event_id", "chunk_ts", F.size("series").cast("int").alias("n_pairs"), "payload_error"
    )


@query
def price_reading(spark, folder):
    return bronze.price_reading(*_chunked(spark, folder))


@query
def last_non_null(spark, folder):
    readings = b.events(spark, folder).select(
        "user_id", "ts", F.when(F.col("k") < 30, F.col("value")).alias("value")
    )
    return nested.last_non_null(readings, ["user_id"], "ts", "value")


@query
def static_dim(spark, folder):
    counted = b.events(spark, folder).groupBy(
        F.element_at(
            F.array(*[F.lit(city[0]) for city in fixed.CITIES]),
            (F.col("k") % len(fixed.CITIES) + 1).cast("int"),
        ).alias("city")
    ).agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("max_value"))
    zones = fixed.zones(spark).select("city", "zone", "source")
    return fixed.cities(spark).join(zones, "city", "left").join(counted, "city", "left")


EVENT_WEIGHTS = [("click", 1), ("error", 0), ("purchase", 5), ("signup", 3), ("view", 1)]


@query
def typed_frame(spark, folder):
    weights = fixed.typed_frame(
        spark, EVENT_WEIGHTS, "event_type string not null, weight int not null"
    )
    counted = b.events(spark, folder).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return counted.join(weights, "event_type", "left").select(
        "event_type", "n", (F.col("weight") * F.col("n")).alias("weighted")
    )


@query
def scan_table(spark, folder):
    name = f"scan_{uuid.uuid4().hex}"
    b.table(spark, folder, "events").createOrReplaceTempView(name)
    return files.scan_table(spark, name)


@query
def seed_csv(spark, folder):
    path = new_folder(spark, "seed")
    b.regions(spark, folder).write.option("header", True).csv(path)
    seed = files.seed_csv(spark, path)
    return seed.withColumns({c: F.col(c).cast("double") for c in ["latitude", "longitude"]})


@query
def values_lookup(spark, folder):
    counted = b.events(spark, folder).groupBy(F.col("k").alias(CODE)).agg(
        F.count(F.lit(1)).alias("n")
    )
    return fixed.weather_conditions(spark).join(counted, CODE, "left")


@query
def hour_spine(spark, folder):
    counted = b.events(spark, folder).groupBy(
        clock.trunc_hour("ts").alias("full_timestamp")
    ).agg(F.count(F.lit(1)).alias("n"))
    hours = spine.hour_spine(spark, gold.SPINE_START, gold.SPINE_END)
    return hours.join(counted, "full_timestamp", "left").select(
        "full_timestamp", clock.hour_key("full_timestamp").alias("time_key"), "n"
    )


@query
def dim_time(spark, folder):
    counted = b.events(spark, folder).groupBy(clock.hour_key("ts").alias("time_key")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return gold.dim_time(spark).join(counted, "time_key", "left")


# --- B: sinks and table maintenance, in their data-frame form ----------------------------


def _dated(spark, folder):
    return b.events(spark, folder).select(
        "event_id", "event_type", "value", clock.ingest_date("ts").alias("ingested_date")
    )


def _corrected(spark, folder):
    """A second delivery of one day, in which one kind of event is missing."""
    day = (F.col("ingested_date") == F.lit(b.DAY)) & (F.col("event_type") != "error")
    return _dated(spark, folder).where(day).withColumn("value", F.col("value") + 1)


@query
def replace_where(spark, folder):
    return tables.replaced(
        _dated(spark, folder), _corrected(spark, folder), "ingested_date", b.DAY
    )


@query
def replace_partition(spark, folder):
    parts = ["ingested_date", "event_type"]
    return tables.replaced(
        _dated(spark, folder), _corrected(spark, folder), "ingested_date", b.DAY, parts
    )


@query
def partition_by(spark, folder):
    path, parts = new_folder(spark, "partitioned"), ["ingested_date", "event_type"]
    _dated(spark, folder).hint("rebalance", *parts).write.partitionBy(*parts).parquet(path)
    return spark.read.parquet(path).groupBy(*parts).agg(
        F.count(F.lit(1)).alias("n"), F.max("value").alias("max_value")
    )


def _outcomes(spark, folder):
    rows = b.events(spark, folder).select(
        F.lit("events").alias("source"), F.col("user_id").cast("string").alias("city"), "k"
    )
    roster = b.regions(spark, folder).select(F.lit("events").alias("source"), "city")
    message = F.concat(F.lit("code "), F.lpad(F.col("k").cast("string"), 2, "0"))
    rejected = rows.where("k < 60").withColumn("error_message", message)
    stamp = F.lit(INGESTED_AT).cast("timestamp")
    return audit.unit_outcomes(roster, rows.where("k >= 60"), rejected, stamp)


@query
def append_audit(spark, folder):
    return audit.audit_rows(_outcomes(spark, folder), "ALL_CITIES", "events")


@query
def append_run_log(spark, folder):
    """Every run's rows, appended to a log as they come, read back from it."""
    path = new_folder(spark, "run_log")
    log = b.run_log(spark, folder)
    for status in (F.col("status") == audit.RUNNING, F.col("status") != audit.RUNNING):
        log.where(status).write.mode("append").parquet(path)
    return spark.read.schema(log.schema).parquet(path)


@query
def full_refresh(spark, folder):
    table = new_table(spark)
    orders = b.table(spark, folder, "orders")
    tables.full_refresh(
        orders.groupBy("o_orderstatus", "o_orderpriority").agg(
            F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("max_price")
        ),
        table,
    )
    return spark.table(table)


def _orders_before(spark, folder):
    return b.table(spark, folder, "orders").where("o_orderdate < timestamp '1999-01-01'")


def _orders_after(spark, folder):
    later = b.table(spark, folder, "orders").where("o_orderdate >= timestamp '1998-01-01'")
    return later.withColumn("o_orderstatus", F.lit("X"))


@query
def upsert(spark, folder):
    return up.upsert(_orders_before(spark, folder), _orders_after(spark, folder), ["o_orderkey"])


@query
def incremental_filter(spark, folder):
    events = b.events(spark, folder).select("event_id", "ts", "value")
    loaded = events.where(F.col("ts") < F.lit(b.MIDDLE))
    return since_last(events, "ts", high_water_mark(loaded, "ts"))


@query
def unread_files(spark, folder):
    """What three loads read: the second finds late files with stamps that were loaded before,
    the third finds nothing."""
    table = new_table(spark)
    ledger = FileLedger(spark, f"{table}_ledger")
    events = b.events(spark, folder).select("event_id", "ts", "value", "k", clock.ingest_date("ts").alias("day"))
    loads = []
    for number, rows in enumerate([events.where("k < 80"), events.where("k >= 80"), None], 1):
        if rows is not None:
            rows.drop("k").hint("rebalance", "day").write.partitionBy("day").mode("append").saveAsTable(table)
        with ledger.unread(spark.table(table), "copy") as unread:
            path = new_folder(spark, "loaded")
            unread.withColumn("load", F.lit(number)).write.parquet(path)
            loads.append(spark.read.schema("event_id long, ts timestamp, value double, day date, load int").parquet(path))
    return reduce(DataFrame.unionByName, loads)


@query
def evolve_schema(spark, folder):
    orders = b.table(spark, folder, "orders")
    before = orders.select("o_orderkey", "o_custkey", "o_totalprice")
    after = orders.select("o_orderkey", "o_totalprice", "o_orderpriority")
    late = after.where("o_totalprice > 400000")
    return up.evolve_schema(before, after).unionByName(late)


def _history(spark, folder):
    before = scd.first_versions(b.regions_before(spark, folder), "city", b.HISTORY_START)
    return scd.scd2(
        before, b.regions_after(spark, folder), "city", gold.LOCATION_CHECKS, b.HISTORY_CHANGE
    )


@query
def scd2(spark, folder):
    return _history(spark, folder)


@query
def current_versions(spark, folder):
    return gold.dim_location(_history(spark, folder))


@query
def versions_at(spark, folder):
    return scd.versions_at(_history(spark, folder), datetime(2024, 1, 10)).select(
        "city", "timezone", "valid_from", "valid_to"
    )


def _stored_history(spark, folder) -> StoredHistory:
    """Two snapshots into a table that they only add to."""
    history = StoredHistory(spark, new_table(spark), "city", gold.LOCATION_CHECKS)
    history.snapshot(b.regions_before(spark, folder), b.HISTORY_START)
    history.snapshot(b.regions_after(spark, folder), b.HISTORY_CHANGE)
    return history


@query
def stored_scd2(spark, folder):
    return _stored_history(spark, folder).read()


@query
def stored_current_versions(spark, folder):
    history = _stored_history(spark, folder)
    history.compact()
    return gold.dim_location(history.current())


@query
def stored_versions_at(spark, folder):
    history = _stored_history(spark, folder).read()
    return scd.versions_at(history, datetime(2024, 1, 10)).select(
        "city", "timezone", "valid_from", "valid_to"
    )


@query
def as_of_version(spark, folder):
    """Three versions per customer, whose length depends on the nation; the last stays open."""
    number = F.col("number")
    length = F.col("c_nationkey") + 1
    start = F.to_timestamp(F.lit("2024-01-02 00:00:00"))
    history = (
        b.table(spark, folder, "customer")
        .select(
            "c_custkey",
            "c_nationkey",
            "c_mktsegment",
            F.explode(F.sequence(F.lit(0), F.lit(2))).alias("number"),
        )
        .select(
            F.col("c_custkey").alias("user_id"),
            F.timestamp_add("DAY", length * number, start).alias("valid_from"),
            F.when(number < 2, F.timestamp_add("DAY", length * (number + 1), start)).alias(
                "valid_to"
            ),
            F.concat_ws("-", "c_mktsegment", number).alias("segment"),
        )
    )
    facts = b.events(spark, folder).select("event_id", "user_id", "ts")
    return scd.as_of_version(facts, history, "user_id", "ts", ["segment"])


def _stored(spark, folder) -> dict[str, DataFrame]:
    """Every table of the data set."""
    fact, places = b.fact(spark, folder), b.locations(spark, folder)
    times, conditions = gold.dim_time(spark), gold.dim_weather_condition(spark)
    return {
        "bronze_weather": b.weather_bronze(spark, folder),
        "bronze_energy": b.energy_bronze(spark, folder),
        "stg_weather_hourly": b.silver_weather(spark, folder),
        "stg_energy_intensity": b.silver_energy(spark, folder),
        "dim_location": places,
        "dim_time": times,
        "dim_weather_condition": conditions,
        "fact_energy_readings": fact,
        "agg_daily_energy": gold.agg_daily_energy(fact, places, SCALE),
        "rpt_weather_energy_correlation": gold.rpt_weather_energy_correlation(
            fact, places, times, conditions, SCALE
        ),
        "snap_dim_location": _history(spark, folder),
    }


@query
def export_tables(spark, folder):
    """The export with files as its sink, the counts read back from what was written."""
    path = new_folder(spark, "export")
    tables_ = _stored(spark, folder)
    served = {name: tables_[name] for name in SERVED}
    views = {}
    for name, df in served.items():
        views[name] = f"{name}_{uuid.uuid4().hex}"
        df.createOrReplaceTempView(views[name])
    export(spark, views, lambda df, name: df.write.parquet(f"{path}/{name}"))
    return rollup.layer_counts({name: spark.read.parquet(f"{path}/{name}") for name in served})


@query
def delete_date(spark, folder):
    return tables.without_date(_dated(spark, folder), "ingested_date", F.lit(b.DAY))


@query
def clear_run(spark, folder):
    log = b.run_log(spark, folder)
    ended = audit.cleared(log, F.col("run_id"), F.lit(INGESTED_AT).cast("timestamp"))
    return audit.latest_status(log.unionByName(ended))


# --- C: contracts and tests --------------------------------------------------------------


def _checked(spark, folder):
    k = F.col("k")
    raw = b.events(spark, folder).select(
        F.when(k != 50, F.col("event_id").cast("string")).alias("event_id"),
        F.col("user_id").cast("string").alias("city"),
        F.when(k < 10, "n/a").otherwise(F.col("value").cast("string")).alias("value"),
        F.when(k != 7, F.col("ts").cast("string")).alias("ts"),
    )
    return contracts.enforce(
        raw, "event_id bigint not null, city string not null, value double, ts timestamp not null"
    )


@query
def enforce_schema(spark, folder):
    return _checked(spark, folder).withColumn(
        "reject_reason", F.array_join("reject_reason", "; ")
    )


@query
def partial_failure(spark, folder):
    outcomes = _outcomes(spark, folder)
    return outcomes.where(F.col("status") == audit.FAILED)


FACT_COLUMNS = ["fact_id", "location_key", "time_key", "carbon_intensity", "energy_ingested_at"]


@query
def test_not_null(spark, folder):
    return contracts.not_null_failures(b.fact(spark, folder), FACT_COLUMNS)


@query
def test_unique(spark, folder):
    lines = b.table(spark, folder, "lineitem")
    return contracts.duplicate_keys(lines, ["l_orderkey", "l_linenumber"])


@query
def test_accepted_values(spark, folder):
    accepted = ["click", "view", "purchase"]
    return contracts.unaccepted_values(b.events(spark, folder), "event_type", accepted)


@query
def test_not_empty(spark, folder):
    events = b.events(spark, folder)
    return contracts.empty_tables(
        {
            "events": events,
            "refunds": events.where("event_type = 'refund'"),
            "purchases": events.where("event_type = 'purchase'"),
            "negative": events.where("value < 0"),
        }
    )


@query
def contract_results(spark, folder):
    return checks.check_tables(_stored(spark, folder))


@query
def observed_contracts(spark, folder):
    """The same results, counted while the tables are written; uniqueness from the stored keys."""
    found = []
    for name, df in _stored(spark, folder).items():
        watch, path = contracts.Watch(name, checks.CONTRACTS[name]), new_folder(spark, name)
        watch.over(df).write.parquet(path)
        found.append(watch.results(spark.read.schema(df.schema).parquet(path)))
    return reduce(DataFrame.unionByName, found)


@query
def run_guard(spark, folder):
    return audit.active_runs(b.run_log(spark, folder), F.lit(NOW).cast("timestamp"), 12)


@query
def fk_coverage(spark, folder):
    parents = b.table(spark, folder, "customer").where("c_acctbal >= 0")
    return contracts.missing_parents(b.events(spark, folder), "user_id", parents, "c_custkey")


@query
def spine_coverage(spark, folder):
    orders = b.table(spark, folder, "orders")
    first, last = datetime(1996, 1, 1), datetime(1999, 12, 31, 23)
    return contracts.hours_outside(orders, "o_orderdate", first, last)


# --- D: projections, filters, predicates -------------------------------------------------


@query
def project_cast(spark, folder):
    return b.events(spark, folder).select(
        keys.surrogate_key("user_id", "ts").alias("event_key"),
        F.col("user_id").cast("string").alias("city"),
        F.col("value").cast("double").alias("value_mm"),
        F.col("k").cast("int").alias("code"),
        F.col("event_type").cast("string").alias("_source"),
        F.col("ts").cast("timestamp").alias("_ingested_at"),
        clock.load_stamp(b.LOADED_AT).alias("_loaded_at"),
    )


@query
def select_subset(spark, folder):
    return b.table(spark, folder, "lineitem").select("l_orderkey", "l_quantity")


@query
def filter_conjunction(spark, folder):
    recent = F.col("started_at") >= clock.hours_before(F.lit(NOW).cast("timestamp"), 24)
    return b.run_log(spark, folder).where((F.col("status") == audit.RUNNING) & recent).select(
        "run_id", "started_at"
    )


@query
def filter_not_null(spark, folder):
    return b.fact(spark, folder).where("carbon_intensity is not null").select(
        "fact_id", "carbon_intensity"
    )


@query
def filter_boolean(spark, folder):
    return _history(spark, folder).where("is_current").select("city", "valid_from")


@query
def filter_in_list(spark, folder):
    return b.events(spark, folder).where(F.dayofweek("ts").isin(1, 7)).select("event_id", "ts")


@query
def filter_count_zero(spark, folder):
    by_day = ["user_id", clock.ingest_date("ts").alias("day")]
    counted = b.events(spark, folder).groupBy(*by_day).agg(
        F.count_if(F.col("event_type") == "purchase").alias("cnt")
    )
    return counted.where("cnt = 0")


@query
def qualify(spark, folder):
    events = b.events(spark, folder)
    return dedup_latest(events, ["user_id", "event_type"], "value", ["event_id"]).select(
        "user_id", "event_type", "value", "event_id"
    )


@query
def case_band(spark, folder):
    readings = b.events(spark, folder).select(
        "event_id",
        F.when(F.col("k") >= 5, F.col("k").cast("double")).alias("temperature"),
        F.when(F.col("k") <= 95, F.col("value")).alias("carbon"),
    )
    profile = gold.temp_carbon_profile("temperature", "carbon")
    return readings.select("event_id", profile.alias("profile"))


@query
def case_flag(spark, folder):
    return b.events(spark, folder).select(
        "event_id",
        numbers.flag(F.dayofweek("ts").isin(1, 7)).alias("is_weekend"),
        F.when(F.col("k") < 10, 1).otherwise(0).alias("is_low"),
        numbers.flag(F.when(F.col("k") > 20, F.col("k") > 50)).alias("is_high"),
    )


@query
def null_default(spark, folder):
    low, k = F.col("k") < 50, F.col("k").cast("double")
    return b.events(spark, folder).select(
        "event_id",
        numbers.null_default(F.when(low, F.col("event_type")), "unknown").alias("label"),
        numbers.null_default(F.when(low, F.col("value")), k).alias("measure"),
    )


# --- E: joins ----------------------------------------------------------------------------


@query
def join_location(spark, folder):
    return gold.locate(b.silver_weather(spark, folder), b.locations(spark, folder)).select(
        "weather_id", "location_key", "electricity_zone"
    )


@query
def join_time_key(spark, folder):
    times = gold.dim_time(spark).select("time_key", "is_weekend")
    events = b.events(spark, folder).select("event_id", "ts")
    return events.join(times, clock.hour_key("ts") == F.col("time_key"), "left")


@query
def join_zone_hour(spark, folder):
    weather = gold.locate(b.silver_weather(spark, folder), b.locations(spark, folder))
    energy = gold.latest_energy(b.silver_energy(spark, folder)).select(
        F.col("zone").alias("electricity_zone"),
        F.col("measurement_hour").alias("observation_hour"),
        "carbon_intensity_gco2eq",
    )
    return weather.join(energy, ["electricity_zone", "observation_hour"], "left").select(
        "weather_id", "electricity_zone", "observation_hour", "carbon_intensity_gco2eq"
    )


@query
def salted_join(spark, folder):
    """Readings with the energy of their zone's hour, hot zones and hours salted."""
    weather = gold.locate(b.silver_weather(spark, folder), b.locations(spark, folder)).select(
        "weather_id", "electricity_zone", "observation_hour"
    )
    energy = gold.latest_energy(b.silver_energy(spark, folder)).select(
        F.col("zone").alias("electricity_zone"),
        F.col("measurement_hour").alias("observation_hour"),
        "carbon_intensity_gco2eq",
    )
    return skew.salted_join(weather, energy, ["electricity_zone", "observation_hour"], share=1 / 2000)


@query
def join_condition_unused(spark, folder):
    weather = b.silver_weather(spark, folder).select("weather_id", CODE)
    labels = fixed.weather_conditions(spark).select(CODE, "condition_label")
    return weather.join(labels, CODE, "left")


@query
def join_star_daily(spark, folder):
    places = b.locations(spark, folder).select("location_key", "city", "country")
    return b.fact(spark, folder).join(places, "location_key", "left").select(
        "fact_id", "time_key", "city", "country"
    )


def _star_month(spark, folder):
    places = b.locations(spark, folder).select("location_key", "city", "country")
    calendar = gold.dim_time(spark).select("time_key", "year", "month", "month_name")
    fact = b.fact(spark, folder).join(places, "location_key", "left")
    return fact.join(calendar, "time_key", "left")


@query
def join_star_monthly(spark, folder):
    return _star_month(spark, folder).select(
        "fact_id", "city", "country", "year", "month", "month_name"
    )


def _star_condition(spark, folder):
    codes = fixed.weather_conditions(spark).select(
        F.col(CODE).alias("weathercode_key"), "condition_category"
    )
    return _star_month(spark, folder).join(codes, "weathercode_key", "left")


@query
def join_star_condition(spark, folder):
    return _star_condition(spark, folder).select(
        "fact_id", "city", "year", "month", "condition_category"
    )


@query
def join_mode_back(spark, folder):
    star, months = _star_condition(spark, folder), ["city", "year", "month"]
    counts = star.groupBy(*months).agg(F.count(F.lit(1)).alias("reading_count"))
    modes = rollup.dominant(star, months, "condition_category").drop("cnt")
    category = numbers.null_default("condition_category", "unknown")
    return counts.join(modes, months, "left").select(
        *months, "reading_count", category.alias("dominant_weather_category")
    )


@query
def fact_build(spark, folder):
    return b.fact(spark, folder)


@query
def pending_weather(spark, folder):
    """Weather and energy of the second half of the month came after the fact's last load."""

    def loaded(df, column):
        late = F.col(column) >= F.lit(b.MIDDLE)
        stamp = F.when(late, F.lit(INGESTED_AT)).otherwise(F.lit(b.MIDDLE)).cast("timestamp")
        return df.withColumn("_loaded_at", stamp)

    weather = b.silver_weather(spark, folder)
    early = weather.withColumn("_loaded_at", F.lit(b.MIDDLE).cast("timestamp"))
    energy = loaded(b.silver_energy(spark, folder), "_ingested_at")
    mark = high_water_mark(early, "_loaded_at")
    return gold.pending_weather(early, energy, b.locations(spark, folder), mark).select(
        "weather_id", "city", "observation_hour"
    )


# --- F: aggregations ---------------------------------------------------------------------


@query
def count_all(spark, folder):
    return rollup.row_count(b.table(spark, folder, "lineitem"))


@query
def max_scalar(spark, folder):
    return high_water_mark(b.events(spark, folder), "ts")


@query
def daily_rollup(spark, folder):
    return gold.agg_daily_energy(b.fact(spark, folder), b.locations(spark, folder), SCALE)


@query
def monthly_rollup(spark, folder):
    places = b.locations(spark, folder).select("location_key", "city", "country")
    calendar = gold.dim_time(spark).select("time_key", "year", "month", "month_name")
    months = ["year", "month", "month_name"]
    return rollup.rollup(
        b.fact(spark, folder).join(calendar, "time_key", "left"),
        ["location_key", *months],
        [(places, ["location_key"])],
        ["city", "country", *months],
        gold.MONTHLY,
        SCALE,
    )


@query
def monthly_report(spark, folder):
    return gold.rpt_weather_energy_correlation(
        b.fact(spark, folder),
        b.locations(spark, folder),
        gold.dim_time(spark),
        fixed.weather_conditions(spark),
        SCALE,
    )


def _reports(spark, folder) -> tuple[str, str]:
    """Both reports of a fact that comes in two loads; the second brings late and changed hours."""
    times, places = gold.dim_time(spark), b.locations(spark, folder)
    rows = gold.fact_energy_readings(
        b.silver_weather(spark, folder), b.silver_energy(spark, folder), places, times, b.LOADED_AT, reports.DATE
    )
    hour, later = F.substring("time_key", 9, 2), F.col(reports.DATE) >= F.lit(b.DAY)
    late, changed = later & (hour == "07"), later & (hour == "03")
    warmer = F.when(changed, F.col("temperature_2m") + 1).otherwise(F.col("temperature_2m"))
    fact, daily, monthly = new_table(spark), new_table(spark), new_table(spark)
    states = reports.states_of(spark, fact, f"{fact}_states", times, SCALE)
    for load in (rows.where(~late).withColumn("temperature_2m", warmer), rows.where(late | changed)):
        up.upsert_table(
            spark, fact, load, ["fact_id"], [reports.DATE], keys_may_move=False, before=states.mark
        )
        reports.refresh_reports(
            states, places, fixed.weather_conditions(spark), daily, monthly, SCALE
        )
    return daily, monthly


@query
def incremental_rollup(spark, folder):
    """The daily roll-up of stored states, of which the second load regroups the touched days."""
    return spark.table(_reports(spark, folder)[0])


@query
def incremental_report(spark, folder):
    """The monthly report of the same states."""
    return spark.table(_reports(spark, folder)[1])


@query
def category_count(spark, folder):
    star = _star_condition(spark, folder)
    return rollup.category_count(star, ["city", "year", "month"], "condition_category")


@query
def conditional_count(spark, folder):
    return b.fact(spark, folder).groupBy("location_key").agg(
        F.count_if(F.isnull("carbon_intensity")).alias("missing_energy_readings")
    )


@query
def null_skipping_stats(spark, folder):
    readings = b.events(spark, folder).select(
        "user_id", "event_type", F.when(F.col("k") < 15, F.col("value")).alias("value")
    )
    measures = [
        rollup.Measure("avg_value", "avg", "value"),
        rollup.Measure("min_value", "min", "value"),
        rollup.Measure("max_value", "max", "value"),
        rollup.Measure("sum_value", "sum", "value"),
        rollup.Measure("missing", "count_null", "value"),
    ]
    keys_ = ["user_id", "event_type"]
    return rollup.Partial.of(readings, keys_, measures, SCALE).result(*keys_)


@query
def group_by_ordinal(spark, folder):
    return spark.sql(
        """
        SELECT l_returnflag, l_linestatus, year(l_shipdate) AS ship_year, count(*) AS n
        FROM {lines} GROUP BY 1, 2, 3
        """,
        lines=b.table(spark, folder, "lineitem"),
    )


@query
def layer_counts(spark, folder):
    return rollup.layer_counts(
        {
            "bronze_weather": b.weather_bronze(spark, folder),
            "bronze_energy": b.energy_bronze(spark, folder),
            "stg_weather_hourly": b.silver_weather(spark, folder),
            "stg_energy_intensity": b.silver_energy(spark, folder),
            "fact_energy_readings": b.fact(spark, folder),
        }
    )


# --- G: windows --------------------------------------------------------------------------


@query
def dedup_latest_city_hour(spark, folder):
    return b.silver_weather(spark, folder)


@query
def dedup_latest_zone_hour(spark, folder):
    return b.silver_energy(spark, folder)


@query
def mode_per_group(spark, folder):
    return rollup.dominant(
        _star_condition(spark, folder), ["city", "year", "month"], "condition_category"
    )


# --- H: sort, limit, set operations ------------------------------------------------------


@query
def union_all(spark, folder):
    events = b.events(spark, folder)
    named = ["click", "view", "error"]
    kinds = [F.col("event_type") == kind for kind in named]
    kinds.append(F.isnull("event_type") | ~F.col("event_type").isin(named))
    labelled = [
        events.where(kind).select(F.lit(i).alias("part"), "event_id", "value")
        for i, kind in enumerate(kinds)
    ]
    return reduce(DataFrame.unionByName, labelled)


@query
def union_sources(spark, folder):
    events = b.events(spark, folder)
    bought, other = events.where("event_type = 'purchase'"), events.where("event_type <> 'purchase'")
    return rollup.union_sources(
        bought.select("event_id", F.col("value").alias("carbon")),
        other.select("event_id", F.col("value").alias("price"), "k"),
    )


@query
def order_by(spark, folder):
    return b.regions(spark, folder).orderBy(
        F.asc_nulls_last("electricity_zone"), F.asc_nulls_last("country"), F.asc_nulls_last("city")
    )


@query
def top_n_recent(spark, folder):
    log = b.run_log(spark, folder)
    return rollup.most_recent(log, "started_at", 10, ["run_id", "status"])


# --- I: scalar functions -----------------------------------------------------------------


@query
def surrogate_key(spark, folder):
    part = F.when(F.col("k") != 3, F.col("event_type"))
    return b.events(spark, folder).select(
        "event_id", keys.surrogate_key("user_id", "ts", part).alias("key")
    )


@query
def hash_key(spark, folder):
    return b.table(spark, folder, "customer").select(
        "c_custkey", keys.hash_key("c_name").alias("key")
    )


@query
def trunc_hour(spark, folder):
    return b.events(spark, folder).select("event_id", clock.trunc_hour("ts").alias("hour"))


@query
def format_time_key(spark, folder):
    return b.events(spark, folder).select(
        "event_id", clock.hour_key("ts").alias("time_key"), clock.hour_text("ts").alias("hh")
    )


@query
def names(spark, folder):
    parts = clock.calendar_parts("o_orderdate")
    return b.table(spark, folder, "orders").select(
        "o_orderkey",
        parts["day_of_week"].alias("day_of_week"),
        parts["month_name"].alias("month_name"),
    )


@query
def calendar_parts(spark, folder):
    parts = clock.calendar_parts("l_shipdate")
    wanted = ["year", "month", "day", "hour", "quarter", "day_of_week_num", "is_weekend"]
    return b.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", *[parts[name].alias(name) for name in wanted]
    )


@query
def key_to_date(spark, folder):
    time_key = F.when(F.col("k") != 3, clock.hour_key("ts"))
    return b.events(spark, folder).select("event_id", clock.key_to_date(time_key).alias("agg_date"))


@query
def round_half_up(spark, folder):
    # Thousandths as decimals, so that halves are exact in both engines.
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    tax = F.col("l_tax").cast("decimal(4,2)")
    return b.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.round(price * tax, 2).cast("double").alias("tax_2"),
        F.round(price * tax * tax, 3).cast("double").alias("tax_3"),
    )


@query
def cast(spark, folder):
    return b.events(spark, folder).select(
        F.col("event_id").cast("string").alias("as_string"),
        F.col("k").cast("double").alias("as_double"),
        F.col("user_id").try_cast("int").alias("as_int"),
        F.col("ts").cast("date").alias("as_date"),
        F.col("event_type").try_cast("int").alias("not_an_int"),
    )


@query
def parse_timestamp(spark, folder):
    minute = F.date_format("ts", "yyyy-MM-dd'T'HH:mm")
    return b.events(spark, folder).select(
        "event_id",
        clock.parse_iso(minute).alias("plain"),
        clock.parse_iso(F.concat(minute, F.lit("Z"))).alias("zulu"),
        clock.parse_iso(F.concat(minute, F.lit(":30+02:00"))).alias("shifted"),
        clock.parse_iso(F.col("event_type")).alias("none"),
    )


@query
def epoch_millis(spark, folder):
    millis = F.unix_millis("ts")
    return b.events(spark, folder).select("event_id", clock.from_epoch_millis(millis).alias("at"))


@query
def load_stamp(spark, folder):
    return b.events(spark, folder).select(
        "event_id", clock.load_stamp(b.LOADED_AT).alias("_loaded_at")
    )


@query
def ingest_date(spark, folder):
    return b.events(spark, folder).select(
        "event_id", clock.ingest_date("ts").alias("ingested_date")
    )


@query
def interval_arith(spark, folder):
    now = F.lit(INGESTED_AT).cast("timestamp")
    return b.events(spark, folder).select(
        "event_id",
        clock.hours_before("ts", 2).alias("two_hours_before"),
        clock.minutes_between("ts", now).alias("minutes"),
    )


@query
def run_id(spark, folder):
    return b.events(spark, folder).select("event_id", clock.run_id("ts").alias("run_id"))


@query
def sequence_explode(spark, folder):
    first = clock.trunc_hour("ts")
    last = F.timestamp_add("HOUR", F.col("k") % 4, first)
    hours = F.sequence(first, last, F.expr("interval 1 hour"))
    return b.events(spark, folder).select("event_id", F.explode(hours).alias("hour"))


@query
def array_access(spark, folder):
    words = F.split("text", " ")
    return b.table(spark, folder, "documents").select(
        "doc_id",
        nested.first_element(words).alias("first_word"),
        F.get(words, F.lit(5)).alias("sixth_word"),
        nested.last_element(words).alias("last_word"),
        F.get(words, F.lit(100_000)).alias("beyond"),
    )


@query
def map_build_lookup(spark, folder):
    table = nested.lookup(b.fuel_mix())
    return b.events(spark, folder).select(
        "event_id",
        F.try_element_at(table, F.lit("wind")).alias("wind"),
        F.coalesce(F.try_element_at(table, F.lit("hydro")), F.lit(0.0)).alias("hydro"),
    )


@query
def json_path(spark, folder):
    return b.events(spark, folder).select(
        "event_id",
        nested.json_text("props", "$.k").cast("int").alias("k"),
        nested.json_text("props", "$.missing", "none").alias("missing"),
        nested.json_text("props", "$.deep.missing").alias("deep"),
    )


@query
def local_to_utc(spark, folder):
    return b.events(spark, folder).select(
        "event_id", clock.local_to_utc("ts", F.lit("Europe/Berlin")).alias("utc")
    )


# --- K: the incremental loads as streams -------------------------------------------------


def _event_stream(spark, folder):
    stream = incremental.read_parquet_stream(spark, f"{folder}/events.parquet")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@query
def stream_upsert(spark, folder):
    table = new_table(spark)
    readings = _event_stream(spark, folder).select(
        "user_id",
        clock.trunc_hour("ts").alias("hour"),
        "ts",
        "event_id",
        "value",
        clock.ingest_date("ts").alias("hour_date"),
    )
    incremental.upsert_stream(
        readings,
        table,
        new_folder(spark, "checkpoint"),
        keys=["user_id", "hour"],
        latest="ts",
        tie_break=["event_id"],
        partition_cols=["hour_date"],
    ).awaitTermination()
    return spark.table(table)


@query
def stream_dedup(spark, folder):
    table = new_table(spark)
    keyed = _event_stream(spark, folder).select(
        "user_id", clock.trunc_hour("ts").alias("hour"), clock.ingest_date("ts").alias("hour_date")
    )
    incremental.distinct_stream(
        keyed, table, new_folder(spark, "checkpoint"), ["user_id", "hour", "hour_date"], ["hour_date"]
    ).awaitTermination()
    return spark.table(table).select("user_id", "hour")


def _daily(rows: DataFrame) -> DataFrame:
    units = numbers.to_units("value", SCALE)
    totals = rows.groupBy("day", "event_type").agg(
        F.sum(units).alias("units"),
        F.count(F.lit(1)).alias("n"),
        F.max("value").alias("max_value"),
    )
    total = numbers.from_units(F.col("units"), SCALE).alias("total")
    return totals.select("event_type", total, "n", "max_value", "day")


@query
def stream_daily(spark, folder):
    """Days and types of all events, the last day included."""
    rows, table = new_table(spark), new_table(spark)
    events = _event_stream(spark, folder).select(
        "event_id", "event_type", "ts", "value", clock.ingest_date("ts").alias("day")
    )
    incremental.rollup_stream(
        events,
        rows,
        table,
        new_folder(spark, "checkpoint"),
        keys=["event_id", "day"],
        latest="ts",
        tie_break=["event_type", "value"],
        partition_cols=["day"],
        rollup=_daily,
    ).awaitTermination()
    return spark.table(table)


def _by_day(spark, folder) -> tuple[str, StructType]:
    """Events in a file a day and half, which a stream reads one or two at a time."""
    path = new_folder(spark, "days")
    half = F.hour("ts") >= 12
    events = b.events(spark, folder).select("event_id", "user_id", "event_type", "ts", "value")
    events.repartition(8, F.to_date("ts"), half).write.option("maxRecordsPerFile", 20_000).parquet(path)
    return path, events.schema


def _admitted(spark, folder, delay: timedelta) -> tuple[str, StructType]:
    days, schema = _by_day(spark, folder)
    path = new_folder(spark, "admitted")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 3).parquet(days)
    stateful.admit_stream(stream, path, new_folder(spark, "checkpoint"), "ts", delay).awaitTermination()
    return path, schema


@query
def stream_dedup_within(spark, folder):
    """Users by hour: those that the state store let through, and those that came too late for it."""
    delay = timedelta(hours=30)
    path, schema = _admitted(spark, folder, delay)
    hours = lambda rows: rows.withColumn("hour", clock.trunc_hour("ts")).select("user_id", "hour", "ts")
    keys, out = ["user_id", "hour"], new_folder(spark, "distinct")
    stateful.distinct_within(
        hours(stateful.on_time_stream(spark, path, schema)), out, new_folder(spark, "checkpoint"), keys, "ts", delay
    ).awaitTermination()
    late = hours(stateful.late_rows(spark, path, schema)).select(*keys)
    found = spark.read.schema("user_id long, hour timestamp").parquet(out)
    return found.unionByName(late).distinct()


@query
def stream_windows(spark, folder):
    """Daily totals: closed windows of the stream, open ones, and late rows merged into them."""
    delay = timedelta(hours=30)
    path, schema = _admitted(spark, folder, delay)
    out, keys = new_folder(spark, "windows"), ["event_type"]
    states = [
        F.sum(numbers.to_units("value", SCALE)).alias("units"),
        F.count(F.lit(1)).alias("n"),
        F.max("value").alias("max_value"),
    ]
    merged = [F.sum("units").alias("units"), F.sum("n").alias("n"), F.max("max_value").alias("max_value")]
    stream = stateful.on_time_stream(spark, path, schema)
    run = stateful.closed_windows(
        stream, out, new_folder(spark, "checkpoint"), "ts", delay, "1 day", keys, states
    )
    run.awaitTermination()
    on_time, late = stateful.on_time_rows(spark, path, schema), stateful.late_rows(spark, path, schema)
    total = stateful.all_windows(spark.read.parquet(out), on_time, late, "ts", "1 day", keys, states, merged)
    value = numbers.from_units(F.col("units"), SCALE).alias("total")
    return total.select("event_type", value, "n", "max_value", F.to_date("window_start").alias("day"))


@query
def stream_ingest(spark, folder):
    """Documents landed as files: readings that fit, and how many did not and why."""
    path, out = new_folder(spark, "landed"), new_folder(spark, "ingested")
    k, payload = F.col("k"), F.col("props")
    b.events(spark, folder).select(
        F.col("user_id").cast("string").alias("city"),
        F.col("ts").alias("ingested_at"),
        F.when(k < 5, F.lit("{broken")).when(k < 9, F.lit(None)).otherwise(payload).alias("payload"),
    ).repartition(6).write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path)

    def check(landed: DataFrame) -> DataFrame:
        rows = landed.select("city", "ingested_at", F.col("payload.k").alias("k"), "payload_error")
        return contracts.enforce(
            rows, "city string not null, ingested_at timestamp not null, k int", extra=F.col("payload_error")
        )

    stream = landed_stream(spark, path, "k int", files_per_batch=2)
    stateful.ingest_stream(stream, check, out, new_folder(spark, "checkpoint")).awaitTermination()
    good, rejected = stateful.ingested(spark, out, check(read_landed(spark, path, "k int")).schema)
    sound = good.select("city", "k", F.lit("").alias("reason"))
    reason = F.array_join(contracts.REJECT, "; ").alias("reason")
    return (
        sound.unionByName(rejected.select("city", "k", reason))
        .groupBy("city", "k", "reason")
        .agg(F.count(F.lit(1)).alias("n"))
    )
