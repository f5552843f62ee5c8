from __future__ import annotations

import json
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.plans import bronze, gold, silver
from tidemark.plans.checks import CONTRACTS
from tidemark.plans.medallion import AlreadyRunning, NothingIngested, Store
from tidemark.sources import fixed
from tidemark.sources.files import seed_csv
from tidemark.sources.landed import read_landed

SEED = str(Path(__file__).resolve().parents[1] / "seeds" / "regions.csv")
DAY, NEXT = date(2024, 1, 15), date(2024, 1, 16)
RUN = datetime(2024, 1, 15, 6)
HOURS = [f"2024-01-15T{h:02d}:00" for h in range(24)]


def land(folder, documents, keys=("city", "ingested_at")):
    folder.mkdir(parents=True, exist_ok=True)
    lines = []
    for *values, payload in documents:
        row = dict(zip(keys, values)) | {
            "payload": payload if isinstance(payload, str) else json.dumps(payload)
        }
        lines.append(json.dumps(row))
    (folder / "part.json").write_text("\n".join(lines))
    return str(folder)


def weather_document(shift=0.0, **changes):
    hourly = {
        "time": HOURS,
        "temperature_2m": [shift + h for h in range(24)],
        "windspeed_10m": [1.0] * 24,
        "weathercode": [61.0] * 12 + [0.0] * 12,
        "precipitation": [0.5] * 24,
    }
    return {"hourly": hourly | changes}


def weather(spark, folder, documents):
    return read_landed(spark, land(folder, documents), bronze.WEATHER_PAYLOAD)


def stamped(documents, at="2024-01-15T06:00:00Z"):
    return [(city, at, payload) for city, payload in documents]


def energy(spark, folder, at="2024-01-15T06:10:00Z", actual=0, price=80.5, chunk=20, day=15):
    intensity = {
        "data": [{"from": f"2024-01-{day}T06:00Z", "intensity": {"actual": actual, "forecast": 150}}]
    }
    mix = [("wind", 30.0), ("nuclear", 10.0), ("gas", 60.0)]
    generation = {"data": {"generationmix": [{"fuel": f, "perc": p} for f, p in mix]}}
    series = {"series": [[1705298400000, price], [1705302000000, None]]}
    keyed = ("city", "chunk_ts")
    chunks = [("Berlin", 20, series), ("Vienna", 20, {"series": [[1705298400000, None]]})]
    index = [("Berlin", at, {"timestamps": [10, chunk]}), ("Vienna", at, {"timestamps": []})]
    read = lambda name, docs, schema, keys="city string, ingested_at timestamp": read_landed(
        spark, land(folder / name, docs), schema, keys
    )
    return [
        bronze.intensity_reading(
            read("intensity", [("London", at, intensity)], bronze.INTENSITY_PAYLOAD),
            read("generation", [("London", at, generation)], bronze.GENERATION_PAYLOAD),
        ),
        bronze.price_reading(
            read("index", index, bronze.INDEX_PAYLOAD),
            read_landed(
                spark,
                land(folder / "chunks", chunks, keyed),
                bronze.CHUNK_PAYLOAD,
                "city string, chunk_ts bigint",
            ),
        ),
    ]


# --- raw layer ---------------------------------------------------------------------------


def test_weather_rows_are_utc_and_checked(spark, tmp_path, rows):
    berlin = weather_document(weathercode=[None] * 24, windspeed_10m=[3.0])
    landed = weather(
        spark,
        tmp_path,
        stamped(
            [
                ("Berlin", berlin),
                ("Rome", "{not json"),
                ("Paris", {}),
                ("Madrid", weather_document(time=["2024-01-15T00:00", "soon"])),
                ("Atlantis", weather_document()),
            ]
        ),
    )
    checked = bronze.weather_rows(landed, fixed.cities(spark))
    good = checked.where("size(reject_reason) = 0")
    assert rows(good.groupBy("city").count()) == [("Berlin", 24), ("Madrid", 1)]
    first = good.where("city = 'Berlin'").orderBy("hour").first()
    assert (first["hour"], first["country"], first["windspeed_10m"], first["weathercode"]) == (
        datetime(2024, 1, 14, 23), "DE", 3.0, None,
    )
    assert first["ingested_date"] == DAY and first["source"] == "open_meteo"
    literal = bronze.weather_rows(landed, fixed.cities(spark), hours_are_utc=True)
    assert literal.where("city = 'Berlin'").agg(F.min("hour")).first()[0] == datetime(2024, 1, 15)
    reasons = {r["city"]: r["reject_reason"] for r in checked.where("size(reject_reason) > 0").collect()}
    assert reasons["Rome"][0] == "payload: malformed JSON"
    assert reasons["Paris"] == ["hour: null"]
    assert reasons["Madrid"] == ["hour: null"]
    assert "country: null" in reasons["Atlantis"]


def test_energy_rows_of_both_sources(spark, tmp_path, rows):
    checked = bronze.energy_rows(energy(spark, tmp_path), fixed.zones(spark))
    names = [
        "zone", "carbon_intensity", "fossil_free_pct", "renewable_pct",
        "day_ahead_price_eur_mwh", "measurement_at", "source",
    ]
    assert rows(checked.where("size(reject_reason) = 0"), *names) == [
        ("AT", None, None, None, None, datetime(2024, 1, 15, 6, 10), "smard"),
        ("DE", None, None, None, 80.5, datetime(2024, 1, 15, 6), "smard"),
        ("GB", 0.0, 40.0, 30.0, None, datetime(2024, 1, 15, 6), "uk_carbon_intensity"),
    ]


def test_copies_of_documents_do_not_multiply(spark, tmp_path):
    at = "2024-01-15T06:10:00Z"
    intensity = ("London", at, {"data": [{"intensity": {"actual": 5}}]})
    generation = ("London", at, {"data": {"generationmix": []}})
    left = read_landed(
        spark, land(tmp_path / "i", [intensity] * 50 + [("London", at, "{")]), bronze.INTENSITY_PAYLOAD
    )
    right = read_landed(spark, land(tmp_path / "g", [generation] * 50), bronze.GENERATION_PAYLOAD)
    reading = bronze.intensity_reading(left, right).collect()
    assert [(r["carbon_intensity"], r["payload_error"]) for r in reading] == [(5.0, None)]


def test_energy_failures_have_reasons(spark, tmp_path, rows):
    readings = energy(spark, tmp_path, chunk=99)
    checked = bronze.energy_rows(readings, fixed.zones(spark))
    bad = checked.where("size(reject_reason) > 0")
    assert rows(bad, "city", "reject_reason") == [("Berlin", ["chunk: missing document"])]


# --- stored layers -----------------------------------------------------------------------


@pytest.fixture
def store(spark, database):
    return Store(spark, database)


def ingest_weather(store, spark, folder, documents, at="2024-01-15T06:00:00Z", day=DAY):
    landed = weather(spark, folder, stamped(documents, at))
    store.ingest_weather(landed, day, RUN)


def test_ingest_logs_failures_and_replaces_the_day(store, spark, tmp_path, rows):
    everyone = [(city[0], weather_document()) for city in fixed.CITIES]
    ingest_weather(store, spark, tmp_path / "1", everyone)
    assert store.table("bronze_weather").count() == 240
    broken = [*everyone[:-1], ("Lisbon", "oops"), ("Nowhere", "oops")]
    ingest_weather(store, spark, tmp_path / "2", broken)
    assert store.table("bronze_weather").count() == 216
    logged = store.table("bronze_audit").drop("ingested_at")
    assert rows(logged) == [
        ("open_meteo", "ALL_CITIES", 216, "SUCCESS", None),
        ("open_meteo", "ALL_CITIES", 240, "SUCCESS", None),
        ("open_meteo", "Lisbon", 0, "FAILED", rows(logged.where("city = 'Lisbon'"))[0][4]),
        ("open_meteo", "Nowhere", 0, "FAILED", rows(logged.where("city = 'Nowhere'"))[0][4]),
    ]
    with pytest.raises(NothingIngested):
        ingest_weather(store, spark, tmp_path / "3", [("Rome", "oops")])
    assert store.table("bronze_weather").count() == 216
    assert rows(store.table("bronze_audit").where("status = 'FAILED'").groupBy().count()) == [(12,)]


def test_rows_of_another_day_are_rejected_and_audited(store, spark, tmp_path, rows):
    on_time = stamped([("Rome", weather_document())], "2024-01-15T23:59:59Z")
    late = stamped([("Berlin", weather_document())], "2024-01-16T00:00:01Z")
    landed = weather(spark, tmp_path, [*on_time, *late])
    store.ingest_weather(landed, DAY, RUN)
    assert rows(store.table("bronze_weather").select("city").distinct()) == [("Rome",)]
    berlin = store.table("bronze_audit").where("city = 'Berlin'").first()
    assert (berlin["status"], berlin["row_count"]) == ("FAILED", 0)
    assert berlin["error_message"] == "ingested_date: not the run's day"


def test_a_partial_run_can_keep_the_other_countries(store, spark, tmp_path):
    everyone = [(city[0], weather_document()) for city in fixed.CITIES]
    ingest_weather(store, spark, tmp_path / "1", everyone)
    landed = weather(spark, tmp_path / "2", stamped([("Rome", weather_document())], "2024-01-15T07:00:00Z"))
    store.ingest_weather(landed, DAY, RUN, scope="partition")
    assert store.table("bronze_weather").count() == 240


def test_failures_of_an_empty_database_and_of_empty_raw_tables(store, spark, rows):
    assert rows(store.failures()) == []
    empty = spark.createDataFrame([], "city string, country string, hour timestamp, source string")
    empty.write.saveAsTable(store.name("bronze_weather"))
    assert rows(store.failures()) == [("bronze_weather", "not_empty", None, 1)]


def test_orphans_and_uncovered_hours_fail_and_a_rebuild_mends_a_wrong_load(store, spark, tmp_path, rows):
    everyone = [(city[0], weather_document()) for city in fixed.CITIES]
    ingest_weather(store, spark, tmp_path / "w", everyone)
    store.ingest_energy(energy(spark, tmp_path / "e"), DAY, RUN)
    store.build_silver(datetime(2024, 1, 15, 7))
    store.snapshot_locations(seed_csv(spark, SEED), datetime(2024, 1, 1))
    store.build_gold(datetime(2024, 1, 15, 8), start=datetime(2024, 1, 15, 3))
    failing = {(r["test"], r["column_name"]) for r in store.failures().collect()}
    assert ("parent", "time_key") in failing and ("not_null", "time_key") in failing
    good = rows(store.table("stg_weather_hourly"), "weather_id")
    spark.sql(f"DROP TABLE {store.name('stg_weather_hourly')}")
    store.build_silver(datetime(2024, 1, 15, 9))
    store.forget()
    assert not store.has("fact_energy_readings")
    store.build_silver(datetime(2024, 1, 15, 10))
    store.build_gold(datetime(2024, 1, 15, 11))
    assert rows(store.table("stg_weather_hourly"), "weather_id") == good
    assert rows(store.failures()) == []
    spark.sql(f"CREATE OR REPLACE TEMP VIEW no_rome AS SELECT * FROM {store.name('dim_location')} WHERE city <> 'Rome'")
    from tidemark.operators.tables import full_refresh

    full_refresh(spark.table("no_rome"), store.name("dim_location"))
    assert ("fact_energy_readings", "parent", "location_key", 24) in rows(store.failures())


def test_a_long_error_is_logged_whole(store):
    def fail():
        raise OSError("x" * 5000)

    with pytest.raises(OSError):
        store.guarded_run(datetime(2024, 1, 1), fail)
    failed = store.table("pipeline_run_log").where("status = 'FAILED'").first()
    assert len(failed["error"]) == 5000


def test_guard_blocks_a_second_run_and_records_the_end(store, spark, rows):
    started = datetime.now().replace(microsecond=0)
    ran = []

    def nested():
        ran.append("outer")
        with pytest.raises(AlreadyRunning):
            store.guarded_run(started, lambda: ran.append("inner"))

    run = store.guarded_run(started, nested)
    assert ran == ["outer"]
    with pytest.raises(OSError):
        store.guarded_run(started.replace(second=(started.second + 1) % 60), _fail)
    assert rows(store.table("pipeline_run_log"), "status", "error") == [
        ("FAILED", "network"),
        ("RUNNING", None),
        ("RUNNING", None),
        ("SUCCESS", None),
    ]
    assert rows(store.table("pipeline_run_log").where(F.col("run_id") == run), "status") == [
        ("RUNNING",),
        ("SUCCESS",),
    ]


def _fail():
    raise OSError("network")


def test_a_stuck_run_can_be_cleared(store, spark):
    from tidemark.operators import audit

    started = datetime(2024, 1, 1)
    log = store.name("pipeline_run_log")
    audit.append_table(audit.run_row(spark, "stuck", started, audit.RUNNING), log)
    now = F.lit(datetime(2024, 1, 1, 1))
    assert audit.is_running(spark, log, now)
    store.clear_run("stuck", datetime(2024, 1, 1, 1))
    assert not audit.is_running(spark, log, now)


def test_end_to_end_twice_and_late_energy(store, spark, tmp_path, rows):
    everyone = [(city[0], weather_document()) for city in fixed.CITIES]
    ingest_weather(store, spark, tmp_path / "w1", everyone)
    regions = seed_csv(spark, SEED)
    store.ingest_energy(energy(spark, tmp_path / "e1"), DAY, RUN)
    store.build_silver(datetime(2024, 1, 15, 7))
    store.snapshot_locations(regions, datetime(2024, 1, 1))
    store.build_gold(datetime(2024, 1, 15, 8))

    assert store.table("stg_weather_hourly").count() == 240
    assert store.table("dim_time").count() == 17_544
    fact = store.table("fact_energy_readings")
    assert fact.count() == 240
    assert fact.where("carbon_intensity is not null").count() == 1
    assert fact.where("day_ahead_price_eur_mwh = 80.5").count() == 1
    assert fact.where("energy_ingested_at is not null").count() == 3
    assert rows(store.failures()) == []
    daily = store.table("agg_daily_energy")
    # Local days of cities east of London begin before UTC midnight.
    assert daily.where("agg_date = '2024-01-15'").count() == 10
    london = daily.where("city = 'London'").first()
    assert (
        london["avg_temperature"], london["max_temperature"], london["total_precipitation_mm"],
        london["avg_carbon_intensity"], london["reading_count"], london["missing_energy_readings"],
    ) == (11.5, 23.0, 12.0, 0.0, 24, 23)
    report = {r["city"]: r for r in store.table("rpt_weather_energy_correlation").collect()}
    assert len(report) == 10
    assert report["London"]["dominant_weather_category"] == "rainy"  # a tie: the lower name
    assert report["London"]["temp_carbon_profile"] == "cool_clean"
    assert report["Rome"]["temp_carbon_profile"] == "unknown"

    before = {name: rows(store.table(name)) for name in CONTRACTS if store.has(name)}
    store.build_silver(datetime(2024, 1, 15, 9))
    store.snapshot_locations(regions, datetime(2024, 1, 15, 9))
    store.build_gold(datetime(2024, 1, 15, 9))
    assert {name: rows(store.table(name)) for name in before} == before

    # A second energy run within the same hour replaces the first one's reading in the fact.
    late = energy(spark, tmp_path / "e2", at="2024-01-15T06:40:00Z", actual=None, price=99.0)
    store.ingest_energy(late, DAY, RUN)
    store.build_silver(datetime(2024, 1, 15, 10))
    store.build_gold(datetime(2024, 1, 15, 11))
    fact = store.table("fact_energy_readings")
    assert fact.count() == fact.select("fact_id").distinct().count() == 240
    assert rows(fact.where("carbon_intensity is not null"), "carbon_intensity") == [(150.0,)]
    assert rows(fact.where("day_ahead_price_eur_mwh is not null"), "day_ahead_price_eur_mwh") == [(99.0,)]
    assert store.table("stg_energy_intensity").count() == 6

    moved = regions.withColumn(
        "electricity_zone", F.when(F.col("city") == "Rome", "IT-2").otherwise(F.col("electricity_zone"))
    )
    store.snapshot_locations(moved, datetime(2024, 1, 16))
    assert store.table("snap_dim_location").count() == 11
    store.build_gold(datetime(2024, 1, 16, 1))
    assert store.table("dim_location").count() == 10

    counts = store.export(lambda df, name: df.write.parquet(f"{tmp_path}/out/{name}"))
    assert list(counts) == [
        "dim_weather_condition", "dim_time", "dim_location", "fact_energy_readings",
        "agg_daily_energy", "rpt_weather_energy_correlation",
    ]
    assert counts["fact_energy_readings"] == 240 and counts["dim_weather_condition"] == 21


def test_hours_outside_the_spine_have_no_time_key_and_are_reported(spark, rows):
    hour = datetime(2026, 1, 1, 5)
    raw = spark.createDataFrame(
        [("Rome", "IT", 1.0, 1.0, "UTC", hour, 5.0, 1.0, 3, 0.0, hour, hour.date(), "s")],
        bronze.WEATHER_SCHEMA,
    )
    regions = seed_csv(spark, SEED)
    from tidemark.operators.scd import first_versions

    places = gold.dim_location(first_versions(regions, "city", RUN))
    empty = spark.createDataFrame([], bronze.ENERGY_SCHEMA)
    fact = gold.fact_energy_readings(
        silver.stg_weather_hourly(raw), silver.stg_energy_intensity(empty), places, gold.dim_time(spark)
    )
    assert rows(fact, "time_key") == [(None,)]
    report = gold.rpt_weather_energy_correlation(
        fact, places, gold.dim_time(spark), fixed.weather_conditions(spark)
    ).first()
    assert (report["year"], report["dominant_weather_category"]) == (None, "unknown")
    assert report["temp_carbon_profile"] == "unknown"


def test_profile_thresholds(spark, rows):
    df = spark.createDataFrame(
        [(15.0, 200.0), (15.0, 200.1), (14.9, 200.0), (14.9, 201.0), (None, 1.0), (20.0, None)],
        "t double, c double",
    )
    got = [r[0] for r in df.select(gold.temp_carbon_profile("t", "c")).collect()]
    assert got == ["warm_clean", "warm_carbon", "cool_clean", "cool_carbon", "unknown", "unknown"]
