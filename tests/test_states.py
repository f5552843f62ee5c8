"""Stored partial states: equal to a rebuild after any loads, and read only what loads touched."""

from __future__ import annotations

import random
import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators.rollup import Measure, Partial
from tidemark.operators.states import StoredStates, refresh_report
from tidemark.operators.upsert import touched_rows, upsert_table
from tidemark.plans import gold, reports
from tidemark.sources.fixed import weather_conditions

MEASURES = [
    Measure("mean", "avg", "v"), Measure("total", "sum", "v"), Measure("low", "min", "v"),
    Measure("high", "max", "v"), Measure("n", "count"), Measure("missing", "count_null", "v"),
]
ROW = "id int, kind string, v double, day date"


def states_of(spark, fact):
    grouped = lambda rows: Partial.of(rows, ["kind", "day"], MEASURES, 2).df.select(
        "kind", "_sum_v", "_n_v", "_min_v", "_max_v", "_rows", "_null_v", "day"
    )
    return StoredStates(spark, fact, f"{fact}_states", "day", grouped)


def by_kind(states):
    return Partial.stored(states, MEASURES, 2).merge(["kind", "day"]).result("kind", "day")


def load(spark, states, data):
    batch = spark.createDataFrame(data, ROW)
    upsert_table(spark, states.fact, batch, ["id"], ["day"], before=states.mark)


def refresh(states, report):
    with states.refreshed() as days:
        refresh_report(states.spark, by_kind(states.of(days)), report, ["day"], days)


@pytest.mark.parametrize("seed", [1])
def test_late_changed_and_moved_rows_give_what_a_rebuild_gives(spark, database, rows, seed):
    picks = random.Random(seed)
    states, report = states_of(spark, f"{database}.fact"), f"{database}.report"
    held = {}
    for step in range(4):
        batch = {}
        for _ in range(picks.randrange(1, 12)):
            day = picks.choice([None, *(date(2024, 1, 1) + timedelta(days=k) for k in range(6))])
            row = (picks.randrange(25), picks.choice("abc"), picks.choice([None, picks.randrange(400) / 4]), day)
            batch[row[0]] = row
        held |= batch
        load(spark, states, list(batch.values()))
        if step != 1:  # Two loads may come before one build.
            refresh(states, report)
            whole = by_kind(states.grouped(spark.createDataFrame(list(held.values()), ROW)))
            columns = ["kind", "day", *(m.name for m in MEASURES)]
            assert rows(spark.table(report), *columns) == rows(whole, *columns)
            assert spark.table(states.marks).count() == 0


def test_a_build_that_is_cut_off_is_done_again(spark, database, rows):
    states, report = states_of(spark, f"{database}.fact"), f"{database}.report"
    load(spark, states, [(1, "a", 1.0, date(2024, 1, 1)), (2, "a", 2.0, date(2024, 1, 2))])
    refresh(states, report)
    load(spark, states, [(1, "a", 5.0, date(2024, 1, 1))])
    with pytest.raises(RuntimeError):
        with states.refreshed():
            raise RuntimeError("lost")
    assert rows(spark.table(report), "day", "total")[0] == (date(2024, 1, 1), 1.0)
    refresh(states, report)
    assert rows(spark.table(report), "day", "total") == [(date(2024, 1, 1), 5.0), (date(2024, 1, 2), 2.0)]
    # A load that marked its days and then failed costs a regrouping, no more.
    states.mark(spark.createDataFrame([(date(2024, 1, 2),), (date(2030, 1, 1),)], "day date"))
    refresh(states, report)
    assert rows(spark.table(report), "day", "total") == [(date(2024, 1, 1), 5.0), (date(2024, 1, 2), 2.0)]


def files_of(spark, table):
    read = spark.table(table).select("day", F.col("_metadata.file_path").alias("path")).distinct()
    return {r["day"]: r["path"] for r in read.collect()}


def test_only_touched_partitions_are_read_and_written(spark, database):
    states, report = states_of(spark, f"{database}.fact"), f"{database}.report"
    days = [date(2024, 1, 1) + timedelta(days=k) for k in range(20)]
    load(spark, states, [(k, "a", float(k), day) for k, day in enumerate(days)])
    refresh(states, report)
    before = {t: files_of(spark, t) for t in (states.table, report)}
    load(spark, states, [(4, "a", 9.0, days[4])])
    refresh(states, report)
    for table, old in before.items():
        new = files_of(spark, table)
        assert [d for d in days if new[d] != old[d]] == [days[4]]
    touched = spark.createDataFrame([(days[4],)], "day date")
    scan = states.grouped(touched_rows(spark.table(states.fact), touched, ["day"]))
    text = scan._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*day#\d+ >= 2024-01-05[^\]]*day#\d+ <= 2024-01-05", text)
    scanned = [m for m in re.findall(r"FileScan parquet [^\n]*", text) if "fact[" in m]
    assert len(scanned) == 1


# --- the two reports -----------------------------------------------------------------------


def reading(city, hour, temperature, code=0, carbon=None, in_spine=True):
    return (
        f"{city}{hour}", city, hour.strftime("%Y%m%d%H") if in_spine else None, code, temperature, 1.0,
        0.25, carbon, 50.0, 25.0, hour.date(),
    )


READING = (
    "fact_id string, location_key string, time_key string, weathercode_key int, temperature_2m double, "
    "windspeed_10m double, precipitation double, carbon_intensity double, fossil_free_pct double, "
    "renewable_pct double, observation_date date"
)


def test_both_reports_equal_a_rebuild(spark, database, rows):
    times, conditions = gold.dim_time(spark), weather_conditions(spark)
    key = times.select("time_key").first()[0]
    assert len(key) == 10 and key.isdigit()
    places = spark.createDataFrame(
        [("p", "Paris", "FR"), ("r", "Rome", "IT")], "location_key string, city string, country string"
    )
    fact, daily, monthly = (f"{database}.{t}" for t in ("fact", "daily", "monthly"))
    states = reports.states_of(spark, fact, f"{database}.states", times)
    start = datetime(2024, 1, 30)
    hours = [start + timedelta(hours=7 * k) for k in range(12)]
    picks = random.Random(4)
    first = [reading(c, h, picks.randrange(40) / 2, picks.choice([0, 61, 95]), picks.choice([None, 100.0, 300.0])) for c in "pr" for h in hours]
    loads = [
        first,
        [reading("p", hours[3], -30.0, 61, 100.0), reading("q", hours[4], 1.0)],
        # Outside the spine: no time key, so a group without a date, which later goes.
        [reading("r", hours[5], 44.0, in_spine=False), reading("r", hours[9], 3.0, in_spine=False)],
        [reading("r", hours[5], 4.0), reading("r", hours[9], 5.0)],
    ]
    for data in loads:
        batch = spark.createDataFrame(data, READING)
        upsert_table(spark, fact, batch, ["fact_id"], [reports.DATE], keys_may_move=False, before=states.mark)
        reports.refresh_reports(states, places, conditions, daily, monthly)
        now = spark.table(fact)
        whole = gold.agg_daily_energy(now, places)
        assert rows(spark.table(daily), *whole.columns) == rows(whole)
        report = gold.rpt_weather_energy_correlation(now, places, times, conditions)
        assert rows(spark.table(monthly), *report.columns) == rows(report)
    renamed = places.withColumn("country", F.lit("EU"))
    states.mark_reports()
    reports.refresh_reports(states, renamed, conditions, daily, monthly)
    assert rows(spark.table(daily).select("country").distinct()) == [("EU",), (None,)]
    states.mark_states()
    later = times.where("time_key >= '2024020100'")
    reports.refresh_reports(reports.states_of(spark, fact, states.table, later), places, conditions, daily, monthly)
    report = gold.rpt_weather_energy_correlation(spark.table(fact), places, later, conditions)
    assert rows(spark.table(monthly), *report.columns) == rows(report)
