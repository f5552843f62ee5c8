"""The file ledger and the lease of a store."""

from __future__ import annotations

import os
import threading
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.operators.lease import Lease, LeaseLost
from tidemark.operators.ledger import FileLedger, rows_of
from tidemark.plans.medallion import AlreadyRunning, Store
from tidemark.operators.upsert import location_of
from tidemark.session import dynamic_overwrite, new_folder

ROW = "id int, stamp timestamp, day date"
T1, T2 = datetime(2024, 1, 1, 6), datetime(2024, 1, 2, 6)


def append(spark, table, *data):
    rows = spark.createDataFrame([(i, t, t.date()) for i, t in data], ROW)
    rows.coalesce(1).write.partitionBy("day").mode("append").format("parquet").saveAsTable(table)


def load(ledger, table, consumer="copy"):
    with ledger.unread(ledger.spark.table(table), consumer) as rows:
        return sorted(r["id"] for r in rows.collect())


def test_late_files_with_equal_and_older_stamps_are_read_once(spark, database):
    table, ledger = f"{database}.t", FileLedger(spark, f"{database}.ledger")
    append(spark, table, (1, T2), (2, T2))
    assert load(ledger, table) == [1, 2]
    assert load(ledger, table) == []
    append(spark, table, (3, T2))
    append(spark, table, (4, T1))
    assert load(ledger, table) == [3, 4]
    assert load(ledger, table) == []
    assert load(ledger, table, "another") == [1, 2, 3, 4]
    ledger.forget("copy")
    assert load(ledger, table, "another") == [] and load(ledger, table) == [1, 2, 3, 4]


def test_a_load_that_fails_reads_its_files_again(spark, database):
    table, ledger = f"{database}.t", FileLedger(spark, f"{database}.ledger")
    append(spark, table, (1, T1))
    with pytest.raises(OSError):
        with ledger.unread(spark.table(table), "copy") as rows:
            assert rows.count() == 1
            raise OSError("lost")
    assert load(ledger, table) == [1]


def age(spark, table, pattern):
    """Give files of a table an old time."""
    found = list(Path(location_of(spark, table).removeprefix("file:")).rglob(pattern))
    for path in found:
        os.utime(path, (10**9, 10**9))
    spark.catalog.refreshTable(table)
    assert found


def test_replaced_and_old_files(spark, database):
    """A file with the time of an old one counts by its name; a replaced one counts again."""
    table, ledger = f"{database}.t", FileLedger(spark, f"{database}.ledger")
    append(spark, table, (1, T1))
    assert load(ledger, table) == [1]
    append(spark, table, (2, T2))
    age(spark, table, "day=2024-01-02/*.parquet")
    assert load(ledger, table) == [2]
    rows = spark.createDataFrame([(5, T1, T1.date())], ROW)
    with dynamic_overwrite(spark):
        rows.write.insertInto(table, overwrite=True)
    assert load(ledger, table) == [5]


def scanned_files(df):
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().get("numFiles").get().value()


def test_files_before_the_unread_ones_are_not_opened(spark, database):
    table, ledger = f"{database}.t", FileLedger(spark, f"{database}.ledger")
    for k in range(5):
        append(spark, table, (k, datetime(2024, 1, 1 + k)))
    age(spark, table, "*.parquet")
    assert load(ledger, table) == [0, 1, 2, 3, 4]
    append(spark, table, (9, datetime(2024, 1, 3)))
    files = ledger.unread_files(spark.table(table), "copy")
    rows = rows_of(spark.table(table), spark.createDataFrame(files.collect(), files.schema))
    assert [r["id"] for r in rows.collect()] == [9]
    since = files.agg(F.min("modified")).first()[0]
    assert scanned_files(spark.table(table).select("id")) == 6
    assert scanned_files(spark.table(table).where(F.col("_metadata.file_modification_time") >= F.lit(since)).select("id")) == 1


# --- the store -----------------------------------------------------------------------------


def test_the_reading_that_was_ingested_last_stays_whatever_the_order_of_loads(spark, database, rows):
    store = Store(spark, database)

    def raw(hour, temperature, at):
        data = [("Rome", "IT", 1.0, 1.0, "UTC", hour, temperature, 1.0, 3, 0.0, at, at.date(), "s")]
        from tidemark.plans import bronze

        frame = spark.createDataFrame(data, bronze.WEATHER_SCHEMA)
        frame.write.partitionBy("ingested_date", "country").mode("append").format("parquet").saveAsTable(store.name("bronze_weather"))

    from tidemark.plans import bronze

    spark.createDataFrame([], bronze.ENERGY_SCHEMA).write.saveAsTable(store.name("bronze_energy"))
    hour = datetime(2024, 1, 10, 5)
    raw(hour, 5.0, T2)
    store.build_silver(T2)
    raw(hour, 4.0, T1)  # older: comes too late to count
    raw(datetime(2024, 1, 10, 6), 6.0, T1)  # older, but the only one of its hour
    raw(datetime(2024, 1, 10, 7), 7.0, T2)  # with a stamp that was loaded before
    store.build_silver(datetime(2024, 1, 3))
    cleaned = store.table("stg_weather_hourly")
    assert rows(cleaned, "temperature_2m") == [(5.0,), (6.0,), (7.0,)]
    before = rows(cleaned)
    store.build_silver(datetime(2024, 1, 4))
    assert rows(store.table("stg_weather_hourly")) == before
    store.forget()
    store.build_silver(T2)
    assert rows(store.table("stg_weather_hourly"), "temperature_2m") == [(5.0,), (6.0,), (7.0,)]


# --- the lease -----------------------------------------------------------------------------


class Clock:
    def __init__(self):
        self.now = 1_000_000

    def __call__(self):
        return self.now


@pytest.fixture
def leases(spark):
    folder, clock = new_folder(spark, "lease"), Clock()
    return clock, lambda owner: Lease(spark, folder, owner, seconds=60, clock=clock)


def test_one_owner_at_a_time(leases):
    clock, lease = leases
    a, b = lease("a"), lease("b")
    assert a.acquire() and not b.acquire() and b.holder() == "a"
    a.release()
    assert b.acquire() and not a.acquire()
    b.release()
    assert a.holder() is None


def test_a_lease_is_renewed_and_taken_over_when_it_has_run_out(leases):
    clock, lease = leases
    a, b = lease("a"), lease("b")
    assert a.acquire()
    clock.now += 50_000
    a.renew()
    clock.now += 50_000
    assert not b.acquire()
    clock.now += 20_000
    assert b.acquire()
    with pytest.raises(LeaseLost):
        a.renew()
    with pytest.raises(LeaseLost):
        a.renew()
    a.release()  # of no effect
    assert b.holder() == "b"


def test_of_many_that_try_at_once_one_wins(leases):
    clock, lease = leases
    stale = lease("stale")
    assert stale.acquire()
    for _ in range(3):
        clock.now += 61_000
        start, won = threading.Barrier(6), []

        def attempt(name):
            mine = lease(name)
            start.wait()
            if mine.acquire():
                won.append(name)

        threads = [threading.Thread(target=attempt, args=(f"t{i}",)) for i in range(6)]
        [t.start() for t in threads]
        [t.join() for t in threads]
        assert len(won) == 1


def test_a_file_without_content_is_held_until_its_time_is_over(spark, leases):
    clock, lease = leases
    a = lease("a")
    assert a.acquire()
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{a.folder}/{a.number + 1:012d}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, False).close()
    clock.now += 61_000
    assert not lease("b").acquire()
    clock.now = 10**14
    assert lease("b").acquire()


def test_two_runs_of_one_store(spark, database):
    store, ran, refused = Store(spark, database), [], []
    inside, done = threading.Event(), threading.Event()

    def first():
        def work():
            inside.set()
            done.wait(60)
            ran.append("first")

        store.guarded_run(datetime(2024, 1, 1), work)

    thread = threading.Thread(target=first)
    thread.start()
    assert inside.wait(60)
    with pytest.raises(AlreadyRunning):
        store.guarded_run(datetime(2025, 1, 1), lambda: ran.append("second"))
    done.set()
    thread.join()
    store.guarded_run(datetime(2026, 1, 1), lambda: ran.append("third"))
    assert ran == ["first", "third"]
