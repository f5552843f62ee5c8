"""Stored form of the data set: ingest a day, build the layers, test and export them."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.clock import RUN_ID
from tidemark.operators import audit
from tidemark.operators.contracts import (
    REJECT,
    empty_tables,
    good_rows,
    missing_parents,
    rejected_rows,
)
from tidemark.operators.dedup import high_water_mark, since_last
from tidemark.operators.export import Sink, export
from tidemark.operators.history import StoredHistory
from tidemark.operators.lease import Lease
from tidemark.operators.ledger import FileLedger
from tidemark.operators.states import StoredStates
from tidemark.operators.tables import ensure_schema, full_refresh, replace_partitions
from tidemark.operators.upsert import touched_rows, upsert_newest, upsert_table
from tidemark.plans import bronze, gold, reports, silver
from tidemark.plans.checks import CONTRACTS, check_tables
from tidemark.session import staged
from tidemark.sources import fixed
from tidemark.sources.fixed import typed_frame

# The tables served to other stores, in this order.
SERVED = [
    "dim_weather_condition",
    "dim_time",
    "dim_location",
    "fact_energy_readings",
    "agg_daily_energy",
    "rpt_weather_energy_correlation",
]


RAW = ["bronze_weather", "bronze_energy"]
# Keys of the fact, and the dimension and column that must have them. A reading outside the time
# dimension has no time key, so it is counted here too.
PARENTS = [
    ("location_key", "dim_location", "location_key"),
    ("time_key", "dim_time", "time_key"),
    ("weathercode_key", "dim_weather_condition", "weathercode"),
]
FAILURE_SCHEMA = "table_name string, test string, column_name string, failures bigint"


class NothingIngested(RuntimeError):
    """No unit delivered a good row; the stored day is left as it is."""


class AlreadyRunning(RuntimeError):
    """Another run is recorded as running."""


@dataclass(frozen=True)
class Store:
    """The tables of one database."""

    spark: SparkSession
    database: str

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def has(self, table: str) -> bool:
        """A look only; a swap that was cut off is resumed by the next writer."""
        return self.spark.catalog.tableExists(self.name(table))

    # --- raw layer -------------------------------------------------------------------

    def ingest(
        self,
        checked: DataFrame,
        table: str,
        roster: DataFrame,
        day: date,
        ingested_at: datetime,
        total_label: str,
        total_source: str,
        failures_only: bool,
        scope: str = "date",
    ):
        """Store one day's good rows and log every expected unit's outcome.

        The payloads are parsed once; the good rows, the rejects and the counts are read from
        the staged result.
        """
        stamp = F.lit(ingested_at).cast("timestamp")
        other_day = F.col("ingested_date") != F.lit(day)
        reason = F.when(other_day, F.array(F.lit("ingested_date: not the run's day")))
        none = F.array().cast("array<string>")
        reasons = F.concat(F.col(REJECT), F.coalesce(reason, none))
        with staged(checked.withColumn(REJECT, reasons)) as rows:
            good = good_rows(rows)
            rejected = (
                rejected_rows(rows)
                .drop("source")
                .join(roster, "city", "left")
                .select(
                    F.coalesce("source", F.lit(total_source)).alias("source"),
                    F.coalesce("city", F.lit("unknown")).alias("city"),
                    F.array_join("reject_reason", "; ").alias("error_message"),
                )
            )
            outcomes = audit.unit_outcomes(roster, good, rejected, stamp)
            if good.isEmpty():
                failed = outcomes.where(F.col("status") == audit.FAILED)
                audit.append_table(failed, self.name("bronze_audit"))
                raise NothingIngested(f"{table}: no good rows for {day}")
            replace_partitions(good, self.name(table), day, "ingested_date", "country", scope)
            logged = audit.audit_rows(outcomes, total_label, total_source, failures_only)
            audit.append_table(logged, self.name("bronze_audit"))

    def ingest_weather(
        self,
        landed: DataFrame,
        day: date,
        ingested_at: datetime,
        hours_are_utc: bool = False,
        scope: str = "date",
    ):
        """Failed cities and one total are logged."""
        cities = fixed.cities(self.spark)
        self.ingest(
            bronze.weather_rows(landed, cities, hours_are_utc),
            "bronze_weather",
            cities.select(F.lit(bronze.WEATHER_SOURCE).alias("source"), "city"),
            day,
            ingested_at,
            "ALL_CITIES",  # fixed value
            bronze.WEATHER_SOURCE,
            failures_only=True,
            scope=scope,
        )

    def ingest_energy(
        self,
        readings: list[DataFrame],
        day: date,
        ingested_at: datetime,
        scope: str = "date",
    ):
        """Every zone's city and one total are logged."""
        zones = fixed.zones(self.spark)
        self.ingest(
            bronze.energy_rows(readings, zones),
            "bronze_energy",
            zones.select("source", "city"),
            day,
            ingested_at,
            "ALL_ZONES",  # fixed value
            "all",
            failures_only=False,
            scope=scope,
        )

    @contextmanager
    def writing(self, owner: str | None = None):
        """Hold the database's lease: one writer at a time, in this session or any other.

        A writer that is lost keeps others out until its lease has run out.
        """
        ensure_schema(self.spark, self.database)
        root = self.spark.catalog.getDatabase(self.database).locationUri
        lease = Lease(self.spark, f"{root}/_lease", owner or uuid.uuid4().hex)
        if not lease.acquire():
            raise AlreadyRunning(f"{lease.holder()} is writing to {self.database}")
        with lease.kept():
            yield

    def guarded_run(self, started_at: datetime, ingest: Callable[[], None], hours: int = 2):
        """Run an ingest unless one is active, and log how it ended."""
        with self.writing():
            return self._logged_run(started_at, ingest, hours)

    def _logged_run(self, started_at: datetime, ingest: Callable[[], None], hours: int):
        log = self.name("pipeline_run_log")
        if audit.is_running(self.spark, log, F.lit(started_at).cast("timestamp"), hours):
            raise AlreadyRunning(f"a run is active within the last {hours} hours")
        run = _run_id(self.spark, started_at)

        def record(status: str, ended_at: datetime | None = None, error: str | None = None):
            row = audit.run_row(self.spark, run, started_at, status, ended_at, error)
            audit.append_table(row, log)

        record(audit.RUNNING)
        try:
            ingest()
        except Exception as problem:
            record(audit.FAILED, _now(self.spark), str(problem))
            raise
        record(audit.SUCCESS, _now(self.spark))
        return run

    def clear_run(self, run: str, ended_at: datetime):
        log = self.table("pipeline_run_log")
        rows = audit.cleared(log, F.lit(run), F.lit(ended_at).cast("timestamp"))
        with staged(rows) as ended:
            audit.append_table(ended, self.name("pipeline_run_log"))

    # --- load log --------------------------------------------------------------------

    def _record_load(self, table: str, hour_col: str, ingested_col: str):
        """Note which days a load touched and its marks, so that later loads need not search
        the whole table for them. One row per load and day."""

        def record(batch: DataFrame):
            rows = batch.groupBy(F.to_date(hour_col).alias("touched_date")).agg(
                F.max(ingested_col).alias("ingested_mark"),
                F.max("_loaded_at").alias("loaded_mark"),
            )
            logged = rows.select(F.lit(table).alias("table_name"), "*")
            audit.append_table(logged, self.name("load_log"))

        return record

    def _mark(self, table: str, log_column: str, column: str) -> DataFrame:
        """High-water mark of a table: from the load log, else from the table itself."""
        if self.has("load_log"):
            logged = self.table("load_log").where(F.col("table_name") == table)
            if not logged.isEmpty():
                return high_water_mark(logged, log_column)
        return high_water_mark(self.table(table), column)

    def _touched_since(self, mark: DataFrame) -> DataFrame | None:
        """Days whose cleaned rows were loaded above a mark; None where no log exists."""
        if not self.has("load_log"):
            return None
        silver_tables = ["stg_weather_hourly", "stg_energy_intensity"]
        return since_last(self.table("load_log"), "loaded_mark", mark).where(
            F.col("table_name").isin(silver_tables)
        ).select("touched_date")

    # --- cleaned layer ---------------------------------------------------------------

    @property
    def ledger(self) -> FileLedger:
        """Which raw files the cleaned tables have been loaded from."""
        return FileLedger(self.spark, self.name("file_ledger"))

    def _unread(self, source: str, target: str):
        """Raw rows of files that a cleaned table was not loaded from."""
        if not self.has(target):
            self.ledger.forget(target)
        return self.ledger.unread(self.table(source), target)

    def forget(self, *tables: str):
        """Drop built tables and what the load log says of them, so that the next build starts
        from the layer below. Without names: the cleaned tables and the fact."""
        names = tables or ("stg_weather_hourly", "stg_energy_intensity", "fact_energy_readings")
        if "fact_energy_readings" in names:
            self.states.forget()
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(name)}")
        self.ledger.forget(*names)
        if self.has("load_log"):
            kept = self.table("load_log").where(~F.col("table_name").isin(*names))
            full_refresh(kept, self.name("load_log"))

    def build_silver(self, loaded_at=None):
        """Load the raw files that came since the last load.

        Rows may come late, with stamps that were loaded before or lower ones: the reading that
        was ingested last stays, whatever the order of loads.
        """
        with self._unread("bronze_weather", "stg_weather_hourly") as raw:
            weather = silver.stg_weather_hourly(raw, loaded_at)
            measured = [c for c in weather.columns if c not in ("weather_id", "_ingested_at", "_loaded_at")]
            upsert_newest(
                weather.withColumn("observation_date", F.to_date("observation_hour")),
                self.name("stg_weather_hourly"),
                ["weather_id"],
                "_ingested_at",
                measured,
                ["observation_date"],  # the id holds the hour
                after=self._record_load("stg_weather_hourly", "observation_hour", "_ingested_at"),
            )
        with self._unread("bronze_energy", "stg_energy_intensity") as raw:
            energy = silver.stg_energy_intensity(raw, loaded_at)
            upsert_table(
                self.spark,
                self.name("stg_energy_intensity"),
                energy.withColumn("ingested_date", F.to_date("_ingested_at")),
                ["energy_id"],
                ["ingested_date"],
                keys_may_move=False,  # the id holds the time of ingest
                after=self._record_load("stg_energy_intensity", "measurement_hour", "_ingested_at"),
            )

    # --- history and star ------------------------------------------------------------

    def snapshot_locations(
        self,
        regions: DataFrame,
        as_of: datetime,
        check_cols: list[str] = gold.LOCATION_CHECKS,
    ):
        """Bring the location history up to date."""
        self.location_history(check_cols).snapshot(regions, as_of)

    def location_history(self, check_cols: list[str] = gold.LOCATION_CHECKS) -> StoredHistory:
        return StoredHistory(self.spark, self.name("snap_dim_location"), "city", check_cols)

    def build_gold(
        self,
        loaded_at=None,
        start: datetime = gold.SPINE_START,
        end: datetime = gold.SPINE_END,
    ):
        """Rebuild dimensions; bring the fact and the reports up to date."""
        places = gold.dim_location(self.location_history().current())
        times = gold.dim_time(self.spark, start, end)
        if self.has("fact_energy_readings"):
            named = ["location_key", "city", "country"]
            if self._differs("dim_time", times, times.columns):
                self.states.mark_states()
            elif self._differs("dim_location", places, named):
                self.states.mark_reports()
        full_refresh(places, self.name("dim_location"))
        full_refresh(times, self.name("dim_time"))
        full_refresh(
            gold.dim_weather_condition(self.spark), self.name("dim_weather_condition")
        )
        weather = self.table("stg_weather_hourly")
        energy, locations = self.table("stg_energy_intensity"), self.table("dim_location")
        if self.has("fact_energy_readings"):
            mark = self._mark("fact_energy_readings", "loaded_mark", "_loaded_at")
            touched = self._touched_since(mark)
            if touched is not None:
                days = touched.withColumnRenamed("touched_date", "observation_date")
                weather = touched_rows(weather, days, ["observation_date"])
                energy = _within(energy, "measurement_hour", touched)
            weather = gold.pending_weather(weather, energy, locations, mark)
        rows = gold.fact_energy_readings(
            weather, energy, locations, self.table("dim_time"), loaded_at, "observation_date"
        )
        upsert_table(
            self.spark,
            self.name("fact_energy_readings"),
            rows,
            ["fact_id"],
            ["observation_date"],
            keys_may_move=False,  # the id holds the hour
            after=self._record_load(
                "fact_energy_readings", "observation_date", "weather_ingested_at"
            ),
            before=self.states.mark,
        )
        self.build_reports()

    @property
    def states(self) -> StoredStates:
        """Partial states of the fact, from which the reports are merged."""
        fact, table = self.name("fact_energy_readings"), self.name("reading_states")
        times = self.table("dim_time") if self.has("dim_time") else gold.dim_time(self.spark)
        return reports.states_of(self.spark, fact, table, times)

    def _differs(self, table: str, rows: DataFrame, columns: list[str]) -> bool:
        """Whether a stored dimension has rows that are not among the new ones, or is not stored.
        New rows alone change no report: no reading has their keys yet."""
        if not self.has(table):
            return True
        return not self.table(table).select(columns).exceptAll(rows.select(columns)).isEmpty()

    def build_reports(self):
        """Bring both reports up to date with the days that the fact's loads have touched."""
        reports.refresh_reports(
            self.states,
            self.table("dim_location"),
            self.table("dim_weather_condition"),
            self.name("agg_daily_energy"),
            self.name("rpt_weather_energy_correlation"),
        )

    # --- tests and export ------------------------------------------------------------

    def failures(self) -> DataFrame:
        """Tests that fail, over the tables that exist: declared ones, raw tables without rows,
        keys of the fact without a parent, and fact rows outside the time dimension."""
        tables = {name: self.table(name) for name in CONTRACTS if self.has(name)}
        results = typed_frame(self.spark, [], FAILURE_SCHEMA)
        if tables:
            results = results.unionByName(check_tables(tables))
        raw = {name: tables[name] for name in RAW if name in tables}
        if raw:
            empty = empty_tables(raw).select(
                F.split_part("failure_reason", F.lit(" "), F.lit(1)).alias("table_name"),
                F.lit("not_empty").alias("test"),
                F.lit(None).cast("string").alias("column_name"),
                F.lit(1).cast("bigint").alias("failures"),
            )
            results = results.unionByName(empty)
        fact = "fact_energy_readings"
        for key, dim, dim_key in PARENTS if fact in tables else []:
            if dim in tables:
                orphans = missing_parents(tables[fact], key, tables[dim], dim_key)
                results = results.unionByName(
                    orphans.agg(F.coalesce(F.sum("cnt"), F.lit(0)).alias("failures")).select(
                        F.lit(fact).alias("table_name"),
                        F.lit("parent").alias("test"),
                        F.lit(key).alias("column_name"),
                        "failures",
                    )
                )
        return results.where("failures > 0")

    def export(self, sink: Sink) -> dict[str, int]:
        return export(self.spark, {name: self.name(name) for name in SERVED}, sink)


def _within(df: DataFrame, hour_col: str, days: DataFrame) -> DataFrame:
    """Rows between the first and the last of the days; literal bounds skip row groups."""
    low, high = days.agg(F.min("touched_date"), F.max("touched_date")).first()
    if low is None:
        return df.limit(0)
    return df.where(F.col(hour_col).between(F.lit(low).cast("timestamp"), F.date_add(F.lit(high), 1).cast("timestamp")))


def _now(spark: SparkSession) -> datetime:
    return spark.range(1).select(F.current_timestamp().alias("now")).first()["now"]


def _run_id(spark: SparkSession, started_at: datetime) -> str:
    moment: Column = F.lit(started_at).cast("timestamp")
    return spark.range(1).select(F.date_format(moment, RUN_ID).alias("id")).first()["id"]
