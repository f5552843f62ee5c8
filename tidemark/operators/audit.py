"""Audit rows of an ingest and the run log with its guard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.clock import hours_before
from tidemark.sources.fixed import typed_frame

AUDIT_SCHEMA = (
    "source string not null, city string not null, row_count bigint not null, "
    "ingested_at timestamp not null, status string not null, error_message string"
)
RUN_LOG_SCHEMA = (
    "run_id string not null, started_at timestamp not null, ended_at timestamp, "
    "status string not null, error string"
)
RUNNING, SUCCESS, FAILED = "RUNNING", "SUCCESS", "FAILED"


def unit_outcomes(
    roster: DataFrame, good: DataFrame, rejected: DataFrame, ingested_at: Column
) -> DataFrame:
    """One row per (source, city): its good rows, else FAILED with a reason.

    ``good`` has source and city; ``rejected`` has them too plus ``error_message``. Both are
    counted before they are shuffled. Expected units without rows and units outside the
    roster are listed as well.
    """
    keys = ["source", "city"]
    counts = good.groupBy(*keys).agg(F.count(F.lit(1)).alias("_good"))
    errors = rejected.groupBy(*keys).agg(F.min("error_message").alias("_error"))
    found = roster.select(*keys).join(counts, keys, "full").join(errors, keys, "full")
    rows = F.coalesce("_good", F.lit(0))
    failed = rows == 0
    return found.select(
        *keys,
        rows.alias("row_count"),
        ingested_at.alias("ingested_at"),
        F.when(failed, FAILED).otherwise(SUCCESS).alias("status"),
        F.coalesce("_error", F.when(failed, "no rows")).alias("error_message"),
    )


def audit_rows(
    outcomes: DataFrame, total_label: str, total_source: str, failures_only: bool = False
) -> DataFrame:
    """Unit rows (all, or the failures only) followed by one total row."""
    total = outcomes.agg(
        F.lit(total_source).alias("source"),
        F.lit(total_label).alias("city"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"),
        F.max("ingested_at").alias("ingested_at"),
        F.lit(SUCCESS).alias("status"),
        F.lit(None).cast("string").alias("error_message"),
    )
    units = outcomes.where(F.col("status") == FAILED) if failures_only else outcomes
    return units.unionByName(total)


def append_table(df: DataFrame, table: str):
    df.write.mode("append").format("parquet").saveAsTable(table)


def run_row(
    spark: SparkSession, run: str, started_at, status: str, ended_at=None, error: str | None = None
) -> DataFrame:
    return typed_frame(spark, [(run, started_at, ended_at, status, error)], RUN_LOG_SCHEMA)


def latest_status(log: DataFrame) -> DataFrame:
    """The log only grows; the latest row of a run holds its status."""
    moment = F.struct(F.coalesce("ended_at", "started_at"), F.col("status") != RUNNING)
    return log.groupBy("run_id").agg(
        F.min("started_at").alias("started_at"), F.max_by("status", moment).alias("status")
    )


def active_runs(log: DataFrame, now: Column, hours: int = 2) -> DataFrame:
    """Runs that started within the last hours and have not ended."""
    recent = log.where(F.col("started_at") >= hours_before(now, hours))
    return latest_status(recent).where(F.col("status") == RUNNING)


def is_running(spark: SparkSession, table: str, now: Column, hours: int = 2) -> bool:
    """Best effort: Parquet tables offer no lock. A missing log means no run."""
    if not spark.catalog.tableExists(table):
        return False
    return not active_runs(spark.table(table), now, hours).isEmpty()


def cleared(log: DataFrame, run: Column | str, ended_at: Column) -> DataFrame:
    """FAILED rows that end the given stuck run."""
    stuck = latest_status(log).where((F.col("run_id") == run) & (F.col("status") == RUNNING))
    return stuck.select(
        "run_id",
        "started_at",
        ended_at.alias("ended_at"),
        F.lit(FAILED).alias("status"),
        F.lit("Manually cleared").alias("error"),  # fixed value
    )
