"""The two stored reports, brought up to date from the states of the days that loads have touched."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.states import StoredStates, refresh_report
from tidemark.plans import gold

DATE = "observation_date"


def states_of(
    spark: SparkSession, fact: str, table: str, times: DataFrame, exact_scale: int | None = None
) -> StoredStates:
    """The states in ``table`` of a fact that is partitioned by its date."""
    return StoredStates(
        spark, fact, table, DATE, lambda rows: gold.reading_states(rows, times, DATE, exact_scale)
    )


def refresh_reports(
    states: StoredStates,
    locations: DataFrame,
    conditions: DataFrame,
    daily: str,
    monthly: str,
    exact_scale: int | None = None,
):
    """Regroup the touched days of the fact; replace their days and months in both reports.

    Readings outside the time dimension form groups without a date, over all days. Their states
    are read whole; where there are none, the files' statistics leave nothing to read.
    """
    spark = states.spark
    with states.refreshed() as days:
        if days is None:
            by_day = by_month = states.read()
            touched_days = touched_months = None
        else:
            day, outside = F.col(DATE), states.read().where("agg_date is null")
            all_days = F.explode(F.sequence(F.trunc(day, "month"), F.last_day(day))).alias(DATE)
            whole_months = days.where(day.isNotNull()).select(all_days).distinct()
            by_day = states.of(days).where("agg_date is not null").unionByName(outside)
            by_month = states.of(whole_months).where("agg_date is not null").unionByName(outside)
            # With the groups without a date, which any touched day may belong to.
            undated = spark.range(1).select(F.lit(None).cast("date").alias(DATE))
            dates = days.union(undated)
            touched_days = dates.select(day.alias("agg_date")).distinct()
            touched_months = dates.select(F.year(day).alias("year"), F.month(day).alias("month")).distinct()
        refresh_report(
            spark, gold.daily_of_states(by_day, locations, exact_scale), daily, ["agg_date"], touched_days
        )
        report = gold.monthly_of_states(by_month, locations, conditions, exact_scale)
        refresh_report(spark, report, monthly, ["year", "month"], touched_months)
