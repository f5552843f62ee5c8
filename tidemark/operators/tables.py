"""Table maintenance on partitioned Parquet tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tidemark.operators.upsert import (
    NO_VALUE,
    overwrite_touched,
    partition_spec,
    partition_values,
    swap_in,
    write_new,
)


def ensure_schema(spark: SparkSession, name: str):
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def list_tables(spark: SparkSession, schema: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(schema) if not t.isTemporary)


def full_refresh(df: DataFrame, table: str, partition_cols: list[str] | None = None):
    """Rebuild a table from a query; the old one stays until the new one is complete."""
    swap_in(df, table, partition_cols or [])


def replaced(
    existing: DataFrame,
    batch: DataFrame,
    date_col: str,
    day: date,
    partition_cols: list[str] | None = None,
) -> DataFrame:
    """What a table holds after a day is replaced: the whole day, or only the batch's partitions.

    A batch with a row of another day fails when it is run.
    """
    batch = only_day(batch, date_col, day)
    if partition_cols is None:
        kept = existing.where(~F.col(date_col).eqNullSafe(F.lit(day).cast("date")))
    else:
        old, new = existing.alias("_old"), batch.select(*partition_cols).distinct().alias("_new")
        same = [F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")) for c in partition_cols]
        kept = old.join(new, same, "left_anti")
    return kept.unionByName(batch)


def only_day(df: DataFrame, date_col: str, day: date) -> DataFrame:
    """The rows themselves; running them raises if one is not of that day."""
    same = F.col(date_col).eqNullSafe(F.lit(day).cast("date"))
    return df.where(F.assert_true(same, f"{date_col}: a row is not of {day}").isNull())


def replace_partitions(
    df: DataFrame, table: str, day: date, date_col: str, split_col: str, scope: str = "date"
):
    """Overwrite one day of a table partitioned by (``date_col``, ``split_col``).

    A row of another day fails the job. The written partitions are swapped in when the job
    commits, so a failed job leaves the table as it was. Scope ``date`` then drops the day's
    partitions that the new rows lack; scope ``partition`` keeps them.
    """
    spark = df.sparkSession
    df = only_day(df, date_col, day)
    parts = [date_col, split_col]
    if not spark.catalog.tableExists(table):
        write_new(df, table, parts)
        return
    seen = Observation()
    value = F.coalesce(F.nullif(F.col(split_col).cast("string"), F.lit("")), F.lit(NO_VALUE))
    observed = df.observe(seen, F.collect_set(value).alias("written"))
    overwrite_touched(spark, observed, table, parts)
    if scope == "date":
        written = set(seen.get["written"])
        listed = list_partitions(spark, table, date_col, day)
        drop_partitions(spark, table, [p for p in listed if p[split_col] not in written])


def list_partitions(
    spark: SparkSession, table: str, date_col: str, day: date
) -> list[dict[str, str]]:
    """The partitions that the catalog lists for a day, as column -> value."""
    listed = spark.sql(f"SHOW PARTITIONS {table} PARTITION ({date_col} = '{day}')").collect()
    return [partition_values(row["partition"]) for row in listed]


def drop_partitions(spark: SparkSession, table: str, partitions: list[dict[str, str]]):
    if partitions:
        specs = ", ".join(partition_spec(values) for values in partitions)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")


def delete_date(spark: SparkSession, table: str, date_col: str, day: date):
    """Remove one day; a catalog operation, no rows are read."""
    drop_partitions(spark, table, list_partitions(spark, table, date_col, day))


def without_date(df: DataFrame, date_col: str, day: Column) -> DataFrame:
    """The rows that stay when a day is deleted."""
    return df.where(~F.col(date_col).eqNullSafe(day))
