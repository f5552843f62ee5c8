"""Seeds and catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

REGION_SCHEMA = (
    "city string, country string, latitude float, longitude float, "
    "timezone string, electricity_zone string"
)


def seed_csv(spark: SparkSession, path: str, schema: str = REGION_SCHEMA) -> DataFrame:
    """CSV with a header and declared column types; a row that does not fit raises."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
