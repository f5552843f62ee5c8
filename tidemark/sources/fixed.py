"""Small fixed dimensions and explicit-schema frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

# Cities with a station, their position and zone.
CITIES = [
    # city, country, latitude, longitude, timezone
    ("London", "GB", 51.5074, -0.1278, "Europe/London"),
    ("Berlin", "DE", 52.5200, 13.4050, "Europe/Berlin"),
    ("Paris", "FR", 48.8566, 2.3522, "Europe/Paris"),
    ("Madrid", "ES", 40.4168, -3.7038, "Europe/Madrid"),
    ("Rome", "IT", 41.9028, 12.4964, "Europe/Rome"),
    ("Amsterdam", "NL", 52.3676, 4.9041, "Europe/Amsterdam"),
    ("Warsaw", "PL", 52.2297, 21.0122, "Europe/Warsaw"),
    ("Vienna", "AT", 48.2082, 16.3738, "Europe/Vienna"),
    ("Stockholm", "SE", 59.3293, 18.0686, "Europe/Stockholm"),
    ("Lisbon", "PT", 38.7169, -9.1399, "Europe/Lisbon"),
]
CITY_SCHEMA = "city string, country string, latitude double, longitude double, timezone string"

# Zones with a live electricity source.
ZONES = [
    # city, country, zone, source
    ("London", "GB", "GB", "uk_carbon_intensity"),
    ("Berlin", "DE", "DE", "smard"),
    ("Vienna", "AT", "AT", "smard"),
]
ZONE_SCHEMA = "city string, country string, zone string, source string"

# WMO 4677 codes with label, category and severity.
WEATHER_CODES = [
    (0, "Clear Sky", "sunny", "mild"),
    (1, "Mainly Clear", "sunny", "mild"),
    (2, "Partly Cloudy", "cloudy", "mild"),
    (3, "Overcast", "cloudy", "mild"),
    (45, "Foggy", "foggy", "moderate"),
    (48, "Depositing Rime Fog", "foggy", "moderate"),
    (51, "Light Drizzle", "rainy", "mild"),
    (53, "Moderate Drizzle", "rainy", "moderate"),
    (55, "Dense Drizzle", "rainy", "moderate"),
    (61, "Slight Rain", "rainy", "mild"),
    (63, "Moderate Rain", "rainy", "moderate"),
    (65, "Heavy Rain", "rainy", "severe"),
    (71, "Slight Snowfall", "snowy", "mild"),
    (73, "Moderate Snowfall", "snowy", "moderate"),
    (75, "Heavy Snowfall", "snowy", "severe"),
    (80, "Slight Rain Showers", "rainy", "mild"),
    (81, "Moderate Rain Showers", "rainy", "moderate"),
    (82, "Violent Rain Showers", "rainy", "severe"),
    (95, "Thunderstorm", "stormy", "severe"),
    (96, "Thunderstorm with Hail", "stormy", "severe"),
    (99, "Heavy Thunderstorm", "stormy", "severe"),
]
WEATHER_CODE_SCHEMA = (
    "weathercode int, condition_label string, condition_category string, severity string"
)
CATEGORIES = ["sunny", "cloudy", "rainy", "snowy", "foggy", "stormy"]
SEVERITIES = ["mild", "moderate", "severe"]


def typed_frame(spark: SparkSession, rows, schema: StructType | str) -> DataFrame:
    """A few driver rows under an explicit schema; wrong types and NULLs raise."""
    return spark.createDataFrame(rows, schema)


def constant_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A fixed list as an inline table, whose exact size the planner knows."""
    table = spark.sql("VALUES " + ", ".join(str(row) for row in rows))
    fields = StructType.fromDDL(schema).fields
    return table.toDF(*[field.name for field in fields]).select(
        *[F.col(field.name).cast(field.dataType) for field in fields]
    )


def cities(spark: SparkSession) -> DataFrame:
    return constant_table(spark, CITIES, CITY_SCHEMA)


def zones(spark: SparkSession) -> DataFrame:
    return constant_table(spark, ZONES, ZONE_SCHEMA)


def weather_conditions(spark: SparkSession) -> DataFrame:
    return constant_table(spark, WEATHER_CODES, WEATHER_CODE_SCHEMA)
