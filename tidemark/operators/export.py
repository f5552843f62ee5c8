"""Truncate-and-reload of the serving tables into another store."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

Sink = Callable[[DataFrame, str], None]


def jdbc_options(
    url: str, table: str, batchsize: int = 10_000, partitions: int | None = None
) -> dict:
    """Typed columns, the table kept and emptied; ``partitions`` bounds the connections.

    Spark then reads the exported table in no more tasks either, so there is no bound unless the
    caller, who knows the target, sets one.
    """
    bound = {} if partitions is None else {"numPartitions": str(partitions)}
    return {
        "url": url,
        "dbtable": table,
        "truncate": "true",
        "batchsize": str(batchsize),
    } | bound


def jdbc_sink(url: str, properties: dict[str, str], schema: str, **tuning: int) -> Sink:
    """Executors write their partitions in parallel; no rows pass through the driver."""

    def write(df: DataFrame, name: str):
        options = jdbc_options(url, f"{schema}.{name}", **tuning)
        df.write.format("jdbc").mode("overwrite").options(**options, **properties).save()

    return write


def export(spark: SparkSession, tables: dict[str, str], sink: Sink) -> dict[str, int]:
    """Write the tables in the given order and return their row counts.

    ``tables`` maps the exported name to the table to read. The rows are counted while they
    are written. The first failure ends the export; tables before it stay exported.
    """
    counts = {}
    for name, table in tables.items():
        seen = Observation()
        sink(spark.table(table).observe(seen, F.count(F.lit(1)).alias("rows")), name)
        counts[name] = seen.get["rows"]
    return counts
