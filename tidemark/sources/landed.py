"""Landed JSON documents as a table, parsed on the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.keys import _col

CORRUPT = "_corrupt"


def parse_payload(payload: Column | str, schema: str) -> Column:
    """JSON text as a struct; ``_corrupt`` inside it keeps text that does not fit."""
    return F.from_json(
        _col(payload), f"{schema}, {CORRUPT} string", {"columnNameOfCorruptRecord": CORRUPT}
    )


def with_payload(df: DataFrame, schema: str, payload: str = "payload") -> DataFrame:
    """Replace payload text by its parsed struct and add ``payload_error`` (NULL when sound)."""
    parsed = df.withColumn("_parsed", parse_payload(payload, schema))
    error = (
        F.when(F.col(payload).isNull(), "payload: missing")
        .when(F.col("_parsed").isNull(), "payload: not a JSON object")
        .when(F.col(f"_parsed.{CORRUPT}").isNotNull(), "payload: malformed JSON")
    )
    return (
        parsed.withColumn("payload_error", error)
        .withColumn(payload, F.col("_parsed").dropFields(CORRUPT))
        .drop("_parsed")
    )


def read_landed(
    spark: SparkSession, path: str, schema: str, keys: str = "city string, ingested_at timestamp"
) -> DataFrame:
    """Documents landed as JSON lines of ``keys`` plus ``payload`` text."""
    return _documents(spark.read, path, schema, keys)


def landed_stream(
    spark: SparkSession,
    path: str,
    schema: str,
    keys: str = "city string, ingested_at timestamp",
    files_per_batch: int = 1000,
) -> DataFrame:
    """The same documents as a stream of the files that land in a folder."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    return _documents(reader, path, schema, keys)


def _documents(reader, path: str, schema: str, keys: str) -> DataFrame:
    lines = (
        reader.schema(f"{keys}, payload string, {CORRUPT} string")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )
    parsed = with_payload(lines, schema)
    line_error = F.when(F.col(CORRUPT).isNotNull(), "line: malformed JSON")
    return parsed.withColumn("payload_error", F.coalesce(line_error, "payload_error")).drop(CORRUPT)
