"""Streams whose state expires by event time, with rows that come too late put aside.

A stream is admitted first: every micro-batch is split at its watermark, the highest time of the batches
before it less the delay, into rows that are on time and rows that are late. Both are written by batch
number, so a batch that runs twice replaces its own files, and every row of the input lies in one of the two.
The stateful steps read the rows on time, when the admission has come to an end; their own watermark is never ahead
of the one that admitted the rows, so Spark drops none of them. Their results go to file sinks, which
count a batch once.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.contracts import REJECT, good_rows, rejected_rows
from tidemark.session import staged
from tidemark.streaming.incremental import started

BATCH = "batch_id"


def write_batch(rows: DataFrame, path: str, number: int):
    """A batch's rows, in a folder of their own that a second run of the batch replaces."""
    rows.write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")


def read_batches(spark: SparkSession, path: str, schema) -> DataFrame:
    """What ``write_batch`` has written, empty before the first batch."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root):
        return spark.createDataFrame([], schema)
    names = [f.name for f in schema.fields]
    return spark.read.schema(schema).option("basePath", path).parquet(path).select(*names)


def _interval(span: timedelta) -> str:
    return f"{int(span.total_seconds() * 1000)} milliseconds"


# --- admission -----------------------------------------------------------------------------


def admit_stream(
    stream: DataFrame, path: str, checkpoint: str, time: str, delay: timedelta
) -> StreamingQuery:
    """Split a stream into ``{path}/on_time`` and ``{path}/late``.

    A row is late if its time is not above the watermark; rows without a time are late as well. One number
    a batch, its highest time, is kept to find the watermark of the batches after it.
    """

    def load(batch: DataFrame, number: int):
        spark = batch.sparkSession
        highs = read_batches(spark, f"{path}/high", _high_schema(spark))
        mark = highs.where(F.col("number") < number).agg(F.max("high")).first()[0]
        on_time = F.col(time).isNotNull()
        if mark is not None:
            on_time &= F.col(time) > F.lit(mark - delay)
        with staged(batch) as rows:
            write_batch(rows.where(on_time), f"{path}/on_time", number)
            write_batch(rows.where(~on_time), f"{path}/late", number)
            high = rows.agg(F.max(time).alias("high")).select(F.lit(number).cast("long").alias("number"), "high")
            write_batch(high, f"{path}/high", number)

    return started(stream, load, checkpoint)


def _high_schema(spark: SparkSession):
    return spark.range(0).select(F.col("id").alias("number"), F.lit(None).cast("timestamp").alias("high")).schema


def on_time_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    """The admitted rows as a stream; all that is there makes one batch."""
    return spark.readStream.schema(schema).parquet(f"{path}/on_time/{BATCH}=*")


def late_rows(spark: SparkSession, path: str, schema) -> DataFrame:
    return read_batches(spark, f"{path}/late", schema)


def on_time_rows(spark: SparkSession, path: str, schema) -> DataFrame:
    return read_batches(spark, f"{path}/on_time", schema)


# --- stateful steps ------------------------------------------------------------------------


def _to_files(result: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        result.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def distinct_within(
    stream: DataFrame, path: str, checkpoint: str, keys: list[str], time: str, delay: timedelta
) -> StreamingQuery:
    """The first row of every key. The state store forgets a key once the watermark is past it, so
    rows of equal key must lie within the delay of each other."""
    watched = stream.withWatermark(time, _interval(delay))
    return _to_files(watched.dropDuplicatesWithinWatermark(keys), path, checkpoint)


def closed_windows(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    time: str,
    delay: timedelta,
    width: str,
    keys: list[str],
    states: list[Column],
) -> StreamingQuery:
    """Mergeable states per window and keys, each written once, when the watermark is past the window."""
    watched = stream.withWatermark(time, _interval(delay))
    return _to_files(_windows(watched, time, width, keys, states), path, checkpoint)


def _windows(rows: DataFrame, time: str, width: str, keys: list[str], states: list[Column]) -> DataFrame:
    grouped = rows.groupBy(F.window(time, width).alias("_window"), *keys).agg(*states)
    others = [c for c in grouped.columns if c != "_window"]
    return grouped.select(F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), *others)


def all_windows(
    closed: DataFrame,
    on_time: DataFrame,
    late: DataFrame,
    time: str,
    width: str,
    keys: list[str],
    states: list[Column],
    merged: list[Column],
) -> DataFrame:
    """The closed windows, those that are still open, and what came too late, merged.

    Rows on time from the end of the last closed window on lie in windows that are open; the literal
    bound keeps the scan off what is closed. Late rows without a time belong to no window.
    """
    last = closed.agg(F.max("window_end")).first()[0]
    still = on_time if last is None else on_time.where(F.col(time) >= F.lit(last))
    parts = [closed, _windows(still, time, width, keys, states), _windows(late, time, width, keys, states)]
    names = ["window_start", "window_end", *keys]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.groupBy(*names).agg(*merged)


# --- ingest with quarantine ----------------------------------------------------------------


def ingest_stream(
    stream: DataFrame, check: Callable[[DataFrame], DataFrame], path: str, checkpoint: str
) -> StreamingQuery:
    """Check every micro-batch of landed rows; good ones go to ``{path}/good``, the others with their
    reasons to ``{path}/rejected``. A batch is parsed once, and its second run replaces the first."""

    def load(batch: DataFrame, number: int):
        with staged(check(batch)) as rows:
            write_batch(good_rows(rows), f"{path}/good", number)
            write_batch(rejected_rows(rows), f"{path}/rejected", number)

    return started(stream, load, checkpoint)


def ingested(spark: SparkSession, path: str, schema) -> tuple[DataFrame, DataFrame]:
    """Good and rejected rows; ``schema`` is that of checked rows."""
    good = type(schema)([f for f in schema.fields if f.name != REJECT])
    return read_batches(spark, f"{path}/good", good), read_batches(spark, f"{path}/rejected", schema)
