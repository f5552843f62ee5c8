"""Incremental loads as streams; the stream's checkpoint takes the place of a high-water mark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.upsert import overwrite_touched, touched_rows, upsert_newest, write_new
from tidemark.session import staged


def read_parquet_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Parquet files of one table as a stream. The last character is a pattern: a plain file
    is no valid stream folder."""
    schema = spark.read.parquet(path).schema
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(f"{path[:-1]}[{path[-1]}]")
    )


def upsert_stream(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    keys: list[str],
    latest: str,
    tie_break: list[str],
    partition_cols: list[str],
) -> StreamingQuery:
    """Upsert every micro-batch's latest row per key. A batch run twice changes nothing.

    A row that comes before the stored one of its key, by ``latest`` and then the tie-break, is
    left out, so neither the order of arrival nor the size of the batches matters.
    """

    home = stream.sparkSession

    def load(batch: DataFrame, _: int):
        upsert_newest(batch, table, keys, latest, tie_break, partition_cols)
        # Batches run in a session of their own; the caller's still lists the replaced files.
        home.catalog.refreshTable(table)

    return started(stream, load, checkpoint)


def started(
    stream: DataFrame, load: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Run ``load`` on everything that is available now."""
    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def distinct_stream(
    stream: DataFrame, table: str, checkpoint: str, keys: list[str], partition_cols: list[str]
) -> StreamingQuery:
    """Add every key that the table does not have yet, whenever it comes.

    Keys are reduced within each task before they are shuffled. ``partition_cols`` are among the
    keys, so a key can only be stored in the partitions that the batch touches.
    """
    home = stream.sparkSession

    def load(batch: DataFrame, _: int):
        spark = batch.sparkSession
        with staged(batch.select(*keys).distinct()) as found:
            if not spark.catalog.tableExists(table):
                write_new(found, table, partition_cols)
            else:
                stored = touched_rows(spark.table(table), found, partition_cols)
                same = [F.col(f"_new.{k}").eqNullSafe(F.col(f"_old.{k}")) for k in keys]
                new = found.alias("_new").join(stored.alias("_old"), same, "left_anti")
                columns = spark.table(table).columns
                new.select(*columns).hint("rebalance", *partition_cols).write.insertInto(table)
        home.catalog.refreshTable(table)

    return started(stream, load, checkpoint)


def rollup_stream(
    stream: DataFrame,
    rows_table: str,
    table: str,
    checkpoint: str,
    keys: list[str],
    latest: str,
    tie_break: list[str],
    partition_cols: list[str],
    rollup: Callable[[DataFrame], DataFrame],
) -> StreamingQuery:
    """Keep a roll-up of stored rows up to date.

    Each batch is upserted into ``rows_table``; then the partitions it touched are rolled up again
    from what is stored, so late rows count and no group waits for a later one. ``rollup`` keeps
    the partition columns among its groups.
    """
    home = stream.sparkSession

    def load(batch: DataFrame, _: int):
        spark = batch.sparkSession
        with staged(batch.select(*partition_cols).distinct()) as touched:
            upsert_newest(batch, rows_table, keys, latest, tie_break, partition_cols)
            rows = rollup(touched_rows(spark.table(rows_table), touched, partition_cols))
            if spark.catalog.tableExists(table):
                overwrite_touched(spark, rows, table, partition_cols)
            else:
                write_new(rows, table, partition_cols)
        home.catalog.refreshTable(rows_table)
        home.catalog.refreshTable(table)

    return started(stream, load, checkpoint)
