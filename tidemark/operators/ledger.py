"""Which files of a table each load has read.

A mark on a column misses rows that are written later with an equal or a lower value. Here a load
reads the files that it has not read yet, whatever their rows say; files are known by the path and the
time that Spark shows in the hidden column ``_metadata``. Files that replace others count as new.

The files are found by a scan of that column alone, which reads no values, and compared with the
ledger by a join. The least time among the unread ones goes into the scan as a literal, so that older files are
left out when the scan is planned; the rest are told apart by a join with the list of paths, as hashes.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.upsert import swap_in
from tidemark.session import staged


def _file() -> list:
    return [
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_modification_time").alias("modified"),
    ]


@dataclass(frozen=True)
class FileLedger:
    """The table ``table`` lists the files that every consumer has read."""

    spark: SparkSession
    table: str

    def _known(self, consumer: str) -> DataFrame | None:
        if not self.spark.catalog.tableExists(self.table):
            return None
        return self.spark.table(self.table).where(F.col("consumer") == consumer)

    def unread_files(self, source: DataFrame, consumer: str) -> DataFrame:
        """file_path and modified of the files of ``source`` that the consumer has not read."""
        files = source.select(*_file()).distinct()
        known = self._known(consumer)
        if known is None:
            return files
        return files.join(known.select("file_path", "modified"), ["file_path", "modified"], "left_anti")

    @contextmanager
    def unread(self, source: DataFrame, consumer: str):
        """Rows of the files that the consumer has not read, which count as read when the block
        ends well. ``source`` must be a scan of files, with or without filters."""
        with staged(self.unread_files(source, consumer)) as files:
            yield rows_of(source, files)
            noted = files.select(F.lit(consumer).alias("consumer"), "file_path", "modified")
            noted.write.format("parquet").mode("append").saveAsTable(self.table)

    def forget(self, *consumers: str):
        """Let consumers read everything again."""
        if self.spark.catalog.tableExists(self.table):
            kept = self.spark.table(self.table).where(~F.col("consumer").isin(*consumers))
            swap_in(kept, self.table, [])


def rows_of(source: DataFrame, files: DataFrame) -> DataFrame:
    """The rows of ``source`` that lie in the files."""
    since = files.agg(F.min("modified")).first()[0]
    if since is None:
        return source.limit(0)
    named = source.where(F.col("_metadata.file_modification_time") >= F.lit(since))
    wanted = files.select(F.xxhash64("file_path").alias("_file"))
    hashed = named.withColumn("_file", F.xxhash64(F.col("_metadata.file_path")))
    return hashed.join(wanted, "_file", "left_semi").drop("_file")
