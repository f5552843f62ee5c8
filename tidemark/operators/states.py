"""Partial states of a partitioned fact, stored per partition, and what is built from them.

A roll-up that is kept in a table goes stale partition by partition. The partitions that a load will
change are marked before it writes; a build regroups those partitions only, replaces their states and
the groups of the reports that they feed, and takes the marks away last. A build that is cut off at any
point leaves its marks, and the next one does the same work again. Loads need not come in the order of
their stamps, and extremes and moved rows are right, since states are recomputed from their partition rather
than adjusted.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.upsert import drop_versions, replace_touched, swap_in, touched_rows
from tidemark.session import staged


@dataclass(frozen=True)
class StoredStates:
    """States of the table ``fact`` in ``table``, both partitioned by ``partition_col``.

    ``grouped`` makes the states of the rows it is given; it must group by ``partition_col`` among others.
    """

    spark: SparkSession
    fact: str
    table: str
    partition_col: str
    grouped: Callable[[DataFrame], DataFrame]

    @property
    def marks(self) -> str:
        return f"{self.table}_stale"

    def mark(self, touched: DataFrame):
        """Note partition values that are about to change; called before the fact is written."""
        value = F.col(self.partition_col)
        self._note(touched.select(value, F.lit(False).alias("every_report"), F.lit(False).alias("every_state")))

    def mark_reports(self):
        """Note that all reports are stale, for instance because a dimension will change."""
        self._note_all(True, False)

    def mark_states(self):
        """Note that all states are stale, for instance because the calendar will change."""
        self._note_all(True, True)

    def _note_all(self, reports: bool, states: bool):
        kind = self.spark.table(self.fact).schema[self.partition_col].dataType
        value = F.lit(None).cast(kind).alias(self.partition_col)
        flags = [F.lit(reports).alias("every_report"), F.lit(states).alias("every_state")]
        self._note(self.spark.range(1).select(value, *flags))

    def _note(self, rows: DataFrame):
        rows.write.format("parquet").mode("append").saveAsTable(self.marks)

    def forget(self):
        """Drop the states and their marks, so that the next build starts from the fact."""
        for name in (self.table, self.marks):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            drop_versions(self.spark, name)

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def of(self, touched: DataFrame | None) -> DataFrame:
        """The states of some partitions, or of all."""
        if touched is None:
            return self.read()
        return touched_rows(self.read(), touched, [self.partition_col])

    @contextmanager
    def refreshed(self):
        """Bring the states up to date. Yields the partitions whose reports are stale, None for all;
        their marks go when the block ends well."""
        marks = self.spark.table(self.marks) if self.spark.catalog.tableExists(self.marks) else None
        fresh = not self.spark.catalog.tableExists(self.table)
        flags = None if marks is None else marks.agg(F.max("every_report"), F.max("every_state")).first()
        if fresh or flags and flags[1]:
            swap_in(self.grouped(self.spark.table(self.fact)), self.table, [self.partition_col])
            yield None
        else:
            none = self.read().select(self.partition_col).limit(0)
            values = none if marks is None else marks.where(~F.col("every_report"))
            with staged(values.select(self.partition_col).distinct()) as touched:
                if not touched.isEmpty():
                    self._regroup(touched)
                yield None if flags and flags[0] else touched
        if marks is not None:
            swap_in(marks.limit(0), self.marks, [])

    def _regroup(self, touched: DataFrame):
        rows = touched_rows(self.spark.table(self.fact), touched, [self.partition_col])
        with staged(self.grouped(rows)) as states:
            replace_touched(self.spark, states, self.table, [self.partition_col], touched)


def refresh_report(
    spark: SparkSession,
    rows: DataFrame,
    table: str,
    partition_cols: list[str],
    touched: DataFrame | None = None,
):
    """Replace the touched partitions of a report by ``rows``, or the whole report."""
    if touched is None or not spark.catalog.tableExists(table) or partitions_of(spark, table) != partition_cols:
        swap_in(rows, table, partition_cols)
        return
    with staged(rows) as ready:
        replace_touched(spark, ready, table, partition_cols, touched)


def partitions_of(spark: SparkSession, table: str) -> list[str]:
    return [column.name for column in spark.catalog.listColumns(table) if column.isPartition]
