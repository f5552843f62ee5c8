"""A slowly changing dimension of type 2 in a table that snapshots only add to.

Opened and closed versions lie in partitions of their own. A snapshot appends, in one job, the closed form of
every changed version and the versions that it opens: keys without a change are compared but not
written, and files of earlier snapshots are never touched. A version is open if it was opened and not
closed since.

Opened versions carry a generation. ``compact`` writes the open ones once more, as the next generation,
and drops the partition of the one before; readers look at the highest generation, so they see the same
versions before and after. A snapshot compacts by itself when as many versions have been closed as are open,
so that looking for the open ones stays in proportion to their number.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.scd import VERSION, changed_versions, first_versions
from tidemark.operators.tables import drop_partitions
from tidemark.session import staged

OPENED, CLOSED = "opened", "closed"
PARTS = ["state", "generation"]


@dataclass(frozen=True)
class StoredHistory:
    """The view ``name`` over all versions, which lie in the table ``{name}_versions``."""

    spark: SparkSession
    name: str
    key: str
    check_cols: list[str]

    @property
    def table(self) -> str:
        return f"{self.name}_versions"

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.table)

    def rows(self, state: str) -> DataFrame:
        return self.spark.table(self.table).where(F.col("state") == state)

    def generation(self) -> int:
        """The generation of the open versions. Reads partition names and, at most, file footers."""
        return self.rows(OPENED).agg(F.max("generation")).first()[0] or 0

    def open_versions(self, generation: int | None = None) -> DataFrame:
        """Versions that were opened and not closed since."""
        now = F.col("generation") == (self.generation() if generation is None else generation)
        closed = self.rows(CLOSED).where(now).select("scd_id")
        return self.rows(OPENED).where(now).join(closed, "scd_id", "left_anti")

    def read(self) -> DataFrame:
        """All versions."""
        return self.spark.table(self.name)

    def current(self) -> DataFrame:
        """Open versions, without reading closed ones of earlier generations."""
        return self.open_versions().select(*self.read().columns)

    def snapshot(self, current: DataFrame, as_of):
        """Bring the history up to date with the current rows, one per key; see ``scd2``.

        Run again with the same rows it adds nothing.
        """
        if not self.exists() and not self._adopt():
            self._append(first_versions(current, self.key, as_of).withColumn("state", F.lit(OPENED)), 0)
        else:
            self._add_columns(current)
            generation = self.generation()
            before = self.open_versions(generation).select(*current.columns, *VERSION)
            changes = changed_versions(before, current, self.key, self.check_cols, as_of)
            state = F.when(F.col("is_current"), OPENED).otherwise(CLOSED)
            with staged(changes.withColumn("state", state)) as rows:
                if not rows.isEmpty():
                    self._append(rows, generation)
            closed = self.rows(CLOSED).where(F.col("generation") == generation).count()
            if closed > self.rows(OPENED).where(F.col("generation") == generation).count() - closed:
                self.compact()
        self._define_view(current.columns)

    def compact(self):
        """Write the open versions as a new generation and drop the one before."""
        generation = self.generation()
        with staged(self.open_versions(generation)) as rows:
            if rows.isEmpty():
                return
            self._append(rows.drop(*PARTS).withColumn("state", F.lit(OPENED)), generation + 1)
        listed = self.spark.sql(f"SHOW PARTITIONS {self.table} PARTITION (state = '{OPENED}')").collect()
        numbers = [int(row["partition"].rsplit("=", 1)[1]) for row in listed]
        old = [{"state": OPENED, "generation": str(n)} for n in numbers if n <= generation]
        drop_partitions(self.spark, self.table, old)

    def _is_plain(self) -> bool:
        """Whether the name is taken by a table rather than by the view."""
        catalog = self.spark.catalog
        return catalog.tableExists(self.name) and catalog.getTable(self.name).tableType != "VIEW"

    def _adopt(self) -> bool:
        """Take over a history that was kept in one table, if there is one."""
        if not self._is_plain():
            return False
        state = F.when(F.col("is_current"), OPENED).otherwise(CLOSED)
        self._append(self.read().withColumn("state", state), 0)
        return True

    def _append(self, rows: DataFrame, generation: int):
        """One job, so that a closed version and its successor are stored together."""
        placed = rows.withColumn("generation", F.lit(generation))
        if self.exists():
            missing = [c for c in self.spark.table(self.table).columns if c not in placed.columns]
            placed = placed.select("*", *[F.lit(None).alias(c) for c in missing])
            placed = placed.select(*self.spark.table(self.table).columns)
            placed.write.insertInto(self.table)
        else:
            placed.write.format("parquet").partitionBy(*PARTS).saveAsTable(self.table)

    def _add_columns(self, current: DataFrame):
        have = self.spark.table(self.table).columns
        new = [f for f in current.schema.fields if f.name not in have]
        if new:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
            self.spark.sql(f"ALTER TABLE {self.table} ADD COLUMNS ({columns})")

    def _define_view(self, columns: list[str]):
        """The view has the columns of the last snapshot; columns that are gone stay in the table."""
        names = [*columns, *VERSION]
        if self._is_plain():
            self.spark.sql(f"DROP TABLE {self.name}")
        if self.spark.catalog.tableExists(self.name) and self.read().columns == names:
            return
        chosen = ", ".join(f"v.`{c}`" for c in names)
        self.spark.sql(f"""
            CREATE OR REPLACE VIEW {self.name} AS
            SELECT {chosen} FROM {self.table} v WHERE state = '{CLOSED}'
            UNION ALL
            SELECT {chosen} FROM {self.table} v
            WHERE state = '{OPENED}'
              AND generation = (SELECT max(generation) FROM {self.table} WHERE state = '{OPENED}')
              AND NOT EXISTS (SELECT 1 FROM {self.table} c WHERE c.state = '{CLOSED}'
                              AND c.generation = v.generation AND c.scd_id = v.scd_id)""")
