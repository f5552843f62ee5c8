"""Insert-or-update by key, and column evolution."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.dedup import dedup_latest
from tidemark.session import dynamic_overwrite, staged

# Fixed value: how Spark names the partition of rows without a partition value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def worst_repeat(source: DataFrame, keys: list[str]) -> DataFrame:
    """One row: how often the most frequent key without a NULL occurs. Reads keys only."""
    known = reduce(lambda a, b: a & b, [F.isnotnull(k) for k in keys])
    counted = source.where(known).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counted.agg(F.coalesce(F.max("_n"), F.lit(1)).alias("_n"))


def one_row_per_key(source: DataFrame, keys: list[str]) -> DataFrame:
    """The source itself, raising when it is run if a key occurs twice."""
    message = f"upsert source: duplicate key ({', '.join(keys)})"
    return source.where(
        F.assert_true(worst_repeat(source, keys).scalar() == 1, message).isNull()
    )


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    latest: str | None = None,
    tie_break: list[str] | None = None,
) -> DataFrame:
    """The target with rows of equal key replaced by the source's and the others added.

    A key twice in the source raises, unless ``latest`` names the column that decides.
    """
    if latest is not None:
        source = dedup_latest(source, keys, latest, tie_break or [])
    else:
        source = one_row_per_key(source, keys)
    kept = evolve_schema(target, source).join(source.select(*keys), keys, "left_anti")
    return kept.select(*source.columns).unionByName(source)


def evolve_schema(target: DataFrame, source: DataFrame) -> DataFrame:
    """The target's rows under the source's columns: new ones NULL, removed ones dropped."""
    types = {field.name: field.dataType for field in source.schema.fields}
    present = set(target.columns)
    return target.select(
        *[
            (F.col(name) if name in present else F.lit(None)).cast(kind).alias(name)
            for name, kind in types.items()
        ]
    )


def touched_rows(target: DataFrame, source: DataFrame, partition_cols: list[str]) -> DataFrame:
    """The target's rows in the partitions the source has rows for.

    The bounds of every partition column, two scalars each, are written into the filter, so that
    the scan skips what lies outside; a join with the values decides within. Only bounds reach the
    driver, however many partitions there are.
    """
    bounds = source.agg(
        *[
            part
            for i, c in enumerate(partition_cols)
            for part in (
                F.min(c).alias(f"low{i}"),
                F.max(c).alias(f"high{i}"),
                F.max(F.isnull(c)).alias(f"null{i}"),
            )
        ]
    ).first()
    if bounds["null0"] is None:
        return target.limit(0)
    for i, name in enumerate(partition_cols):
        column, low, high = F.col(name), bounds[f"low{i}"], bounds[f"high{i}"]
        within = F.lit(False) if low is None else column.between(low, high)
        # Rows without a partition value share one partition, which is rewritten like any other.
        target = target.where(within | column.isNull() if bounds[f"null{i}"] else within)
    left, right = target.alias("_stored"), source.select(*partition_cols).distinct().alias("_touched")
    same = [F.col(f"_stored.{c}").eqNullSafe(F.col(f"_touched.{c}")) for c in partition_cols]
    return left.join(right, reduce(lambda a, b: a & b, same), "left_semi")


def sync_columns(spark: SparkSession, table: str, source: DataFrame, partition_cols: list[str]):
    """Give a stored table the source's columns.

    New columns are a catalog change only. Removed ones need a rewrite: the new table is
    completed under a second name and then swapped in.
    """
    have = spark.table(table).schema
    new = [f for f in source.schema.fields if f.name not in have.names]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    if any(name not in source.columns for name in have.names):
        swap_in(spark.table(table).select(*source.columns), table, partition_cols)


def swap_in(df: DataFrame, table: str, partition_cols: list[str]):
    """Replace a table, which ``df`` may read.

    The rows of a table without partitions go to a new folder, and then one catalog change points
    the table there: a reader sees the old rows or the new ones, and no files are copied. The last
    folder stays until the next swap, for readers that still list it. Where columns change or there
    are partitions, the new table is completed under a second name; it is missing for a moment
    between the drop of the old one and its own renaming.
    """
    spark = df.sparkSession
    finish_swap(spark, table)
    if not partition_cols and _same_columns(spark, table, df):
        before = location_of(spark, table)
        root, name = before.rsplit("/", 1)
        stem = name.split("__v_")[0]
        after = f"{root}/{stem}__v_{uuid.uuid4().hex}"
        df.write.parquet(after)
        spark.sql(f"ALTER TABLE {table} SET LOCATION {quoted(after)}")
        spark.catalog.refreshTable(table)
        drop_folders(spark, root, stem, keep={before, after})
        return
    if not spark.catalog.tableExists(table):
        drop_versions(spark, table)
    unfinished, complete = f"{table}__unfinished", f"{table}__complete"
    spark.sql(f"DROP TABLE IF EXISTS {unfinished}")
    write_new(df, unfinished, partition_cols)
    rename_table(spark, unfinished, complete)
    finish_swap(spark, table)


def _same_columns(spark: SparkSession, table: str, df: DataFrame) -> bool:
    """Whether the table is stored without partitions and with just these columns."""
    if not spark.catalog.tableExists(table):
        return False
    if any(column.isPartition for column in spark.catalog.listColumns(table)):
        return False
    have = [(f.name, f.dataType) for f in spark.table(table).schema.fields]
    return have == [(f.name, f.dataType) for f in df.schema.fields]


def location_of(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
    return described.first()["data_type"]


def drop_versions(spark: SparkSession, table: str):
    """Delete what swaps have kept of a table that was dropped since."""
    database, _, name = table.rpartition(".")
    root = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    drop_folders(spark, root, name, keep=set())


def drop_folders(spark: SparkSession, root: str, stem: str, keep: set[str]):
    """Delete the folders of a table's former versions."""
    names = {path.rsplit("/", 1)[1] for path in keep}
    found = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{stem}{{,__v_*}}")
    files = found.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.globStatus(found) or []:
        if status.getPath().getName() not in names:
            files.delete(status.getPath(), True)


def finish_swap(spark: SparkSession, table: str):
    """Put a completed replacement in place; also resumes a swap that was cut off."""
    complete = f"{table}__complete"
    if spark.catalog.tableExists(complete):
        if spark.catalog.tableExists(table):
            spark.sql(f"DROP TABLE {table}")
        drop_versions(spark, table)
        rename_table(spark, complete, table)


def rename_table(spark: SparkSession, old: str, new: str):
    """Rename a managed table. The session-local catalog moves the files of a partitioned
    table but keeps the old partition locations, so they are set again there."""
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")
    partitioned = any(column.isPartition for column in spark.catalog.listColumns(new))
    if not partitioned or spark.conf.get("spark.sql.catalogImplementation") != "in-memory":
        return
    root = location_of(spark, new)
    for row in spark.sql(f"SHOW PARTITIONS {new}").collect():
        spec = partition_spec(partition_values(row["partition"]))
        spark.sql(f"ALTER TABLE {new} {spec} SET LOCATION {quoted(f'{root}/{row[0]}')}")
    spark.catalog.refreshTable(new)


def partition_values(path: str) -> dict[str, str]:
    """``a=1/b=x%2Fy`` as column -> value."""
    return {
        name: unquote(value) for name, value in (part.split("=", 1) for part in path.split("/"))
    }


def partition_spec(values: dict[str, str]) -> str:
    pairs = [
        f"{name} = {'null' if value == NO_VALUE else quoted(value)}"
        for name, value in values.items()
    ]
    return f"PARTITION ({', '.join(pairs)})"


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def write_new(df: DataFrame, table: str, partition_cols: list[str]):
    """Create a table. Rebalancing splits a hot partition value over several tasks and files."""
    writer = (df.hint("rebalance", *partition_cols) if partition_cols else df).write
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.format("parquet").saveAsTable(table)


def overwrite_touched(spark: SparkSession, df: DataFrame, table: str, partition_cols: list[str]):
    """Replace exactly the partitions that occur in ``df``."""
    ordered = df.select(*spark.table(table).columns)
    with dynamic_overwrite(spark):
        ordered.hint("rebalance", *partition_cols).write.insertInto(table, overwrite=True)


def upsert_table(
    spark: SparkSession,
    table: str,
    source: DataFrame,
    keys: list[str],
    partition_cols: list[str],
    latest: str | None = None,
    tie_break: list[str] | None = None,
    after: Callable[[DataFrame], None] | None = None,
    keys_may_move: bool = True,
    before: Callable[[DataFrame], None] | None = None,
):
    """Upsert into a partitioned Parquet table, rewriting only the touched partitions.

    A key whose stored row lies in another partition is moved: that partition is rewritten too.
    Finding such rows reads the table's key columns; where the key determines the partition,
    ``keys_may_move=False`` saves it. Parquet tables have no transactions: two writers of one
    table must not run at once (see ``audit.active_runs``). ``after`` is called with the staged
    batch once it is stored, ``before`` with the values of the partitions that will change, before
    anything does.
    """
    if latest is not None:
        source = dedup_latest(source, keys, latest, tie_break or [])
    # The batch feeds several jobs, which must all see the same rows.
    with staged(source) as batch:
        if worst_repeat(batch, keys).first()["_n"] > 1:
            raise ValueError(f"upsert source: duplicate key ({', '.join(keys)})")
        finish_swap(spark, table)
        changing = before or (lambda touched: None)
        if not spark.catalog.tableExists(table):
            changing(batch.select(*partition_cols).distinct())
            write_new(batch, table, partition_cols)
        elif keys_may_move and not set(partition_cols) <= set(keys):
            sync_columns(spark, table, batch, partition_cols)
            new = batch.select(*partition_cols)
            old = spark.table(table).join(batch.select(*keys), keys, "left_semi")
            with staged(new.union(old.select(*partition_cols)).distinct()) as touched:
                changing(touched)
                _rewrite(spark, table, batch, keys, partition_cols, touched)
        else:
            sync_columns(spark, table, batch, partition_cols)
            changing(batch.select(*partition_cols).distinct())
            _rewrite(spark, table, batch, keys, partition_cols, batch)
        if after is not None:
            after(batch)


def _rewrite(
    spark: SparkSession,
    table: str,
    batch: DataFrame,
    keys: list[str],
    partition_cols: list[str],
    touched: DataFrame,
):
    """Write the touched partitions anew and drop those that all rows have left."""
    target = touched_rows(spark.table(table), touched, partition_cols)
    kept = target.join(batch.select(*keys), keys, "left_anti").select(*batch.columns)
    rows = kept.unionByName(batch)
    if touched is batch:
        overwrite_touched(spark, rows, table, partition_cols)
        return
    replace_touched(spark, rows, table, partition_cols, touched)


def replace_touched(
    spark: SparkSession, rows: DataFrame, table: str, partition_cols: list[str], touched: DataFrame
):
    """Put ``rows`` in place of the touched partitions; those that have no rows any more go."""
    left, right = touched.alias("_touched"), rows.select(*partition_cols).distinct().alias("_new")
    same = [F.col(f"_touched.{c}").eqNullSafe(F.col(f"_new.{c}")) for c in partition_cols]
    # Names of partitions to drop, which the catalog holds on the driver as well.
    text = [F.coalesce(F.col(c).cast("string"), F.lit(NO_VALUE)).alias(c) for c in partition_cols]
    gone = left.join(right, reduce(lambda a, b: a & b, same), "left_anti").select(*text).collect()
    overwrite_touched(spark, rows, table, partition_cols)
    if gone:
        specs = ", ".join(partition_spec(row.asDict()) for row in gone)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")


def upsert_newest(
    batch: DataFrame,
    table: str,
    keys: list[str],
    latest: str,
    tie_break: list[str],
    partition_cols: list[str],
    after: Callable[[DataFrame], None] | None = None,
):
    """Store the batch's latest row per key where it is not older than the stored one. The key must
    determine the partition."""
    spark = batch.sparkSession
    with staged(dedup_latest(batch, keys, latest, tie_break)) as newest:
        rows = newest
        if spark.catalog.tableExists(table):
            stored = touched_rows(spark.table(table), newest, partition_cols)
            rows = newer_than_stored(newest, stored, keys, [latest, *tie_break])
        upsert_table(spark, table, rows, keys, partition_cols, keys_may_move=False, after=after)


def newer_than_stored(
    batch: DataFrame, stored: DataFrame, keys: list[str], order: list[str]
) -> DataFrame:
    """Rows that come after, or are, the stored ones in the order of ``dedup_latest``.

    NULL comes before every value, in the structs compared here as in the ranks.
    """
    held = stored.select(*keys, F.struct(*order).alias("_held"))
    joined = batch.join(held, keys, "left")
    return joined.where(F.isnull("_held") | (F.struct(*order) >= F.col("_held"))).drop("_held")
