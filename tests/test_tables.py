from __future__ import annotations

import re
from pathlib import Path
from datetime import date, datetime
from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F

from tidemark.operators import tables
from tidemark.operators.export import export, jdbc_options, jdbc_sink
from tidemark.operators.upsert import (
    finish_swap,
    swap_in,
    touched_rows,
    upsert_table,
    write_new,
)
from tidemark.session import STAGING, shared_folder, staged
from tidemark.streaming import incremental

ONE, TWO = date(2024, 1, 1), date(2024, 1, 2)
ROW = "id int, v string, day date, country string"


def frame(spark, *data):
    return spark.createDataFrame(list(data), ROW)


def replace(spark, table, day, *data, scope="date"):
    tables.replace_partitions(frame(spark, *data), table, day, "day", "country", scope)


@pytest.mark.parametrize("scope, left", [("date", []), ("partition", [(2, "old", ONE, "b b/'x")])])
def test_replacing_a_day(spark, database, rows, scope, left):
    table = f"{database}.t"
    other = (3, "kept", TWO, "b b/'x")
    replace(spark, table, ONE, (1, "old", ONE, "a"), (2, "old", ONE, "b b/'x"))
    replace(spark, table, TWO, other)
    replace(spark, table, ONE, (1, "new", ONE, "a"), scope=scope)
    assert rows(spark.table(table), *ROW_NAMES) == sorted([(1, "new", ONE, "a"), *left, other])
    replace(spark, table, ONE, (1, "new", ONE, "a"), scope=scope)
    assert rows(spark.table(table), *ROW_NAMES) == sorted([(1, "new", ONE, "a"), *left, other])


ROW_NAMES = ["id", "v", "day", "country"]


def test_replacing_a_day_without_a_second_partition_value(spark, database, rows):
    table = f"{database}.t"
    replace(spark, table, ONE, (1, "old", ONE, None), (2, "old", ONE, "a"))
    replace(spark, table, ONE, (1, "new", ONE, None))
    assert rows(spark.table(table), *ROW_NAMES) == [(1, "new", ONE, None)]
    replace(spark, table, ONE, (3, "new", ONE, "b"))
    assert rows(spark.table(table), *ROW_NAMES) == [(3, "new", ONE, "b")]


def test_a_failed_replacement_leaves_the_day_as_it_was(spark, database, rows):
    table = f"{database}.t"
    replace(spark, table, ONE, (1, "old", ONE, "a"))
    broken = frame(spark, (1, "new", ONE, "a")).withColumn(
        "v", F.raise_error(F.lit("lost")).cast("string")
    )
    with pytest.raises(Exception, match="lost"):
        tables.replace_partitions(broken, table, ONE, "day", "country")
    assert rows(spark.table(table), *ROW_NAMES) == [(1, "old", ONE, "a")]


def test_deleting_a_date_and_listing_tables(spark, database, rows):
    table = f"{database}.t"
    replace(spark, table, ONE, (1, "x", ONE, "a"), (2, "x", ONE, "b"))
    replace(spark, table, TWO, (3, "x", TWO, "a"))
    tables.delete_date(spark, table, "day", ONE)
    tables.delete_date(spark, table, "day", date(2020, 1, 1))
    assert rows(spark.table(table), "id") == [(3,)]
    assert tables.list_tables(spark, database) == ["t"]
    tables.ensure_schema(spark, database)


def test_upsert_rewrites_only_touched_partitions(spark, database, rows):
    table, parts = f"{database}.t", ["day"]
    upsert_table(spark, table, frame(spark, (1, "a", ONE, "x"), (2, "a", TWO, "x")), ["id"], parts)
    before = files_of(spark, table)
    batch = frame(spark, (2, "b", TWO, "x"), (3, "b", TWO, "x"))
    for _ in range(2):
        upsert_table(spark, table, batch, ["id"], parts)
        assert rows(spark.table(table), "id", "v") == [(1, "a"), (2, "b"), (3, "b")]
    kept = {f for f in before if "day=2024-01-01" in f}
    assert kept and kept <= files_of(spark, table)
    assert not before - kept <= files_of(spark, table)


def files_of(spark, table):
    spark.sql(f"REFRESH TABLE {table}")
    return set(spark.table(table).inputFiles())


@pytest.mark.parametrize("parts", [["day"], ["day", "country"]])
@pytest.mark.parametrize("moves", [True, False])
def test_upsert_keeps_rows_without_a_partition_value(spark, database, rows, parts, moves):
    table = f"{database}.t"
    first = [(1, "a", None, "x"), (2, "a", None, "x"), (3, "a", ONE, "x"), (5, "a", TWO, "y")]
    upsert_table(spark, table, frame(spark, *first), ["id"], parts, keys_may_move=moves)
    batch = frame(spark, (2, "b", None, "x"), (4, "b", ONE, "x"))
    upsert_table(spark, table, batch, ["id"], parts, keys_may_move=moves)
    expected = [(1, "a"), (2, "b"), (3, "a"), (4, "b"), (5, "a")]
    assert rows(spark.table(table), "id", "v") == expected


def test_touched_rows_skip_the_other_partitions(spark, database):
    table = f"{database}.t"
    write_new(frame(spark, (1, "a", ONE, "x"), (2, "a", TWO, "x")), table, ["day"])
    found = touched_rows(spark.table(table), frame(spark, (9, "b", TWO, "x")), ["day"])
    text = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*day#\d+ >= 2024-01-02.*day#\d+ <= 2024-01-02", text)
    assert [row["id"] for row in found.collect()] == [2]


@pytest.mark.parametrize("day", [TWO, None])
def test_upsert_moves_a_key_to_another_partition(spark, database, rows, day):
    table = f"{database}.t"
    first = frame(spark, (1, "a", ONE, "x"), (2, "a", ONE, "x"), (3, "a", TWO, "x"))
    upsert_table(spark, table, first, ["id"], ["day"])
    upsert_table(spark, table, frame(spark, (1, "b", day, "x")), ["id"], ["day"])
    assert rows(spark.table(table), "id", "v") == [(1, "b"), (2, "a"), (3, "a")]
    # The last row of a partition leaves it.
    upsert_table(spark, table, frame(spark, (2, "b", day, "x")), ["id"], ["day"])
    assert rows(spark.table(table), "id", "v") == [(1, "b"), (2, "b"), (3, "a")]
    assert rows(spark.table(table).where(F.col("day") == ONE)) == []


def test_a_row_of_another_day_stops_the_replacement(spark, database, rows):
    table = f"{database}.t"
    first = frame(spark, (1, "a", ONE, "x"), (2, "a", TWO, "x"), (3, "a", TWO, "y"))
    write_new(first, table, ["day", "country"])
    stray = frame(spark, (4, "b", ONE, "x"), (5, "b", TWO, "x"))
    with pytest.raises(Exception, match="not of 2024-01-01"):
        tables.replace_partitions(stray, table, ONE, "day", "country")
    with pytest.raises(Exception, match="not of 2024-01-01"):
        tables.replaced(first, stray, "day", ONE).collect()
    spark.catalog.refreshTable(table)
    assert rows(spark.table(table), "id", "v") == [(1, "a"), (2, "a"), (3, "a")]


def test_upsert_of_nothing_and_of_duplicates(spark, database, rows):
    table = f"{database}.t"
    upsert_table(spark, table, frame(spark, (1, "a", ONE, "x")), ["id"], ["day"])
    upsert_table(spark, table, frame(spark), ["id"], ["day"])
    twice = frame(spark, (1, "b", ONE, "x"), (1, "c", ONE, "x"))
    with pytest.raises(ValueError, match="duplicate key"):
        upsert_table(spark, table, twice, ["id"], ["day"])
    assert rows(spark.table(table), "v") == [("a",)]
    upsert_table(spark, table, twice, ["id"], ["day"], latest="v", tie_break=["country"])
    assert rows(spark.table(table), "v") == [("c",)]
    assert staged_folders(spark) == []


def test_upsert_follows_added_and_removed_columns(spark, database, rows):
    table = f"{database}.t"
    upsert_table(spark, table, frame(spark, (1, "a", ONE, "x")), ["id"], ["day"])
    wider = frame(spark, (2, "b", TWO, "x")).withColumn("extra", F.lit(1.5))
    upsert_table(spark, table, wider, ["id"], ["day"])
    assert rows(spark.table(table), "id", "v", "extra") == [(1, "a", None), (2, "b", 1.5)]
    narrower = frame(spark, (3, "c", TWO, "x")).drop("country")
    upsert_table(spark, table, narrower, ["id"], ["day"])
    assert set(spark.table(table).columns) == {"id", "v", "day"}
    assert rows(spark.table(table), "id", "v") == [(1, "a"), (2, "b"), (3, "c")]


def test_a_cut_off_swap_is_finished(spark, database, rows):
    table = f"{database}.t"
    write_new(frame(spark, (1, "old", ONE, "x")), table, [])
    swap_in(spark.table(table).withColumn("v", F.lit("read itself")), table, [])
    assert rows(spark.table(table), "v") == [("read itself",)]
    write_new(frame(spark, (1, "new", ONE, "x")), f"{table}__complete", [])
    spark.sql(f"DROP TABLE {table}")
    finish_swap(spark, table)
    finish_swap(spark, table)
    assert rows(spark.table(table), "v") == [("new",)]
    assert tables.list_tables(spark, database) == ["t"]


def test_a_refresh_never_leaves_readers_without_a_table(spark, database, rows, monkeypatch):
    table = f"{database}.t"
    write_new(frame(spark, (1, "old", ONE, "x")), table, [])
    seen, plain = [], type(spark).sql

    def watched(self, text, *args, **more):
        if str(text).startswith("ALTER TABLE"):
            seen.append(rows(self.table(table), "v"))
            plain(self, text, *args, **more)
            self.catalog.refreshTable(table)
            seen.append(rows(self.table(table), "v"))
        else:
            return plain(self, text, *args, **more)

    monkeypatch.setattr(type(spark), "sql", watched)
    for v in ("new", "newer", "newest"):
        swap_in(frame(spark, (1, v, ONE, "x")), table, [])
    assert [s[0][0] for s in seen] == ["old", "new", "new", "newer", "newer", "newest"]
    assert rows(spark.table(table), "v") == [("newest",)]
    assert tables.list_tables(spark, database) == ["t"]


def staged_folders(spark):
    folder = Path(shared_folder(spark).removeprefix("file:")) / STAGING
    return sorted(folder.iterdir()) if folder.exists() else []


def test_staged_rows_lie_in_the_shared_folder_and_go_away(spark):
    with staged(spark.range(5)) as df:
        assert df.count() == 5
        assert all(shared_folder(spark) in name for name in df.inputFiles())
    assert staged_folders(spark) == []


def test_rows_that_fail_while_they_are_staged_leave_no_folder(spark):
    before = staged_folders(spark)
    with pytest.raises(Exception, match="stray row"):
        with staged(spark.range(5).where(F.assert_true(F.col("id") < 3, "stray row").isNull())):
            pass
    assert staged_folders(spark) == before


def test_export_counts_in_order_and_stops_at_the_first_failure(spark, tmp_path):
    spark.range(4).createOrReplaceTempView("first_table")
    spark.range(0).createOrReplaceTempView("empty_table")
    written = []

    def sink(df, name):
        if name == "bad":
            raise OSError("unreachable")
        df.write.parquet(f"{tmp_path}/{name}")
        written.append(name)

    counts = export(spark, {"a": "first_table", "b": "empty_table"}, sink)
    assert counts == {"a": 4, "b": 0}
    with pytest.raises(OSError):
        export(spark, {"c": "first_table", "bad": "first_table", "d": "first_table"}, sink)
    assert written == ["a", "b", "c"]


def test_jdbc_options_keep_the_table_and_bound_the_connections():
    assert jdbc_options("jdbc:x", "s.t", batchsize=5, partitions=2) == {
        "url": "jdbc:x",
        "dbtable": "s.t",
        "truncate": "true",
        "batchsize": "5",
        "numPartitions": "2",
    }


def test_jdbc_sink_writes_from_the_executors():
    """The writer is a stand-in: no database may be started here."""
    df = MagicMock()
    jdbc_sink("jdbc:x", {"user": "u"}, "serving", batchsize=5)(df, "t")
    writer = df.write.format
    writer.assert_called_once_with("jdbc")
    writer.return_value.mode.assert_called_once_with("overwrite")
    options = writer.return_value.mode.return_value.options
    assert options.call_args.kwargs == jdbc_options("jdbc:x", "serving.t", 5) | {"user": "u"}
    options.return_value.save.assert_called_once_with()


# --- streams -----------------------------------------------------------------------------


def readings(spark, *data):
    return spark.createDataFrame(list(data), "k string, at timestamp, v int")


def at(day, hour=0):
    return datetime(2024, 1, day, hour)


def stream_of(spark, path, files_per_batch=1):
    schema = "k string, at timestamp, v int"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def land(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def test_stream_upsert_is_independent_of_batches_and_order(spark, database, tmp_path, rows):
    source, table = f"{tmp_path}/in", f"{database}.t"

    def run():
        stream = stream_of(spark, source).withColumn("day", F.to_date("at"))
        incremental.upsert_stream(
            stream, table, f"{tmp_path}/cp", ["k", "day"], "at", ["v"], ["day"]
        ).awaitTermination()
        return rows(spark.table(table), "k", "at", "v")

    land(readings(spark, ("a", at(1, 5), 1), ("a", at(1, 3), 2), ("b", at(1, 1), 3)), source)
    assert run() == [("a", at(1, 5), 1), ("b", at(1, 1), 3)]
    land(readings(spark, ("a", at(1, 4), 9), ("b", at(1, 2), 4), ("a", at(2, 0), 5)), source)
    expected = [("a", at(1, 5), 1), ("a", at(2, 0), 5), ("b", at(1, 2), 4)]
    assert run() == expected
    assert run() == expected


def in_batches(spark, source, files, start, out):
    """Land the files and run a stream that takes so many at a time."""
    stream = stream_of(spark, source, files).withColumn("day", F.to_date("at"))
    start(stream, out).awaitTermination()
    return spark.table(out)


@pytest.fixture
def shuffled(spark, tmp_path):
    """Three files whose days come in the order 3, 1, 2, with late and repeated rows."""
    source = f"{tmp_path}/in"
    for day in (3, 1, 2):
        land(readings(spark, *[(k, at(day, h), day * 10 + h) for k in "ab" for h in (1, 2, 3)]), source)
    land(readings(spark, ("a", at(1, 9), 1), ("b", at(3, 1), 31)), source)
    return source


@pytest.mark.parametrize("files", [1, 2, 1000])
def test_streams_give_the_same_rows_whatever_the_batches(spark, database, tmp_path, rows, shuffled, files):
    def distinct(stream, out):
        return incremental.distinct_stream(stream, out, f"{tmp_path}/d", ["k", "day"], ["day"])

    def daily(stream, out):
        return incremental.rollup_stream(
            stream, f"{database}.rows", out, f"{tmp_path}/r", ["k", "at", "day"], "v", ["k"], ["day"],
            lambda df: df.groupBy("k", "day").agg(F.sum("v").alias("s")).select("k", "s", "day"),
        )

    found = in_batches(spark, shuffled, files, distinct, f"{database}.d")
    assert found.count() == found.distinct().count() == 6
    sums = rows(in_batches(spark, shuffled, files, daily, f"{database}.r"), "day", "k", "s")
    assert [s[2] for s in sums] == [37, 36, 66, 66, 96, 96]


@pytest.mark.parametrize("order", [(1, 2), (2, 1)])
def test_stream_upsert_breaks_ties_alike_in_any_order(spark, database, tmp_path, rows, order):
    source, table = f"{tmp_path}/in", f"{database}.t"
    for v in order:
        land(readings(spark, ("a", at(1, 5), v)), source)
        land(readings(spark, ("n", None, v)).withColumn("v", F.lit(v)), source)
    stream = stream_of(spark, source).withColumn("day", F.coalesce(F.to_date("at"), F.lit(ONE)))
    incremental.upsert_stream(
        stream, table, f"{tmp_path}/cp", ["k", "day"], "at", ["v"], ["day"]
    ).awaitTermination()
    assert rows(spark.table(table), "k", "v") == [("a", 2), ("n", 2)]
