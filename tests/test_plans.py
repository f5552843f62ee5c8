"""What the plans of the registered queries must and must not contain."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tidemark.catalog.oracle import ORACLE
from tidemark.catalog.queries import REGISTRY
from tidemark.operators import rollup, scd
from tidemark.operators.dedup import dedup_latest
from tidemark.operators.upsert import upsert
from tidemark.plans import gold

FOLDER = "/root/testdata/sf0.001"
# These write to the shared folder while they are built.
WRITING = {
    "scan_landed_json", "seed_csv", "partition_by", "full_refresh", "export_tables",
    "stream_upsert", "stream_dedup", "stream_daily", "incremental_rollup", "incremental_report",
    "stored_scd2", "stored_current_versions", "stored_versions_at", "unread_files",
    "stream_dedup_within", "stream_windows", "stream_ingest", "observed_contracts",
}
FORBIDDEN = [
    "CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython",
    "BatchEvalPython", "MapInPandas", "FlatMapGroups",
]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_sql_of_the_same_name():
    assert set(REGISTRY) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - WRITING))
def test_no_pair_joins_and_no_python_in_the_plan(spark, name):
    text = plan(REGISTRY[name](spark, FOLDER))
    assert [word for word in FORBIDDEN if word in text] == []


def test_scans_read_only_what_they_need(spark):
    text = plan(REGISTRY["select_subset"](spark, FOLDER))
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in text
    text = plan(REGISTRY["filter_boolean"](spark, FOLDER))
    assert "c_name" not in text
    text = plan(REGISTRY["test_accepted_values"](spark, FOLDER))
    assert "PushedFilters: [Not(In(event_type" in text


def test_the_fact_is_grouped_before_it_is_joined(spark):
    """The location join sits above an aggregate in the report."""
    fact = REGISTRY["fact_build"](spark, FOLDER)
    fact = fact.select(
        *[F.col(c).cast("timestamp") if t == "timestamp_ntz" else F.col(c) for c, t in fact.dtypes]
    )
    places = spark.range(10).select(
        F.col("id").cast("string").alias("location_key"),
        F.col("id").cast("string").alias("city"),
        F.lit("x").alias("country"),
    )
    lines = plan(gold.agg_daily_energy(fact, places)).split("\n")
    joins = [i for i, line in enumerate(lines) if "Join" in line]
    aggregates = [i for i, line in enumerate(lines) if "HashAggregate" in line]
    assert min(joins) > min(aggregates) and min(joins) < max(aggregates)
    assert len([i for i in aggregates if i > min(joins)]) >= 2


@pytest.mark.parametrize("name", ["uk_reading", "latest_chunk"])
def test_documents_are_neither_sorted_nor_shuffled_by_their_payload(spark, name):
    for line in plan(REGISTRY[name](spark, FOLDER)).split("\n"):
        if re.search(r"Sort \[|WindowGroupLimit|Window \[|hashpartitioning", line):
            assert "payload#" not in line, line


def test_energy_of_the_stored_fact_is_bounded_by_the_touched_days(spark):
    from tidemark.plans.medallion import _within

    days = spark.sql("SELECT date '2024-01-03' AS touched_date UNION ALL SELECT date '2024-01-05'")
    events = spark.read.parquet(f"{FOLDER}/events.parquet")
    events = events.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    text = plan(_within(events, "ts", days))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ts,2024-01-03.*LessThanOrEqual\(ts,2024-01-06", text)


def hot_rows(spark, n=30_000):
    """A third of all rows under one key."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    return spark.range(0, n, 1, 8).select(
        key.alias("k"), F.col("id"), (F.col("id") % 7).cast("string").alias("c")
    )


def test_a_hot_key_is_limited_before_the_shuffle(spark):
    latest = dedup_latest(hot_rows(spark), ["k"], "id", ["c"])
    text = plan(latest)
    partial, exchange = text.index("1, Partial"), text.index("Exchange hashpartitioning")
    assert exchange < partial  # plans read from the last step down to the scan
    hot = latest.where("k = 0").collect()
    assert len(hot) == 1 and hot[0]["id"] == 29_997
    assert latest.count() == 1 + 20_000


def test_a_hot_key_in_upsert_and_mode(spark):
    rows = hot_rows(spark)
    result = upsert(rows.select("id", "k", "c"), rows.select("id", "k", F.lit("new").alias("c")), ["id"])
    assert result.where("c = 'new'").count() == result.count() == 30_000
    mode = rollup.dominant(rows, ["k"], "c")
    top = mode.where("k = 0").first()
    assert (top["c"], top["cnt"]) == ("0", 1429)


def test_a_hot_key_with_many_versions_is_spread_over_time(spark):
    """All facts and versions under one key: still an equi-join on (key, bucket)."""
    start = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    step = F.timestamp_add("HOUR", F.col("id"), start)
    history = spark.range(500).select(
        F.lit("hot").alias("k"),
        step.alias("valid_from"),
        F.when(F.col("id") < 499, F.timestamp_add("HOUR", F.col("id") + 1, start)).alias("valid_to"),
        F.col("id").alias("version"),
    )
    facts = spark.range(4000).select(
        F.col("id"), F.lit("hot").alias("k"), F.timestamp_add("MINUTE", F.col("id") * 8, start).alias("at")
    )
    joined = scd.as_of_version(facts, history, "k", "at", ["version"])
    wrong = joined.where(F.col("version") != F.least(F.floor(F.col("id") * 8 / 60), F.lit(499)))
    assert joined.count() == 4000 and wrong.isEmpty()
    assert joined.where("version is null").isEmpty()
    text = plan(joined)
    assert re.search(r"Join \[.*_bucket#\d+", text)
