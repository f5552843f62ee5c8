"""Salted joins and contracts that are counted while a table is written."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators.contracts import Contract, Watch, run_contract
from tidemark.operators.skew import hot_keys, salted_join
from tidemark.session import new_folder, setting


def skewed(spark, n=6000):
    """A third of the rows has one key, a tenth another; some have none."""
    i = F.col("id")
    zone = F.when(i % 3 == 0, "hot").when(i % 10 == 1, "warm").when(i % 50 != 2, F.concat(F.lit("z"), i % 400))
    return spark.range(n).select(i.alias("n"), zone.alias("zone"), (i % 2).alias("hour"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_a_salted_join_gives_the_rows_of_the_plain_one(spark, rows, how):
    left = skewed(spark)
    right = left.where("zone <> 'z7'").select("zone", "hour").distinct().withColumn("v", F.xxhash64("zone", "hour"))
    right = right.unionByName(right.where("zone = 'hot'").withColumn("v", F.lit(0).cast("long")))
    on = ["zone", "hour"]
    hot = hot_keys(left, on, 1 / 20)
    assert len(hot) == 3 and min(hot.values()) >= 1 and max(hot.values()) >= 3
    found = salted_join(left, right, on, how, 1 / 20)
    plain = left.join(right, on, how)
    assert found.columns == plain.columns and rows(found) == rows(plain)
    assert rows(salted_join(left.limit(0), right, on, how)) == []


def test_no_task_gets_a_hot_key_whole(spark):
    left = skewed(spark, 60_000)
    right = left.select("zone").distinct().withColumn("v", F.xxhash64("zone"))
    with setting(spark, "spark.sql.adaptive.enabled", "false"):
        with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
            with setting(spark, "spark.sql.shuffle.partitions", "16"):
                sizes = {}
                for name, df in (("plain", left.join(right, "zone", "left")), ("salted", salted_join(left, right, ["zone"]))):
                    counted = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("count"), F.max("v"))
                    sizes[name] = sorted(r["count"] for r in counted.collect())
    assert sizes["plain"][-1] > 3 * sizes["plain"][len(sizes["plain"]) // 2]
    assert sizes["salted"][-1] <= 3 * sizes["salted"][len(sizes["salted"]) // 2]


def test_a_watched_write_finds_what_a_second_scan_finds(spark, rows):
    contract = Contract(not_null=["zone", "n"], unique=["n", "zone"], accepted={"hour": [0]})
    df, path = skewed(spark), new_folder(spark, "watched")
    watch = Watch("t", contract)
    watch.over(df).write.parquet(path)
    stored = spark.read.parquet(path)
    found = watch.results(stored)
    assert rows(found) == rows(run_contract("t", df, contract)) and watch.rows == 6000
    text = found._jdf.queryExecution().executedPlan().toString()
    read = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert read and not any("hour" in columns for columns in read)
