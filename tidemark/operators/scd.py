"""Slowly changing dimensions of type 2."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.keys import hash_key, surrogate_key

VERSION = ["valid_from", "valid_to", "is_current", "updated_at", "scd_id"]


def _as_of(value) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("timestamp")


def _opening(key: Column, start: Column) -> dict[str, Column]:
    return {
        "valid_from": start,
        "valid_to": F.lit(None).cast("timestamp"),
        "is_current": F.lit(True),
        "updated_at": start,
        "scd_id": surrogate_key(key, start),
    }


def first_versions(current: DataFrame, key: str, as_of) -> DataFrame:
    """Open a version for every row."""
    opening = _opening(F.col(key), _as_of(as_of))
    return current.select("*", *[value.alias(name) for name, value in opening.items()])


def scd2(
    history: DataFrame, current: DataFrame, key: str, check_cols: list[str], as_of
) -> DataFrame:
    """History after comparing its open versions with the current rows.

    A changed check column (NULL-safe) closes the open version and opens a new one; a new key
    opens one; a key that is gone stays open. Other columns alone make no new version.
    """
    columns = [*current.columns, *VERSION]
    rows = _compared(history.where("is_current"), current, key, check_cols, as_of, "full")
    return history.where(~F.col("is_current")).select(*columns).unionByName(rows)


def changed_versions(
    open_versions: DataFrame, current: DataFrame, key: str, check_cols: list[str], as_of
) -> DataFrame:
    """What ``scd2`` closes and opens, without the versions that stay as they are."""
    return _compared(open_versions, current, key, check_cols, as_of, "right")


def _compared(
    open_versions: DataFrame, current: DataFrame, key: str, check_cols: list[str], as_of, how: str
) -> DataFrame:
    """Versions after a comparison; a right join leaves out those without a change."""
    start = _as_of(as_of)
    columns = [*current.columns, *VERSION]
    before = open_versions.select(F.col(key).alias("_old_key"), F.struct(*columns).alias("_old"))
    after = current.select(F.col(key).alias("_new_key"), F.struct(*current.columns).alias("_new"))
    # Both sides have one row per key, so no key is hot here.
    both = before.join(after, F.col("_old_key") == F.col("_new_key"), how)

    opened = F.struct(
        *[F.col(f"_new.{c}").alias(c) for c in current.columns],
        *[value.alias(name) for name, value in _opening(F.col("_new_key"), start).items()],
    )
    old = F.col("_old")
    closed = (
        old.withField("valid_to", start)
        .withField("updated_at", start)
        .withField("is_current", F.lit(False))
    )
    differs = reduce(
        lambda a, b: a | b,
        [~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")) for c in check_cols],
    )
    kind = both.select(F.array(old)).schema[0].dataType
    late = F.raise_error("scd2: a change must be later than the open version").cast(kind)
    same = F.array(old) if how == "full" else F.array().cast(kind)
    rows = (
        F.when(F.isnull("_old_key"), F.array(opened))
        .when(F.isnull("_new_key") | ~differs, same)
        .when(F.col("_old.valid_from") < start, F.array(closed, opened))
        .otherwise(late)
    )
    return both.select(F.inline(rows)).toDF(*columns)


def current_versions(history: DataFrame, key: str, key_name: str) -> DataFrame:
    """Open versions with a hashed key that stays the same over all versions."""
    return history.where("is_current").select(hash_key(key).alias(key_name), "*")


def versions_at(history: DataFrame, instant) -> DataFrame:
    """The versions valid at one instant."""
    t = _as_of(instant)
    return history.where(
        (F.col("valid_from") <= t) & (F.isnull("valid_to") | (t < F.col("valid_to")))
    )


def as_of_version(
    facts: DataFrame,
    history: DataFrame,
    key: str,
    at: str,
    attributes: list[str],
    bucket: str = "day",
) -> DataFrame:
    """Left join each fact row to the version of its key valid at its own time.

    Joined on (key, time bucket): each bucket gets the versions that start in it plus the one
    carried in from before. A key with many versions or most of the fact rows is thus spread
    over its buckets, instead of comparing all its rows with all its versions.
    """
    version = F.struct("valid_from", "valid_to", *attributes).alias("_version")
    starts = history.select(key, F.date_trunc(bucket, "valid_from").alias("_bucket"), version)
    facts = facts.withColumn("_bucket", F.date_trunc(bucket, at))

    last_start = starts.groupBy(key, "_bucket").agg(
        F.max_by("_version", "_version.valid_from").alias("_last")
    )
    asked = facts.select(key, "_bucket").distinct().withColumn("_asked", F.lit(True))
    before = (
        Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        asked.join(last_start, [key, "_bucket"], "full")
        .withColumn("_version", F.last("_last", ignorenulls=True).over(before))
        .where("_asked and _version is not null")
        .select(key, "_bucket", "_version")
    )
    candidates = starts.unionByName(carried).select(
        F.col(key).alias("_key"), F.col("_bucket").alias("_in"), "_version"
    )
    t = F.col(at)
    matched = facts.join(
        candidates,
        (F.col(key) == F.col("_key"))
        & (F.col("_bucket") == F.col("_in"))
        & (F.col("_version.valid_from") <= t)
        & (F.isnull("_version.valid_to") | (t < F.col("_version.valid_to"))),
        "left",
    )
    return matched.select(
        *[c for c in facts.columns if c != "_bucket"],
        *[F.col(f"_version.{c}").alias(c) for c in attributes],
    )
