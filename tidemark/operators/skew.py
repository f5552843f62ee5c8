"""Joins of a large side with hot keys, salted where a count says so."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: A key is hot from this share of the rows on, so there are at most ``1 / HOT`` of them.
HOT = 1 / 200


def hot_keys(rows: DataFrame, on: list[str], share: float = HOT) -> dict[int, int]:
    """Hash of every hot key, and how many times the hot share it has, rounded up.

    All rows count: keys are counted per task first, and only hot ones, at most ``1 / share``, come to the
    driver. A key with a NULL joins nothing and is not salted.
    """
    counted = rows.dropna("any", subset=on).groupBy(*on).agg(F.count(F.lit(1)).alias("n"))
    total = counted.agg(F.sum("n")).first()[0] or 0
    hot = counted.where(F.col("n") >= share * total).select(F.xxhash64(*on).alias("key"), "n")
    return {r["key"]: -int(-r["n"] // (share * total)) for r in hot.collect()} if total else {}


def salted_join(
    rows: DataFrame, small: DataFrame, on: list[str], how: str = "left", share: float = HOT
) -> DataFrame:
    """``rows`` joined with ``small`` by equal names, ``rows`` first; ``how`` is inner or left.

    A hot key's rows are dealt over as many salts as it has hot shares, and its rows on the small side are
    repeated for each; other keys are joined as they are. The deal follows from a row's own values, so that a task
    that runs again deals alike.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how is 'inner' or 'left', not {how!r}")
    hot = hot_keys(rows, on, share)
    if not hot:
        return rows.join(small, on, how)
    parts = F.create_map(*[F.lit(x).cast(t) for key, n in hot.items() for x, t in ((key, "long"), (n, "int"))])
    small = small.withColumns({c: F.col(c).cast(rows.schema[c].dataType) for c in on})  # equal keys, equal hashes
    salts: Column = F.coalesce(parts[F.xxhash64(*on)], F.lit(1))
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns], F.lit(7)), salts).cast("int"))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return dealt.join(copies, [*on, "_salt"], how).drop("_salt")
