"""Latest row per key and the high-water mark that feeds it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.keys import _col

LOWEST = "0001-01-01 00:00:00"


def top_rank(
    df: DataFrame, keys: list[Column | str], order: list[Column], rank: str = "_rank"
) -> DataFrame:
    """First row per key under a total order.

    Spark ranks within each input partition before the shuffle (WindowGroupLimit), so a hot
    key sends at most one row per input task.
    """
    window = Window.partitionBy(*[_col(key) for key in keys]).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) == 1).drop(rank)


def dedup_latest(
    df: DataFrame, keys: list[Column | str], latest: str, tie_break: list[str]
) -> DataFrame:
    """Keep the row with the highest ``latest`` per key; the tie-break makes it total."""
    if not tie_break:
        raise ValueError("a tie-break column is needed for a repeatable result")
    return top_rank(df, keys, [F.desc_nulls_last(name) for name in [latest, *tie_break]])


def high_water_mark(target: DataFrame, column: str) -> DataFrame:
    """One row with the highest value of a timestamp column, the lowest time if there is none."""
    lowest = F.lit(LOWEST).cast("timestamp")
    return target.agg(F.coalesce(F.max(column).cast("timestamp"), lowest).alias("mark"))


def since_last(
    df: DataFrame, column: str, mark: DataFrame, date_column: str | None = None
) -> DataFrame:
    """Rows above a high-water mark, which is read as a scalar subquery.

    ``date_column`` is a partition column holding the date of ``column``: comparing it too
    lets the scan skip the partitions below the mark.
    """
    new = F.col(column) > mark.scalar()
    if date_column is not None:
        new = new & (F.col(date_column) >= F.to_date(mark.scalar()))
    return df.where(new)
