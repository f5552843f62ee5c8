"""Arrays, maps and structs from parsed payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.keys import _col


def flatten_parallel_arrays(
    df: DataFrame,
    struct_col: str,
    index_col: str,
    value_cols: list[str],
    keep_empty: bool = False,
) -> DataFrame:
    """One row per element of the index array, with the values at the same position.

    Short value arrays give NULL; values past the end of the index array are dropped. A
    document without index elements gives no row, or with ``keep_empty`` one row of NULLs.
    """
    index = F.col(f"{struct_col}.{index_col}")

    def fitted(name: str) -> Column:
        # An absent array would null the whole zip, a long one would add rows.
        value = F.slice(F.col(f"{struct_col}.{name}"), F.lit(1), F.size(index))
        return F.coalesce(value, F.array()).alias(name)

    zipped = F.arrays_zip(index.alias(index_col), *[fitted(name) for name in value_cols])
    rows = F.when(F.size(index) > 0, zipped)
    others = [name for name in df.columns if name != struct_col]
    expand = F.inline_outer if keep_empty else F.inline
    return df.select(*others, expand(rows)).toDF(*others, index_col, *value_cols)


def first_element(array: Column | str) -> Column:
    return F.get(_col(array), F.lit(0))


def last_element(array: Column | str) -> Column:
    return F.try_element_at(_col(array), F.lit(-1))


def lookup(entries: Column | str) -> Column:
    """Map from a list of (key, value) structs; the last duplicate key counts."""
    return F.map_from_entries(_col(entries))


def share_of(entries: Column | str, keys: list[str]) -> Column:
    """Sum of the listed keys' values, absent keys as zero, added in the listed order."""
    table = F.coalesce(lookup(entries), F.create_map().cast("map<string,double>"))
    return F.aggregate(
        F.array(*[F.lit(key) for key in keys]),
        F.lit(0.0),
        lambda total, key: total + F.coalesce(F.try_element_at(table, key), F.lit(0.0)),
    )


def last_non_null_pair(series: Column | str) -> Column:
    """Last [position, value] pair that has a value; NULL if there is none."""
    return last_element(F.filter(_col(series), lambda pair: F.get(pair, F.lit(1)).isNotNull()))


def last_non_null(
    df: DataFrame, keys: list[str], order_col: str, value_col: str
) -> DataFrame:
    """Last (position, value) with a value per key, NULLs where a key has none."""
    position = F.when(F.col(value_col).isNotNull(), F.col(order_col))
    last = F.max_by(F.struct(order_col, value_col), position).alias("_last")
    return df.groupBy(*keys).agg(last).select(*keys, f"_last.{order_col}", f"_last.{value_col}")


def json_text(payload: Column | str, path: str, default=None) -> Column:
    """Text at a JSON path, or the default where it is absent."""
    value = F.get_json_object(_col(payload), path)
    return value if default is None else F.coalesce(value, F.lit(default))
