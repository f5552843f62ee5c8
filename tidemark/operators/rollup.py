"""Star roll-ups, counts, the dominant category and recent-row reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.numbers import from_units, mean_units, to_units
from tidemark.operators.dedup import top_rank


@dataclass(frozen=True)
class Measure:
    """One output column: ``kind`` is avg, sum, min, max, count or count_null."""

    name: str
    kind: str
    column: str | None = None
    digits: int = 2


def _states(measures: list[Measure], exact: int | None) -> dict[str, tuple[Column, str]]:
    """Mergeable state columns: name -> (first aggregate, function that merges it)."""
    states: dict[str, tuple[Column, str]] = {}
    for m in measures:
        if m.kind in ("avg", "sum") and f"_sum_{m.column}" not in states:
            value = F.col(m.column) if exact is None else to_units(m.column, exact)
            states[f"_sum_{m.column}"] = (F.sum(value), "sum")
        if m.kind == "avg":
            states[f"_n_{m.column}"] = (F.count(m.column), "sum")
        elif m.kind in ("min", "max"):
            states[f"_{m.kind}_{m.column}"] = (getattr(F, m.kind)(m.column), m.kind)
        elif m.kind == "count":
            states["_rows"] = (F.count(F.lit(1)), "sum")
        elif m.kind == "count_null":
            states[f"_null_{m.column}"] = (F.count_if(F.isnull(m.column)), "sum")
    return states


def _result(m: Measure, exact: int | None) -> Column:
    if m.kind == "count":
        return F.col("_rows").alias(m.name)
    if m.kind == "count_null":
        return F.col(f"_null_{m.column}").alias(m.name)
    if m.kind in ("min", "max"):
        return F.round(f"_{m.kind}_{m.column}", m.digits).alias(m.name)
    total = F.col(f"_sum_{m.column}")
    if m.kind == "sum":
        value = F.round(total, m.digits) if exact is None else from_units(total, exact)
        return value.alias(m.name)
    count = F.col(f"_n_{m.column}")
    if exact is None:
        return F.round(total / F.nullif(count, F.lit(0)), m.digits).alias(m.name)
    return from_units(mean_units(total, count, exact, m.digits), m.digits).alias(m.name)


class Partial:
    """Sums, counts and extremes of one grouping that can be merged into coarser groupings."""

    def __init__(
        self, df: DataFrame, measures: list[Measure], exact_scale: int | None, how: dict[str, str]
    ):
        self.df, self.measures, self.exact_scale, self.how = df, measures, exact_scale, how

    @classmethod
    def of(
        cls,
        fact: DataFrame,
        keys: list[Column | str],
        measures: list[Measure],
        exact_scale: int | None = None,
    ) -> Partial:
        states = _states(measures, exact_scale)
        grouped = fact.groupBy(*keys).agg(*[first.alias(n) for n, (first, _) in states.items()])
        return cls(grouped, measures, exact_scale, {n: how for n, (_, how) in states.items()})

    @classmethod
    def stored(
        cls, states: DataFrame, measures: list[Measure], exact_scale: int | None = None
    ) -> Partial:
        """States that were grouped before, for these and perhaps further measures."""
        how = {n: how for n, (_, how) in _states(measures, exact_scale).items()}
        return cls(states, measures, exact_scale, how)

    def _with(self, df: DataFrame) -> Partial:
        return Partial(df, self.measures, self.exact_scale, self.how)

    def lookup(self, dim: DataFrame, on: list[str] | Column) -> Partial:
        """Left join a dimension with unique keys to the groups, not to the fact rows."""
        return self._with(self.df.join(dim, on, "left"))

    def merge_aggregates(self) -> list[Column]:
        return [getattr(F, how)(name).alias(name) for name, how in self.how.items()]

    def merge(self, keys: list[str], *extra: Column) -> Partial:
        """Regroup more coarsely; ``extra`` are further aggregates over the old groups."""
        return self._with(self.df.groupBy(*keys).agg(*self.merge_aggregates(), *extra))

    def result(self, *keys: Column | str) -> DataFrame:
        return self.df.select(*keys, *[_result(m, self.exact_scale) for m in self.measures])


def rollup(
    fact: DataFrame,
    fact_keys: list[Column | str],
    dims: list[tuple[DataFrame, list[str]]],
    keys: list[str],
    measures: list[Measure],
    exact_scale: int | None = None,
) -> DataFrame:
    """Roll a fact up to dimension attributes.

    The fact is grouped by its own foreign keys first, so the joins see one row per group and
    a hot key is already reduced when it is shuffled. ``exact_scale`` adds whole units of
    10^-scale, which makes the result independent of the order of addition.
    """
    partial = Partial.of(fact, fact_keys, measures, exact_scale)
    for dim, on in dims:
        partial = partial.lookup(dim, on)
    return partial.merge(keys).result(*keys)


def category_count(df: DataFrame, keys: list[str], category: str, name: str = "cnt") -> DataFrame:
    return df.groupBy(*keys, category).agg(F.count(F.lit(1)).alias(name))


def dominant(df: DataFrame, keys: list[str], category: str, count: str = "cnt") -> DataFrame:
    """Most frequent category per key. NULL is a category; ties go to the lowest name."""
    counted = category_count(df, keys, category, count)
    return top_rank(counted, keys, [F.desc(count), F.asc_nulls_last(category)])


def dominant_of_counts(category: str, count: str) -> Column:
    """The same choice as an aggregate over rows that are already counted per category."""
    return F.min_by(category, F.struct(-F.col(count), F.isnull(category), F.col(category)))


def row_count(df: DataFrame, name: str = "cnt") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """One row per layer with its row count."""
    counts = [
        row_count(df, "rows").select(F.lit(name).alias("layer"), "rows")
        for name, df in layers.items()
    ]
    result = counts[0]
    for each in counts[1:]:
        result = result.unionByName(each)
    return result


def most_recent(df: DataFrame, by: str, n: int, tie_break: list[str]) -> DataFrame:
    """The n latest rows of a log."""
    return df.orderBy(F.desc_nulls_last(by), *[F.asc_nulls_last(c) for c in tie_break]).limit(n)


def union_sources(*frames: DataFrame) -> DataFrame:
    """Rows of several sources under one schema; absent columns are NULL."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result
