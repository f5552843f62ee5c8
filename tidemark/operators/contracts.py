"""Schema contracts on the way in, and data tests on what is stored."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import DataType, StructType

REJECT = "reject_reason"


def _as_struct(schema: StructType | str) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _fits(column: Column, have: DataType, want: DataType) -> Column:
    return column if have == want else column.try_cast(want)


def enforce(
    df: DataFrame, schema: StructType | str, on_error: str = "split", extra: Column | None = None
) -> DataFrame:
    """Cast to the schema and check its types and NOT NULL fields, in one pass.

    ``split`` adds ``reject_reason``, an array that is empty for good rows; ``fail`` raises on
    the first bad row. ``extra`` is a further reason from an earlier step (NULL when sound).
    """
    fields = _as_struct(schema).fields
    have = {f.name: f.dataType for f in df.schema.fields}
    out, reasons = [], [] if extra is None else [extra]
    for f in fields:
        raw = F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType)
        value = _fits(raw, have.get(f.name, f.dataType), f.dataType)
        out.append(value.alias(f.name))
        wrong = F.when(
            raw.isNotNull() & value.isNull(), f"{f.name}: not {f.dataType.simpleString()}"
        )
        if not f.nullable:
            wrong = wrong.when(raw.isNull(), f"{f.name}: null")
        reasons.append(wrong)
    reason = F.array_compact(F.array(*reasons))
    checked = df.select(*out, reason.alias(REJECT))
    if on_error == "split":
        return checked
    if on_error != "fail":
        raise ValueError(f"on_error is 'split' or 'fail', not {on_error!r}")
    text = F.array_join(REJECT, "; ")
    return checked.where(F.assert_true(F.size(REJECT) == 0, text).isNull()).drop(REJECT)


def good_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.size(REJECT) == 0).drop(REJECT)


def rejected_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.size(REJECT) > 0)


def not_null_failures(df: DataFrame, columns: list[str]) -> DataFrame:
    """Failing rows per column, all columns in one pass."""
    counts = df.agg(*[F.count_if(F.isnull(c)).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "failures")


def duplicate_keys(df: DataFrame, keys: list[str], count: str = "cnt") -> DataFrame:
    """Keys that occur more than once; a key with a NULL is not tested."""
    known = df.dropna("any", subset=keys)
    return known.groupBy(*keys).agg(F.count(F.lit(1)).alias(count)).where(F.col(count) > 1)


def unaccepted_values(
    df: DataFrame, column: str, values: list, count: str = "cnt"
) -> DataFrame:
    """Values outside the list with their number of rows; NULL is not tested."""
    return (
        df.where(~F.col(column).isin(values)).groupBy(column).agg(F.count(F.lit(1)).alias(count))
    )


def empty_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """One failure row per table without rows."""
    failures = None
    for name, df in tables.items():
        found = df.agg(F.count(F.lit(1)).alias("cnt")).where("cnt = 0").select(
            F.lit(f"{name} is empty").alias("failure_reason")
        )
        failures = found if failures is None else failures.unionByName(found)
    return failures


def missing_parents(
    fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str
) -> DataFrame:
    """Fact rows whose key is NULL or absent from the dimension, counted per key.

    Counting first leaves one row per key for the join.
    """
    counted = fact.groupBy(F.col(fact_key).alias("fk_value")).agg(F.count(F.lit(1)).alias("cnt"))
    parents = dim.select(F.col(dim_key).alias("fk_value"))
    return counted.join(parents, "fk_value", "left_anti")


def hours_outside(df: DataFrame, column: str, start, end) -> DataFrame:
    """Rows per hour that a time dimension from ``start`` to ``end`` does not cover."""
    hour = F.date_trunc("hour", column)
    inside = hour.between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"))
    return (
        df.where(~inside).groupBy(hour.alias("hour")).agg(F.count(F.lit(1)).alias("cnt"))
    )


@dataclass(frozen=True)
class Contract:
    """Declared tests of one table."""

    not_null: list[str] = field(default_factory=list)
    unique: list[str] = field(default_factory=list)
    accepted: dict[str, list] = field(default_factory=dict)


def _row_checks(contract: Contract) -> dict[tuple[str, str], Column]:
    """Counts of rows that fail a test which looks at one row at a time."""
    checks: dict[tuple[str, str], Column] = {}
    for column in contract.not_null:
        checks["not_null", column] = F.count_if(F.isnull(column))
    for column, values in contract.accepted.items():
        checks["accepted_values", column] = F.count_if(~F.col(column).isin(values))
    return checks


class Watch:
    """Counts the failures of a contract while a table is written, instead of reading it again.

    ``over`` wraps the rows that are written, once; ``results`` has what ``run_contract`` would find, and ``rows``
    their number, after the write. Only keys that must be unique are read from what was stored.
    """

    def __init__(self, name: str, contract: Contract):
        self.name, self.contract, self.seen = name, contract, Observation()

    def over(self, df: DataFrame) -> DataFrame:
        counts = [c.alias(":".join(check)) for check, c in _row_checks(self.contract).items()]
        return df.observe(self.seen, F.count(F.lit(1)).alias("rows"), *counts)

    @property
    def rows(self) -> int:
        return self.seen.get["rows"]

    def results(self, stored: DataFrame) -> DataFrame:
        counts = self.seen.get
        found = [(self.name, *check, counts[":".join(check)]) for check in _row_checks(self.contract)]
        schema = "table_name string not null, test string, column_name string, failures bigint"
        result = stored.sparkSession.createDataFrame(found, schema)
        if self.contract.unique:
            keys = run_contract(self.name, stored, Contract(unique=self.contract.unique))
            result = result.unionByName(keys)
        return result


def run_contract(name: str, df: DataFrame, contract: Contract) -> DataFrame:
    """One row per declared test: table, test, column and number of failures.

    NOT NULL and accepted values share one scan; each unique test counts its keys.
    """
    checks = _row_checks(contract)
    frames = []
    if checks:
        names = [f"{test}:{column}" for test, column in checks]
        counts = df.agg(*[c.alias(n) for c, n in zip(checks.values(), names)])
        rows = counts.unpivot([], names, "_check", "failures")
        test = F.split_part("_check", F.lit(":"), F.lit(1))
        column = F.split_part("_check", F.lit(":"), F.lit(2))
        frames.append(rows.select(test.alias("test"), column.alias("column_name"), "failures"))
    for column in contract.unique:
        frames.append(
            duplicate_keys(df, [column])
            .agg(F.count(F.lit(1)).alias("failures"))
            .select(F.lit("unique").alias("test"), F.lit(column).alias("column_name"), "failures")
        )
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result.select(F.lit(name).alias("table_name"), "*")
