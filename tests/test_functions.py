from __future__ import annotations

import hashlib
from datetime import date, datetime

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.functions import clock, keys, nested, numbers
from tidemark.sources.spine import hour_spine, time_dimension


def one(spark, column, **values):
    frame = spark.range(1).select(*[F.lit(v).alias(n) for n, v in values.items()], F.lit(1))
    return frame.select(column.alias("x")).first()["x"]


def test_surrogate_key_hashes_text_and_keeps_null(spark):
    expected = hashlib.sha256(b"Berlin|2024-01-15 12:00:00").hexdigest()
    got = one(spark, keys.surrogate_key("c", "t"), c="Berlin", t=datetime(2024, 1, 15, 12))
    assert got == expected
    assert one(spark, keys.surrogate_key("c", F.lit(None)), c="Berlin") is None
    assert one(spark, keys.hash_key("c"), c="Rome") == hashlib.sha256(b"Rome").hexdigest()


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-01-15T12:30", datetime(2024, 1, 15, 12, 30)),
        ("2024-01-15T12:30Z", datetime(2024, 1, 15, 12, 30)),
        ("2024-01-15T12:30:10.123+01:00", datetime(2024, 1, 15, 11, 30, 10, 123000)),
        ("2024-01-15", datetime(2024, 1, 15)),
        ("noon", None),
    ],
)
def test_parse_iso(spark, text, expected):
    assert one(spark, clock.parse_iso("t"), t=text) == expected


def test_clock_functions(spark):
    t = datetime(2024, 2, 29, 13, 45, 10)
    assert one(spark, clock.hour_key("t"), t=t) == "2024022913"
    assert one(spark, clock.key_to_date(F.lit("2024022913"))) == date(2024, 2, 29)
    assert one(spark, clock.run_id("t"), t=t) == "20240229_134510"
    assert one(spark, clock.hours_before("t", 2), t=t) == datetime(2024, 2, 29, 11, 45, 10)
    later = F.lit(datetime(2024, 3, 2, 13, 46, 9))
    assert one(spark, clock.minutes_between("t", later), t=t) == 2 * 24 * 60
    assert one(spark, clock.from_epoch_millis(F.lit(1_704_067_200_500))) == datetime(
        2024, 1, 1, 0, 0, 0, 500000
    )


@pytest.mark.parametrize(
    "local, expected",
    [
        (datetime(2024, 7, 1, 12), datetime(2024, 7, 1, 10)),
        (datetime(2024, 3, 31, 2, 30), datetime(2024, 3, 31, 1, 30)),
        (datetime(2024, 10, 27, 2, 30), datetime(2024, 10, 27, 0, 30)),
    ],
)
def test_local_to_utc_at_clock_changes(spark, local, expected):
    assert one(spark, clock.local_to_utc("t", F.lit("Europe/Berlin")), t=local) == expected


def test_spine_covers_every_hour_once(spark):
    spine = hour_spine(spark, datetime(2024, 1, 1), datetime(2025, 12, 31, 23))
    found = spine.agg(
        F.count("*").alias("n"),
        F.count_distinct("full_timestamp").alias("d"),
        F.min("full_timestamp").alias("a"),
        F.max("full_timestamp").alias("b"),
    ).first()
    assert tuple(found) == (17_544, 17_544, datetime(2024, 1, 1), datetime(2025, 12, 31, 23))
    assert hour_spine(spark, datetime(2024, 1, 2), datetime(2024, 1, 1)).count() == 0


def test_time_dimension_parts(spark, rows):
    days = [datetime(2024, 2, 29), datetime(2024, 3, 2), datetime(2024, 3, 3), datetime(2024, 3, 4)]
    dim = time_dimension(spark, datetime(2024, 1, 1), datetime(2024, 12, 31, 23))
    got = dim.where(F.col("full_timestamp").isin(days)).select(
        "time_key", "day_of_week", "day_of_week_num", "is_weekend", "quarter", "month_name"
    )
    assert rows(got) == [
        ("2024022900", "Thursday", 5, False, 1, "February"),
        ("2024030200", "Saturday", 7, True, 1, "March"),
        ("2024030300", "Sunday", 1, True, 1, "March"),
        ("2024030400", "Monday", 2, False, 1, "March"),
    ]


HOURLY = "hourly struct<time: array<string>, a: array<double>, b: array<double>>"


def flattened(spark, rows, data, keep_empty=False):
    df = spark.createDataFrame(data, f"id int, {HOURLY}")
    return rows(nested.flatten_parallel_arrays(df, "hourly", "time", ["a", "b"], keep_empty))


def test_flatten_pads_short_and_cuts_long_arrays(spark, rows):
    data = [(1, (["t0", "t1"], [1.0], [5.0, 6.0, 7.0])), (2, (["t2"], None, [None]))]
    assert flattened(spark, rows, data) == [
        (1, "t0", 1.0, 5.0),
        (1, "t1", None, 6.0),
        (2, "t2", None, None),
    ]


def test_flatten_without_index(spark, rows):
    data = [(1, None), (2, ([], [1.0], [])), (3, (None, None, None)), (4, ([None], [1.0], []))]
    assert flattened(spark, rows, data) == [(4, None, 1.0, None)]
    assert [r[0] for r in flattened(spark, rows, data, keep_empty=True)] == [1, 2, 3, 4]


@settings(max_examples=8, deadline=None)
@given(
    data=st.lists(
        st.tuples(
            st.lists(st.sampled_from(["x", "y"]), max_size=5),
            st.lists(st.one_of(st.none(), st.floats(-5, 5)), max_size=6),
        ),
        min_size=1,
        max_size=6,
    )
)
def test_flatten_gives_one_row_per_index_element(spark, data):
    docs = [(i, (index, values, None)) for i, (index, values) in enumerate(data)]
    df = spark.createDataFrame(docs, f"id int, {HOURLY}")
    flat = nested.flatten_parallel_arrays(df, "hourly", "time", ["a", "b"]).collect()
    expected = [
        (i, t, values[p] if p < len(values) else None, None)
        for i, (index, values) in enumerate(data)
        for p, t in enumerate(index)
    ]
    assert sorted(map(repr, map(tuple, flat))) == sorted(map(repr, expected))


def test_share_of_last_duplicate_wins_and_missing_mix_is_zero(spark, rows):
    mix = "array<struct<fuel: string, perc: double>>"
    df = spark.createDataFrame(
        [(1, [("wind", 1.0), ("coal", 5.0), ("wind", 2.5), ("hydro", 1.0)]), (2, []), (3, None)],
        f"id int, mix {mix}",
    )
    got = df.select("id", nested.share_of("mix", ["wind", "solar", "hydro"]).alias("s"))
    assert rows(got) == [(1, 3.5), (2, 0.0), (3, 0.0)]


def test_last_non_null(spark, rows):
    series = spark.createDataFrame(
        [(1, [[1.0, 5.0], [2.0, None]]), (2, [[1.0, None]]), (3, [])], "id int, s array<array<double>>"
    )
    assert rows(series.select("id", nested.last_non_null_pair("s").alias("p"))) == [
        (1, [1.0, 5.0]),
        (2, None),
        (3, None),
    ]
    flat = spark.createDataFrame(
        [("a", 1, 5.0), ("a", 2, None), ("b", 1, None)], "k string, t int, v double"
    )
    assert rows(nested.last_non_null(flat, ["k"], "t", "v")) == [("a", 1, 5.0), ("b", None, None)]


@settings(max_examples=25, deadline=None)
@given(cents=st.lists(st.integers(-10_000, 10_000), min_size=1, max_size=6))
def test_exact_mean_is_half_up_away_from_zero(spark, cents):
    from decimal import ROUND_HALF_UP, Decimal

    df = spark.createDataFrame([(c / 100,) for c in cents], "v double")
    units = F.sum(numbers.to_units("v", 2))
    got = df.agg(
        numbers.from_units(numbers.mean_units(units, F.count("v"), 2, 2), 2).alias("two"),
        numbers.from_units(numbers.mean_units(units, F.count("v"), 2, 1), 1).alias("one"),
        numbers.from_units(numbers.mean_units(units, F.count("v"), 2, 3), 3).alias("three"),
    ).first()
    exact = Decimal(sum(cents)) / 100 / len(cents)
    for digits, name in [(1, "one"), (2, "two"), (3, "three")]:
        expected = float(exact.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))
        assert got[name] == pytest.approx(expected, abs=1e-9)


def test_band_flag_and_default(spark, rows):
    df = spark.createDataFrame([(1, 5.0), (2, 20.0), (3, None)], "id int, v double")
    got = df.select(
        "id",
        numbers.band([(F.col("v") >= 15, "high"), (F.col("v") < 15, "low")], "unknown").alias("b"),
        numbers.flag(F.col("v") >= 15).alias("f"),
        numbers.null_default("v", -1.0).alias("d"),
    )
    assert rows(got) == [(1, "low", False, 5.0), (2, "high", True, 20.0), (3, "unknown", False, -1.0)]
