from __future__ import annotations

from datetime import datetime

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.operators import audit, contracts, rollup, scd
from tidemark.operators.contracts import Contract, good_rows, rejected_rows
from tidemark.operators.dedup import dedup_latest, high_water_mark, since_last
from tidemark.operators.upsert import evolve_schema, upsert

DAY = [datetime(2024, 1, d) for d in range(1, 29)]


def small(max_size=8):
    row = st.tuples(st.integers(0, 3), st.integers(0, 4), st.integers(0, 9))
    return st.lists(row, max_size=max_size)


# --- latest row per key ------------------------------------------------------------------


def test_dedup_needs_a_tie_break(spark):
    with pytest.raises(ValueError):
        dedup_latest(spark.range(1), ["id"], "id", [])


@settings(max_examples=10, deadline=None)
@given(data=small(12))
def test_dedup_keeps_the_highest_row_per_key(spark, data):
    df = spark.createDataFrame(data, "k int, at int, v int")
    got = {tuple(r) for r in dedup_latest(df, ["k"], "at", ["v"]).collect()}
    expected = {max((r for r in data if r[0] == k), key=lambda r: r[1:]) for k, _, _ in data}
    assert got == expected


def test_since_last(spark, rows):
    df = spark.createDataFrame([(i, DAY[i]) for i in range(4)], "id int, at timestamp")
    mark = high_water_mark(df.where("id <= 1"), "at")
    assert rows(mark) == [(DAY[1],)]
    assert rows(since_last(df, "at", mark), "id") == [(2,), (3,)]
    assert len(rows(since_last(df, "at", high_water_mark(df.limit(0), "at")))) == 4
    dated = df.withColumn("day", F.to_date("at"))
    assert rows(since_last(dated, "at", mark, "day"), "id") == [(2,), (3,)]


# --- upsert ------------------------------------------------------------------------------

PAIR = "k int, v int"


def pairs(spark, data):
    return spark.createDataFrame(data, PAIR)


def test_upsert_updates_and_inserts(spark, rows):
    got = upsert(pairs(spark, [(1, 1), (2, 2)]), pairs(spark, [(2, 20), (3, 30)]), ["k"])
    assert rows(got) == [(1, 1), (2, 20), (3, 30)]


def test_upsert_refuses_a_key_twice_unless_told_which_is_later(spark, rows):
    source = pairs(spark, [(2, 20), (2, 21)])
    with pytest.raises(Exception, match="duplicate key"):
        upsert(pairs(spark, [(1, 1)]), source, ["k"]).collect()
    assert rows(upsert(pairs(spark, [(2, 2)]), source, ["k"], "v", ["k"])) == [(2, 21)]


def test_upsert_null_keys_match_nothing(spark, rows):
    got = upsert(pairs(spark, [(None, 1)]), pairs(spark, [(None, 2), (None, 3)]), ["k"])
    assert rows(got) == [(None, 1), (None, 2), (None, 3)]


@settings(max_examples=10, deadline=None)
@given(
    before=st.dictionaries(st.integers(0, 6), st.integers(0, 9), max_size=5),
    after=st.dictionaries(st.integers(0, 6), st.integers(10, 19), max_size=5),
)
def test_upsert_twice_is_once(spark, before, after):
    target, source = pairs(spark, list(before.items())), pairs(spark, list(after.items()))
    once = upsert(target, source, ["k"])
    got = sorted(map(tuple, once.collect()))
    assert got == sorted((before | after).items())
    assert sorted(map(tuple, upsert(once, source, ["k"]).collect())) == got


def test_evolve_schema_adds_and_drops(spark, rows):
    target = spark.createDataFrame([(1, "a")], "k int, gone string")
    source = spark.createDataFrame([(2, 0.5)], "k int, fresh double")
    assert evolve_schema(target, source).dtypes == source.dtypes
    assert rows(upsert(target, source, ["k"])) == [(1, None), (2, 0.5)]


# --- history -----------------------------------------------------------------------------

PLACE = "city string, country string, zone string"


def places(spark, *data):
    return spark.createDataFrame(list(data), PLACE)


def advance(history, current, at):
    return scd.scd2(history, current, "city", ["zone"], at)


def intervals(df):
    picked = df.select("city", "zone", "valid_from", "valid_to", "is_current")
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def test_scd2_changes_new_gone_and_unchanged_keys(spark):
    first = scd.first_versions(
        places(spark, ("a", "x", "1"), ("b", "x", "1"), ("c", "x", "1"), ("d", "x", None)),
        "city",
        DAY[0],
    )
    second = advance(
        first,
        places(spark, ("a", "x", "2"), ("b", "other", "1"), ("d", "x", "1"), ("e", "x", "1")),
        DAY[1],
    )
    assert intervals(second) == sorted(
        [
            ("a", "1", DAY[0], DAY[1], False),
            ("a", "2", DAY[1], None, True),
            ("b", "1", DAY[0], None, True),  # an unchecked column makes no version
            ("c", "1", DAY[0], None, True),  # a key that is gone stays open
            ("d", None, DAY[0], DAY[1], False),  # NULL to value is a change
            ("d", "1", DAY[1], None, True),
            ("e", "1", DAY[1], None, True),
        ],
        key=repr,
    )
    assert second.select("scd_id").distinct().count() == second.count()
    again = advance(second, places(spark, ("a", "x", "2"), ("c", "x", "1")), DAY[2])
    assert intervals(again) == intervals(second)
    country = {r["city"]: r["country"] for r in second.where("is_current").collect()}
    assert country["b"] == "x"


def test_scd2_refuses_a_change_that_is_not_later(spark):
    first = scd.first_versions(places(spark, ("a", "x", "1")), "city", DAY[3])
    with pytest.raises(Exception, match="must be later"):
        advance(first, places(spark, ("a", "x", "2")), DAY[3]).collect()


@settings(max_examples=5, deadline=None)
@given(states=st.lists(st.dictionaries(st.sampled_from("abc"), st.sampled_from("12"), min_size=1), min_size=2, max_size=3))
def test_scd2_has_one_open_version_and_no_overlap(spark, states):
    frames = [places(spark, *[(c, "x", z) for c, z in s.items()]) for s in states]
    history = scd.first_versions(frames[0], "city", DAY[0])
    for i, frame in enumerate(frames[1:], 1):
        history = advance(history, frame, DAY[i])
    by_city = {}
    for row in history.collect():
        by_city.setdefault(row["city"], []).append((row["valid_from"], row["valid_to"], row["zone"]))
    last = {}
    for state in states:
        last |= state
    assert set(by_city) == set(last)
    for city, versions in by_city.items():
        versions.sort(key=lambda v: v[0])
        assert [v[1] for v in versions[:-1]] == [v[0] for v in versions[1:]]
        assert versions[-1][1] is None and versions[-1][2] == last[city]


def test_current_versions_and_versions_at(spark, rows):
    history = advance(
        scd.first_versions(places(spark, ("a", "x", "1")), "city", DAY[0]),
        places(spark, ("a", "x", "2")),
        DAY[5],
    )
    assert rows(scd.current_versions(history, "city", "key"), "city", "zone") == [("a", "2")]
    for at, zone in [(DAY[0], "1"), (DAY[4], "1"), (DAY[5], "2"), (DAY[9], "2")]:
        assert rows(scd.versions_at(history, at), "zone") == [(zone,)]


@settings(max_examples=10, deadline=None)
@given(
    starts=st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 200)), max_size=10, unique=True),
    asked=st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 260)), min_size=1, max_size=12),
    last_closes=st.booleans(),
)
def test_as_of_version_equals_brute_force(spark, starts, asked, last_closes):
    def at(hour):
        return datetime(2024, 1, 1 + hour // 24, hour % 24)

    versions = []
    for key in "ab":
        hours = sorted(h for k, h in starts if k == key)
        for here, after in zip(hours, [*hours[1:], 230 if last_closes else None]):
            versions.append((key, at(here), None if after is None else at(after), f"{key}{here}"))
    facts = [(i, key, at(h)) for i, (key, h) in enumerate(asked)]
    history = spark.createDataFrame(
        versions, "k string, valid_from timestamp, valid_to timestamp, name string"
    )
    df = spark.createDataFrame(facts, "id int, k string, at timestamp")
    got = scd.as_of_version(df, history, "k", "at", ["name"]).select("id", "name").collect()
    expected = []
    for i, key, t in facts:
        hits = [n for k, f, e, n in versions if k == key and f <= t and (e is None or t < e)]
        expected.append((i, hits[0] if hits else None))
    assert sorted(map(tuple, got)) == sorted(expected)


# --- contracts ---------------------------------------------------------------------------

SCHEMA = "id int not null, v double, at timestamp not null"


def loose(spark):
    return spark.createDataFrame(
        [("1", "0.5", "2024-01-01"), ("x", "y", "2024-01-01"), (None, None, None)],
        "id string, v string, at string",
    )


def test_enforce_splits_good_and_rejected(spark, rows):
    checked = contracts.enforce(loose(spark), SCHEMA)
    assert rows(good_rows(checked)) == [(1, 0.5, datetime(2024, 1, 1))]
    assert rows(rejected_rows(checked), "reject_reason") == [
        (["id: not int", "v: not double"],),
        (["id: null", "at: null"],),
    ]


def test_enforce_fails_on_the_first_bad_row(spark):
    with pytest.raises(Exception, match="id: not int"):
        contracts.enforce(loose(spark).where("id = 'x'"), SCHEMA, on_error="fail").collect()
    with pytest.raises(ValueError):
        contracts.enforce(loose(spark), SCHEMA, on_error="ignore")


def test_enforce_treats_an_absent_column_as_null(spark, rows):
    checked = contracts.enforce(spark.range(1).select(F.lit(1).alias("id")), SCHEMA)
    assert rows(checked, "reject_reason") == [(["at: null"],)]


def test_data_tests(spark, rows):
    df = spark.createDataFrame(
        [(1, "a"), (1, "b"), (2, None), (None, "z"), (None, "z")], "k int, c string"
    )
    assert rows(contracts.not_null_failures(df, ["k", "c"])) == [("c", 1), ("k", 2)]
    assert rows(contracts.duplicate_keys(df, ["k"])) == [(1, 2)]
    assert rows(contracts.unaccepted_values(df, "c", ["a", "b"])) == [("z", 2)]
    tables = {"full": df, "none": df.where("false")}
    assert rows(contracts.empty_tables(tables)) == [("none is empty",)]
    parents = spark.createDataFrame([(1,)], "id int")
    assert rows(contracts.missing_parents(df, "k", parents, "id")) == [(2, 1), (None, 2)]
    declared = Contract(not_null=["k"], unique=["k"], accepted={"c": ["a", "b", "z"]})
    assert rows(contracts.run_contract("t", df, declared)) == [
        ("t", "accepted_values", "c", 0),
        ("t", "not_null", "k", 2),
        ("t", "unique", "k", 1),
    ]


def test_hours_outside_a_spine(spark, rows):
    df = spark.createDataFrame([(datetime(2023, 12, 31, 23, 59),), (DAY[0],)], "at timestamp")
    found = contracts.hours_outside(df, "at", DAY[0], DAY[9])
    assert rows(found) == [(datetime(2023, 12, 31, 23), 1)]


# --- audit and run log -------------------------------------------------------------------


def test_audit_lists_every_unit_and_a_total(spark, rows):
    roster = spark.createDataFrame([("s", "a"), ("s", "b"), ("s", "c")], "source string, city string")
    good = spark.createDataFrame([("s", "a"), ("s", "a"), ("s", "z")], "source string, city string")
    bad = spark.createDataFrame(
        [("s", "b", "broken"), ("s", "a", "one bad row")],
        "source string, city string, error_message string",
    )
    outcomes = audit.unit_outcomes(roster, good, bad, F.lit(DAY[0]))
    all_rows = audit.audit_rows(outcomes, "ALL", "s")
    assert rows(all_rows.drop("ingested_at")) == [
        ("s", "ALL", 3, "SUCCESS", None),
        ("s", "a", 2, "SUCCESS", "one bad row"),
        ("s", "b", 0, "FAILED", "broken"),
        ("s", "c", 0, "FAILED", "no rows"),
        ("s", "z", 1, "SUCCESS", None),
    ]
    failed = audit.audit_rows(outcomes, "ALL", "s", failures_only=True)
    assert rows(failed, "city") == [("ALL",), ("b",), ("c",)]


def log(spark, *data):
    return spark.createDataFrame(list(data), audit.RUN_LOG_SCHEMA)


def test_guard_looks_at_the_latest_status(spark, rows):
    t = [datetime(2024, 1, 1, h) for h in range(13)]
    entries = log(
        spark,
        ("done", t[11], None, "RUNNING", None),
        ("done", t[11], t[11], "SUCCESS", None),
        ("stale", t[9], None, "RUNNING", None),
        ("live", t[11], None, "RUNNING", None),
    )
    now = F.lit(t[12])
    assert rows(audit.active_runs(entries, now), "run_id") == [("live",)]
    cleared = audit.cleared(entries, F.lit("live"), now)
    assert rows(cleared, "run_id", "status", "error") == [("live", "FAILED", "Manually cleared")]
    assert rows(audit.active_runs(entries.unionByName(cleared), now)) == []
    assert not audit.is_running(spark, "no_such_log", now)


# --- roll-ups ----------------------------------------------------------------------------


def test_rollup_keeps_unmatched_rows_and_skips_nulls(spark, rows):
    fact = spark.createDataFrame(
        [("k1", 1.0), ("k1", 2.02), ("k2", None), ("k9", 5.0), (None, 7.0)], "key string, v double"
    )
    dim = spark.createDataFrame([("k1", "a"), ("k2", "b")], "key string, name string")
    measures = [
        rollup.Measure("mean", "avg", "v"),
        rollup.Measure("total", "sum", "v"),
        rollup.Measure("low", "min", "v"),
        rollup.Measure("high", "max", "v"),
        rollup.Measure("n", "count"),
        rollup.Measure("missing", "count_null", "v"),
    ]
    expected = [
        ("a", 1.51, 3.02, 1.0, 2.02, 2, 0),
        ("b", None, None, None, None, 1, 1),
        (None, 6.0, 12.0, 5.0, 7.0, 2, 0),
    ]
    for scale in (None, 2):
        got = rollup.rollup(fact, ["key"], [(dim, ["key"])], ["name"], measures, scale)
        assert rows(got) == expected


@settings(max_examples=10, deadline=None)
@given(data=st.lists(st.tuples(st.integers(0, 2), st.sampled_from(["x", "y", None])), min_size=1, max_size=12))
def test_dominant_category_and_its_single_pass_form(spark, data):
    df = spark.createDataFrame(data, "k int, c string")
    expected = {}
    for key in {k for k, _ in data}:
        found = [c for k, c in data if k == key]
        expected[key] = min(set(found), key=lambda c: (-found.count(c), c is None, c or ""))
    windowed = {r["k"]: r["c"] for r in rollup.dominant(df, ["k"], "c").collect()}
    counted = rollup.category_count(df, ["k"], "c")
    single = counted.groupBy("k").agg(rollup.dominant_of_counts("c", "cnt").alias("c"))
    assert windowed == expected
    assert {r["k"]: r["c"] for r in single.collect()} == expected


def test_recent_rows_and_unions(spark, rows):
    df = spark.createDataFrame([(i, DAY[i]) for i in range(5)], "id int, at timestamp")
    assert [r["id"] for r in rollup.most_recent(df, "at", 2, ["id"]).collect()] == [4, 3]
    other = spark.createDataFrame([(9, "x")], "id int, extra string")
    merged = rollup.union_sources(df.where("id = 0"), other)
    assert rows(merged) == [(0, DAY[0], None), (9, None, "x")]
    assert rows(rollup.layer_counts({"a": df, "b": other})) == [("a", 5), ("b", 1)]
