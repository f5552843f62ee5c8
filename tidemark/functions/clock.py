"""Timestamps, hour keys and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.functions.keys import _col

# The formats of the stored keys and of the payloads.
HOUR_KEY = "yyyyMMddHH"
RUN_ID = "yyyyMMdd_HHmmss"
ISO_TEXT = "yyyy-MM-dd['T'HH:mm[:ss][.SSSSSS][.SSS][XXX]]"


def trunc_hour(ts: Column | str) -> Column:
    return F.date_trunc("hour", _col(ts))


def hour_key(ts: Column | str) -> Column:
    """``2024011512`` for noon on 15 January 2024."""
    return F.date_format(_col(ts), HOUR_KEY)


def hour_text(ts: Column | str) -> Column:
    return F.date_format(_col(ts), "HH")


def key_to_date(key: Column | str) -> Column:
    return F.to_date(F.left(_col(key), F.lit(8)), "yyyyMMdd")


def calendar_parts(ts: Column | str) -> dict[str, Column]:
    """Calendar attributes of an instant. Day 1 is Sunday."""
    ts = _col(ts)
    return {
        "year": F.year(ts).cast("int"),
        "month": F.month(ts).cast("int"),
        "day": F.day(ts).cast("int"),
        "hour": F.hour(ts).cast("int"),
        "day_of_week": F.date_format(ts, "EEEE"),
        "day_of_week_num": F.dayofweek(ts).cast("int"),
        "is_weekend": F.dayofweek(ts).isin(1, 7),
        "quarter": F.quarter(ts).cast("int"),
        "month_name": F.date_format(ts, "MMMM"),
    }


def parse_iso(text: Column | str) -> Column:
    """ISO text with or without seconds and offset; NULL where it is no timestamp."""
    return F.try_to_timestamp(_col(text), F.lit(ISO_TEXT))


def from_epoch_millis(millis: Column | str) -> Column:
    return F.timestamp_millis(_col(millis).cast("bigint"))


def ingest_date(ts: Column | str) -> Column:
    return F.to_date(_col(ts))


def hours_before(ts: Column | str, hours: int) -> Column:
    return _col(ts) - F.make_dt_interval(hours=F.lit(hours))


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Whole minutes, also past one day."""
    return F.timestamp_diff("MINUTE", _col(start), _col(end))


def run_id(ts: Column | str) -> Column:
    return F.date_format(_col(ts), RUN_ID)


def local_to_utc(ts: Column | str, timezone: Column | str) -> Column:
    """Read a wall-clock time as local to ``timezone``.

    The hour repeated in autumn cannot be told apart from its first pass.
    """
    return F.to_utc_timestamp(_col(ts), _col(timezone))


def load_stamp(value=None) -> Column:
    """The given instant, or one ``current_timestamp()`` per query."""
    return F.current_timestamp() if value is None else F.lit(value).cast("timestamp")
