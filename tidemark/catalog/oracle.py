"""The same queries in SQL for an independent engine (DuckDB dialect)."""

from __future__ import annotations

from tidemark.catalog.queries import EVENT_WEIGHTS
from tidemark.sources import fixed

LOADED = "timestamp '2024-03-01 00:00:00'"
NOW = "timestamp '2024-01-20 12:00:00'"
INGESTED = "timestamp '2024-02-01 00:00:00'"
DAY = "date '2024-01-10'"


def values(rows: list[tuple]) -> str:
    return "values " + ", ".join(str(row) for row in rows)


# --- common tables -----------------------------------------------------------------------

COMMON = {
    "ev": "select *, cast(json_extract_string(props, '$.k') as integer) as k from events",
    "bw": """
        select cast(user_id as varchar) as city,
               'C' || cast(length(event_type) as varchar) as country,
               cast(user_id as double) as latitude, cast(k as double) as longitude,
               'UTC' as timezone, ts as hour, value as temperature_2m,
               cast(k as double) as windspeed_10m, k as weathercode, value as precipitation,
               ts as ingested_at, cast(ts as date) as ingested_date, event_type as source
        from ev where event_type <> 'purchase'""",
    "reg": """
        select cast(c_custkey as varchar) as city, n_name as country, c_acctbal as latitude,
               cast(c_nationkey as double) as longitude, c_mktsegment as timezone,
               r_name as electricity_zone
        from customer join nation on c_nationkey = n_nationkey
        join region on n_regionkey = r_regionkey""",
    "be": """
        select electricity_zone as zone, country, city, value as carbon_intensity,
               cast(100 - k as double) as fossil_free_pct, cast(k as double) as renewable_pct,
               value as day_ahead_price_eur_mwh, ts as measurement_at, ts as ingested_at,
               cast(ts as date) as ingested_date, event_type as source
        from ev join reg on city = cast(user_id as varchar) where event_type = 'purchase'""",
    "sw": f"""
        select sha256(city || '|' || cast(date_trunc('hour', hour) as varchar)) as weather_id,
               city, country, latitude, longitude, timezone,
               date_trunc('hour', hour) as observation_hour, temperature_2m, windspeed_10m,
               weathercode, precipitation, source as _source, ingested_at as _ingested_at,
               {LOADED} as _loaded_at
        from (select *, row_number() over (
                partition by city, cast(hour as date), strftime(hour, '%H')
                order by ingested_at desc) as rn from bw) where rn = 1""",
    "se": f"""
        select sha256(zone || '|' || cast(ingested_at as varchar)) as energy_id, zone, country,
               city, carbon_intensity as carbon_intensity_gco2eq, fossil_free_pct,
               renewable_pct, day_ahead_price_eur_mwh,
               date_trunc('hour', measurement_at) as measurement_hour, source as _source,
               ingested_at as _ingested_at, {LOADED} as _loaded_at
        from (select *, row_number() over (
                partition by zone, date_trunc('hour', measurement_at)
                order by ingested_at desc, country desc, city desc) as rn from be)
        where rn = 1""",
    "loc": "select sha256(city) as location_key, * from reg",
    "dt": """
        select strftime(h, '%Y%m%d%H') as time_key, h as full_timestamp,
               cast(year(h) as integer) as year, cast(month(h) as integer) as month,
               cast(day(h) as integer) as day, cast(hour(h) as integer) as hour,
               dayname(h) as day_of_week, cast(dayofweek(h) + 1 as integer) as day_of_week_num,
               dayofweek(h) in (0, 6) as is_weekend, cast(quarter(h) as integer) as quarter,
               monthname(h) as month_name
        from (select unnest(generate_series(timestamp '2024-01-01 00:00:00',
              timestamp '2025-12-31 23:00:00', interval 1 hour)) as h)""",
    "wc": f"""
        select * from ({values(fixed.WEATHER_CODES)})
        as t(weathercode, condition_label, condition_category, severity)""",
    "fact": f"""
        select sha256(w.city || '|' || cast(w.observation_hour as varchar)) as fact_id,
               l.location_key, t.time_key, w.weathercode as weathercode_key, w.temperature_2m,
               w.windspeed_10m, w.precipitation, e.carbon_intensity_gco2eq as carbon_intensity,
               e.fossil_free_pct, e.renewable_pct, e.day_ahead_price_eur_mwh,
               w._ingested_at as weather_ingested_at, e._ingested_at as energy_ingested_at,
               {LOADED} as _loaded_at
        from sw w join loc l on w.city = l.city
        left join dt t on strftime(w.observation_hour, '%Y%m%d%H') = t.time_key
        left join se e on l.electricity_zone = e.zone
                      and w.observation_hour = e.measurement_hour""",
    "star": """
        select f.*, l.city, l.country, t.year, t.month, t.month_name, c.condition_category
        from fact f left join loc l on f.location_key = l.location_key
        left join dt t on f.time_key = t.time_key
        left join wc c on f.weathercode_key = c.weathercode""",
    "runs": """
        select cast(user_id as varchar) || '_' || strftime(min(ts), '%Y%m%d_%H%M%S') as run_id,
               min(ts) as started_at, max(ts) as ended_at, count(*) as n, max(k) as k
        from ev group by user_id, cast(ts as date)""",
    "log": """
        select run_id, started_at, cast(null as timestamp) as ended_at, 'RUNNING' as status,
               cast(null as varchar) as error from runs
        union all
        select run_id, started_at, ended_at, case when k < 50 then 'FAILED' else 'SUCCESS' end,
               case when k < 50 then 'low' end from runs where n > 1""",
    "before": """
        select city, country, latitude, longitude,
               case when latitude < 0 then 'EARLIER' else timezone end as timezone,
               electricity_zone from reg where country <> 'NATION_3'""",
    "after": "select * from reg where country <> 'NATION_5'",
    "cmp": """
        select coalesce(b.city, a.city) as city, b.city is not null as had,
               a.city is not null as has,
               (a.latitude, a.longitude, a.timezone, a.electricity_zone) is distinct from
               (b.latitude, b.longitude, b.timezone, b.electricity_zone) as differs
        from before b full join after a on a.city = b.city""",
    "hist": """
        select b.*, timestamp '2024-01-01' as valid_from,
               case when has and differs then timestamp '2024-01-15' end as valid_to,
               not (has and differs) as is_current,
               case when has and differs then timestamp '2024-01-15'
                    else timestamp '2024-01-01' end as updated_at,
               sha256(b.city || '|2024-01-01 00:00:00') as scd_id
        from before b join cmp on cmp.city = b.city
        union all
        select a.*, timestamp '2024-01-15', null, true, timestamp '2024-01-15',
               sha256(a.city || '|2024-01-15 00:00:00')
        from after a join cmp on cmp.city = a.city where not had or differs""",
    "dated": """
        select event_id, event_type, value, cast(ts as date) as ingested_date from events""",
    "fixed": f"""
        select event_id, event_type, value + 1 as value, ingested_date from dated
        where ingested_date = {DAY} and event_type <> 'error'""",
    "units": """
        select city, count(*) filter (k >= 60) as row_count,
               'code ' || min(case when k < 60 then lpad(cast(k as varchar), 2, '0') end) as err
        from (select city, k from reg left join ev on city = cast(user_id as varchar))
        group by city""",
    "outcomes": f"""
        select 'events' as source, city, row_count, {INGESTED} as ingested_at,
               case when row_count = 0 then 'FAILED' else 'SUCCESS' end as status,
               coalesce(err, case when row_count = 0 then 'no rows' end) as error_message
        from units""",
    "docs": """
        select event_id, cast(user_id as varchar) as city, ts as ingested_at, k, value,
               epoch_ms(date_trunc('hour', ts)) as h from ev""",
    "idx": """
        select *, case k % 4 when 1 then h - 7200000 when 2 then h - 3600000 when 3 then h end
               as chunk_ts from docs""",
    "chunk": """
        select city, h, epoch_us(ingested_at) // 1000 as at_ms, case when k >= 10 then value end as price
        from (select *, row_number() over (partition by city, h
              order by ingested_at desc, event_id desc) as rn from docs) where rn = 1""",
    "raw": """
        select case when k <> 50 then event_id end as event_id, cast(user_id as varchar) as city,
               case when k >= 10 then value end as value, case when k <> 7 then ts end as ts, k
        from ev""",
}


def sql(body: str, *names: str) -> str:
    """A query with the common tables it needs, in their order of definition."""
    if not names:
        return body
    wanted = set(names)
    for name in reversed(COMMON):
        if name in wanted:
            wanted |= {other for other in COMMON if _mentions(COMMON[name], other)}
    tables = ", ".join(f'"{n}" as ({COMMON[n]})' for n in COMMON if n in wanted)
    return f"with {tables} {body}"


def _mentions(text: str, name: str) -> bool:
    words = text.replace("(", " ").replace(")", " ").replace(",", " ").split()
    return any(a in ("from", "join") and b == name for a, b in zip(words, words[1:]))


def mean(column: str, digits: int = 2) -> str:
    """Half-up mean of hundredths, in whole numbers."""
    total = f"cast(sum(cast(round({column} * 100) as bigint)) as bigint) * {10 ** (digits - 2)}"
    n = f"count({column})"
    return f"((2 * {total} + {n}) // nullif(2 * {n}, 0)) / cast({10 ** digits} as double)"


def total(column: str) -> str:
    return f"cast(sum(cast(round({column} * 100) as bigint)) as bigint) / cast(100 as double)"


MONTHLY = f"""
    {mean('temperature_2m')} as avg_temp_c, max(temperature_2m) as max_temp_c,
    min(temperature_2m) as min_temp_c, {mean('carbon_intensity')} as avg_carbon_intensity,
    {mean('renewable_pct')} as avg_renewable_pct, {mean('fossil_free_pct')} as avg_fossil_free_pct,
    {mean('precipitation', 3)} as avg_hourly_precipitation, count(*) as reading_count"""

MODES = """
    select city, year, month, condition_category, cnt from (
        select *, row_number() over (partition by city, year, month
                  order by cnt desc, condition_category asc nulls last) as rn
        from (select city, year, month, condition_category, count(*) as cnt
              from star group by all)) where rn = 1"""

# The report's definition, stated here as its specification. Labels and thresholds.
PROFILE = """
    case when {t} >= 15 and {c} <= 200 then 'warm_clean'
         when {t} >= 15 and {c} > 200 then 'warm_carbon'
         when {t} < 15 and {c} <= 200 then 'cool_clean'
         when {t} < 15 and {c} > 200 then 'cool_carbon' else 'unknown' end"""

WIND, SOLAR, NUCLEAR = "cast(k % 11 as double)", "cast(k % 7 as double)", "cast(k % 5 as double)"


def not_null(table: str, name: str, columns: list[str]) -> str:
    return " union all ".join(
        f"select '{name}' as table_name, 'not_null' as test, '{c}' as column_name, "
        f"count(*) filter ({c} is null) as failures from {table}"
        for c in columns
    )


def unique(table: str, name: str, column: str) -> str:
    return (
        f"select '{name}', 'unique', '{column}', count(*) from (select {column} from {table} "
        f"where {column} is not null group by {column} having count(*) > 1)"
    )


def accepted(table: str, name: str, column: str, allowed: list[str]) -> str:
    listed = ", ".join(f"'{value}'" for value in allowed)
    return (
        f"select '{name}', 'accepted_values', '{column}', "
        f"count(*) filter ({column} not in ({listed})) from {table}"
    )


FACT_COLUMNS = ["fact_id", "location_key", "time_key", "carbon_intensity", "energy_ingested_at"]

ORACLE = {
    # --- A
    "scan_landed_json": sql(
        "select cast(user_id as varchar) as city, ts as ingested_at, k, "
        "cast(null as varchar) as payload_error from ev", "ev"),
    "flatten_hourly": sql("""
        select event_id, strftime(date_trunc('day', ts) + i * interval 1 hour, '%Y-%m-%dT%H:%M')
                   as time,
               case when i < 24 - k % 5 then value + i end as temperature_2m,
               cast(k + i as double) as windspeed_10m,
               case when i < 12 then cast(k + i as double) end as weathercode,
               case when k >= 10 then cast(i as double) end as precipitation
        from (select *, cast(unnest(range(24)) as integer) as i from ev)""", "ev"),
    "uk_reading": sql(f"""
        select cast(user_id as varchar) as city, ts as ingested_at,
               case when k = 99 then null when k % 3 = 0 then 0.0 when k % 3 = 1 then value + 1
                    else value end as carbon_intensity,
               {WIND} + {SOLAR} + {NUCLEAR} as fossil_free_pct, {WIND} + {SOLAR} as renewable_pct,
               case when k >= 20 and k <> 99 then date_trunc('hour', ts) else ts end
                   as measurement_at,
               case when k = 99 then 'intensity: no data' end as payload_error
        from ev""", "ev"),
    "mix_share": sql(f"""
        select event_id, {WIND} + {SOLAR} as renewable_pct,
               {WIND} + {SOLAR} + {NUCLEAR} as fossil_free_pct from ev""", "ev"),
    "latest_chunk": sql("""
        select event_id, chunk_ts, cast(case when at_ms is not null then 2 end as integer) as n_pairs,
               case when chunk_ts is not null and at_ms is null then 'chunk: missing document' end
                   as payload_error
        from idx left join chunk on idx.city = chunk.city and chunk_ts = chunk.h""",
        "idx", "chunk"),
    "price_reading": sql("""
        select idx.city, ingested_at, price as day_ahead_price_eur_mwh,
               case when price is not null then make_timestamp(at_ms * 1000) else ingested_at end
                   as measurement_at,
               case when chunk_ts is not null and at_ms is null then 'chunk: missing document' end
                   as payload_error
        from idx left join chunk on idx.city = chunk.city and chunk_ts = chunk.h""",
        "idx", "chunk"),
    "last_non_null": sql("""
        select user_id, max(case when k < 30 then ts end) as ts,
               arg_max(value, case when k < 30 then ts end) as value
        from ev group by user_id""", "ev"),
    "static_dim": sql(f"""
        select c.city, c.country, c.latitude, c.longitude, c.timezone, z.zone, z.source, n, max_value
        from (select row_number() over () - 1 as pos, * from (
                select cast(city as varchar) as city, country, cast(latitude as double) as latitude,
                       cast(longitude as double) as longitude, timezone
                from ({values(fixed.CITIES)}) as t(city, country, latitude, longitude, timezone))) c
        left join ({values(fixed.ZONES)}) as z(city, country, zone, source) on z.city = c.city
        left join (select k % 10 as p, count(*) as n, max(value) as max_value from ev group by 1)
            on p = pos""", "ev"),
    "typed_frame": f"""
        select e.event_type, n, w.weight * n as weighted
        from (select event_type, count(*) as n from events group by 1) e
        left join ({values(EVENT_WEIGHTS)}) as w(event_type, weight) on w.event_type = e.event_type""",
    "scan_table": "select * from events",
    "seed_csv": sql("""
        select city, country, cast(cast(latitude as float) as double) as latitude,
               cast(cast(longitude as float) as double) as longitude, timezone, electricity_zone
        from reg""", "reg"),
    "values_lookup": sql("""
        select wc.*, n from wc left join (select k, count(*) as n from ev group by k)
        on k = weathercode""", "wc", "ev"),
    "hour_spine": sql("""
        select full_timestamp, time_key, n from dt left join
        (select date_trunc('hour', ts) as h, count(*) as n from events group by 1)
        on h = full_timestamp""", "dt"),
    "dim_time": sql("""
        select dt.*, n from dt left join
        (select date_trunc('hour', ts) as h, count(*) as n from events group by 1)
        on h = full_timestamp""", "dt"),
    # --- B
    "replace_where": sql(f"""
        select * from dated where ingested_date <> {DAY} union all select * from fixed""",
        "dated", "fixed"),
    "replace_partition": sql(f"""
        select * from dated where not (ingested_date = {DAY} and event_type <> 'error')
        union all select * from fixed""", "dated", "fixed"),
    "partition_by": sql("""
        select ingested_date, event_type, count(*) as n, max(value) as max_value
        from dated group by 1, 2""", "dated"),
    "append_audit": sql(f"""
        select * from outcomes union all
        select 'events', 'ALL_CITIES', cast(sum(row_count) as bigint), {INGESTED}, 'SUCCESS', null
        from outcomes""", "outcomes"),
    "append_run_log": sql("select * from log", "log"),
    "full_refresh": """
        select o_orderstatus, o_orderpriority, count(*) as n, max(o_totalprice) as max_price
        from orders group by 1, 2""",
    "upsert": """
        select * from orders where o_orderdate < timestamp '1998-01-01' union all
        select o_orderkey, o_custkey, 'X', o_totalprice, o_orderdate, o_orderpriority
        from orders where o_orderdate >= timestamp '1998-01-01'""",
    "incremental_filter": """
        select event_id, ts, value from events
        where ts > (select max(ts) from events where ts < timestamp '2024-01-15')""",
    "evolve_schema": """
        select o_orderkey, o_totalprice, cast(null as varchar) as o_orderpriority from orders
        union all select o_orderkey, o_totalprice, o_orderpriority from orders
        where o_totalprice > 400000""",
    "scd2": sql("select * from hist", "hist"),
    "current_versions": sql(
        "select sha256(city) as location_key, * from hist where is_current", "hist"),
    "versions_at": sql("""
        select city, timezone, valid_from, valid_to from hist
        where valid_from <= timestamp '2024-01-10'
          and (valid_to is null or timestamp '2024-01-10' < valid_to)""", "hist"),
    "as_of_version": """
        select event_id, user_id, ts, segment from events left join (
            select c_custkey, c_mktsegment || '-' || cast(i as varchar) as segment,
                   timestamp '2024-01-02' + i * (c_nationkey + 1) * interval 1 day as f,
                   case when i < 2 then
                   timestamp '2024-01-02' + (i + 1) * (c_nationkey + 1) * interval 1 day end as t
            from customer, range(3) as r(i)) on c_custkey = user_id and f <= ts
        and (t is null or ts < t)""",
    "export_tables": sql("""
        select 'dim_weather_condition' as layer, count(*) as rows from wc union all
        select 'dim_time', count(*) from dt union all
        select 'dim_location', count(*) from loc union all
        select 'fact_energy_readings', count(*) from fact union all
        select 'agg_daily_energy', count(*) from
            (select distinct left(time_key, 8), city, country from star) union all
        select 'rpt_weather_energy_correlation', count(*) from
            (select distinct city, country, year, month, month_name from star)""",
        "wc", "dt", "loc", "fact", "star"),
    "delete_date": sql(f"select * from dated where ingested_date <> {DAY}", "dated"),
    "clear_run": sql("""
        select run_id, started_at, case when n = 1 or k < 50 then 'FAILED' else 'SUCCESS' end
        as status from runs""", "runs"),
    # --- C
    "enforce_schema": sql("""
        select event_id, city, value, ts, concat_ws('; ',
            case when event_id is null then 'event_id: null' end,
            case when k < 10 then 'value: not double' end,
            case when ts is null then 'ts: null' end) as reject_reason from raw""", "raw"),
    "partial_failure": sql("select * from outcomes where status = 'FAILED'", "outcomes"),
    "test_not_null": sql(" union all ".join(
        f"select '{c}' as column_name, count(*) filter ({c} is null) as failures from fact"
        for c in FACT_COLUMNS), "fact"),
    "test_unique": """
        select l_orderkey, l_linenumber, count(*) as cnt from lineitem group by 1, 2
        having count(*) > 1""",
    "test_accepted_values": """
        select event_type, count(*) as cnt from events
        where event_type not in ('click', 'view', 'purchase') group by 1""",
    "test_not_empty": """
        select 'refunds is empty' as failure_reason
        from (select count(*) as n from events where event_type = 'refund') where n = 0
        union all select 'negative is empty'
        from (select count(*) as n from events where value < 0) where n = 0
        union all select 'events is empty' from (select count(*) as n from events) where n = 0
        union all select 'purchases is empty'
        from (select count(*) as n from events where event_type = 'purchase') where n = 0""",
    "contract_results": sql(" union all ".join([
        not_null("sw", "stg_weather_hourly", [
            "weather_id", "city", "country", "observation_hour", "temperature_2m", "_source",
            "_ingested_at", "_loaded_at"]),
        unique("sw", "stg_weather_hourly", "weather_id"),
        not_null("se", "stg_energy_intensity", [
            "energy_id", "zone", "country", "city", "_source", "_ingested_at", "_loaded_at"]),
        unique("se", "stg_energy_intensity", "energy_id"),
        not_null("loc", "dim_location", ["location_key", "city", "country", "electricity_zone"]),
        unique("loc", "dim_location", "location_key"),
        not_null("fact", "fact_energy_readings", ["fact_id", "location_key", "time_key"]),
        unique("fact", "fact_energy_readings", "fact_id"),
        not_null("bw", "bronze_weather", ["city", "country", "hour", "source"]),
        not_null("be", "bronze_energy", ["zone", "country", "ingested_at", "source"]),
        not_null("dt", "dim_time", [
            "time_key", "full_timestamp", "year", "month", "day", "hour", "is_weekend"]),
        unique("dt", "dim_time", "time_key"),
        not_null("wc", "dim_weather_condition", [
            "weathercode", "condition_label", "condition_category", "severity"]),
        accepted("wc", "dim_weather_condition", "condition_category", fixed.CATEGORIES),
        accepted("wc", "dim_weather_condition", "severity", fixed.SEVERITIES),
        unique("wc", "dim_weather_condition", "weathercode"),
        not_null("(select left(time_key, 8) as agg_date, city from star group by all)",
                 "agg_daily_energy", ["agg_date", "city"]),
        not_null("(select city, country, year, month from star group by all)",
                 "rpt_weather_energy_correlation", ["city", "country", "year", "month"]),
        not_null("hist", "snap_dim_location", ["city", "scd_id"]),
        unique("hist", "snap_dim_location", "scd_id"),
    ]), "sw", "se", "loc", "fact", "bw", "be", "dt", "wc", "star", "hist"),
    "run_guard": sql(f"""
        select run_id, started_at, 'RUNNING' as status from runs
        where n = 1 and started_at >= {NOW} - interval 12 hour""", "runs"),
    "fk_coverage": """
        select user_id as fk_value, count(*) as cnt from events
        where user_id not in (select c_custkey from customer where c_acctbal >= 0) group by 1""",
    "spine_coverage": """
        select date_trunc('hour', o_orderdate) as hour, count(*) as cnt from orders
        where date_trunc('hour', o_orderdate) < timestamp '1996-01-01'
           or date_trunc('hour', o_orderdate) > timestamp '1999-12-31 23:00:00' group by 1""",
    # --- D
    "project_cast": sql(f"""
        select sha256(cast(user_id as varchar) || '|' || cast(ts as varchar)) as event_key,
               cast(user_id as varchar) as city, value as value_mm, k as code,
               event_type as _source, ts as _ingested_at, {LOADED} as _loaded_at from ev""", "ev"),
    "select_subset": "select l_orderkey, l_quantity from lineitem",
    "filter_conjunction": sql(f"""
        select run_id, started_at from log
        where status = 'RUNNING' and started_at >= {NOW} - interval 24 hour""", "log"),
    "filter_not_null": sql("""
        select fact_id, carbon_intensity from fact where carbon_intensity is not null""", "fact"),
    "filter_boolean": sql("select city, valid_from from hist where is_current", "hist"),
    "filter_in_list": "select event_id, ts from events where dayofweek(ts) in (0, 6)",
    "filter_count_zero": """
        select * from (select user_id, cast(ts as date) as day,
                              count(*) filter (event_type = 'purchase') as cnt
                       from events group by 1, 2) where cnt = 0""",
    "qualify": """
        select user_id, event_type, value, event_id from events
        qualify row_number() over (partition by user_id, event_type
                                   order by value desc, event_id desc) = 1""",
    "case_band": sql(f"""
        select event_id, {PROFILE.format(t='t', c='c')} as profile
        from (select event_id, case when k >= 5 then cast(k as double) end as t,
                     case when k <= 95 then value end as c from ev)""", "ev"),
    "case_flag": sql("""
        select event_id, dayofweek(ts) in (0, 6) as is_weekend,
               cast(case when k < 10 then 1 else 0 end as integer) as is_low,
               k > 50 as is_high from ev""", "ev"),
    "null_default": sql("""
        select event_id, case when k < 50 then event_type else 'unknown' end as label,
               case when k < 50 then value else cast(k as double) end as measure from ev""", "ev"),
    # --- E
    "join_location": sql("""
        select weather_id, location_key, electricity_zone from sw join loc on sw.city = loc.city""",
        "sw", "loc"),
    "join_time_key": sql("""
        select event_id, ts, time_key, is_weekend from events
        left join dt on strftime(ts, '%Y%m%d%H') = time_key""", "dt"),
    "join_zone_hour": sql("""
        select weather_id, electricity_zone, observation_hour, carbon_intensity_gco2eq
        from sw join loc on sw.city = loc.city
        left join se on se.zone = electricity_zone and measurement_hour = observation_hour""",
        "sw", "loc", "se"),
    "join_condition_unused": sql("""
        select weather_id, sw.weathercode, condition_label from sw
        left join wc on wc.weathercode = sw.weathercode""", "sw", "wc"),
    "join_star_daily": sql("select fact_id, time_key, city, country from star", "star"),
    "join_star_monthly": sql(
        "select fact_id, city, country, year, month, month_name from star", "star"),
    "join_star_condition": sql(
        "select fact_id, city, year, month, condition_category from star", "star"),
    "join_mode_back": sql(f"""
        select m.city, m.year, m.month, reading_count,
               coalesce(condition_category, 'unknown') as dominant_weather_category
        from (select city, year, month, count(*) as reading_count from star group by all) m
        left join ({MODES}) d on m.city = d.city and m.year = d.year and m.month = d.month""",
        "star"),
    "fact_build": sql("select * from fact", "fact"),
    "pending_weather": sql("""
        select distinct weather_id, sw.city, observation_hour from sw
        join loc on sw.city = loc.city
        join se on se.zone = electricity_zone and measurement_hour = observation_hour
        where se._ingested_at >= timestamp '2024-01-15'""", "sw", "loc", "se"),
    # --- F
    "count_all": "select count(*) as cnt from lineitem",
    "max_scalar": "select max(ts) as mark from events",
    "daily_rollup": sql(f"""
        select cast(strptime(left(time_key, 8), '%Y%m%d') as date) as agg_date, city, country,
               {mean('temperature_2m')} as avg_temperature, max(temperature_2m) as max_temperature,
               min(temperature_2m) as min_temperature,
               {total('precipitation')} as total_precipitation_mm,
               {mean('windspeed_10m')} as avg_windspeed,
               {mean('carbon_intensity')} as avg_carbon_intensity,
               {mean('renewable_pct')} as avg_renewable_pct,
               {mean('fossil_free_pct')} as avg_fossil_free_pct, count(*) as reading_count,
               count(*) filter (carbon_intensity is null) as missing_energy_readings
        from star group by 1, 2, 3""", "star"),
    "monthly_rollup": sql(
        f"select city, country, year, month, month_name, {MONTHLY} from star group by all",
        "star"),
    "monthly_report": sql(f"""
        select m.*, coalesce(condition_category, 'unknown') as dominant_weather_category,
               {PROFILE.format(t='avg_temp_c', c='avg_carbon_intensity')} as temp_carbon_profile
        from (select city, country, year, month, month_name, {MONTHLY} from star group by all) m
        left join ({MODES}) d on m.city = d.city and m.year = d.year and m.month = d.month""",
        "star"),
    "category_count": sql("""
        select city, year, month, condition_category, count(*) as cnt from star group by all""",
        "star"),
    "conditional_count": sql("""
        select location_key, cast(sum(case when carbon_intensity is null then 1 else 0 end)
               as bigint) as missing_energy_readings from fact group by 1""", "fact"),
    "null_skipping_stats": sql(f"""
        select user_id, event_type, {mean('v')} as avg_value, min(v) as min_value,
               max(v) as max_value, {total('v')} as sum_value,
               count(*) filter (v is null) as missing
        from (select *, case when k < 15 then value end as v from ev) group by 1, 2""", "ev"),
    "group_by_ordinal": """
        select l_returnflag, l_linestatus, cast(year(l_shipdate) as integer) as ship_year,
               count(*) as n from lineitem group by 1, 2, 3""",
    "layer_counts": sql("""
        select 'bronze_weather' as layer, count(*) as rows from bw union all
        select 'bronze_energy', count(*) from be union all
        select 'stg_weather_hourly', count(*) from sw union all
        select 'stg_energy_intensity', count(*) from se union all
        select 'fact_energy_readings', count(*) from fact""", "bw", "be", "sw", "se", "fact"),
    # --- G
    "dedup_latest_city_hour": sql("select * from sw", "sw"),
    "dedup_latest_zone_hour": sql("select * from se", "se"),
    "mode_per_group": sql(MODES, "star"),
    # --- H
    "union_all": """
        select cast(0 as integer) as part, event_id, value from events where event_type = 'click'
        union all select 1, event_id, value from events where event_type = 'view'
        union all select 2, event_id, value from events where event_type = 'error'
        union all select 3, event_id, value from events
        where event_type is null or event_type not in ('click', 'view', 'error')""",
    "union_sources": sql("""
        select event_id, case when event_type = 'purchase' then value end as carbon,
               case when event_type <> 'purchase' then value end as price,
               case when event_type <> 'purchase' then k end as k from ev""", "ev"),
    "order_by": sql("select * from reg order by electricity_zone, country, city", "reg"),
    "top_n_recent": sql("""
        select * from log order by started_at desc nulls last, run_id, status limit 10""", "log"),
    # --- I
    "surrogate_key": sql("""
        select event_id, sha256(cast(user_id as varchar) || '|' || cast(ts as varchar) || '|' ||
               case when k <> 3 then event_type end) as key from ev""", "ev"),
    "hash_key": "select c_custkey, sha256(c_name) as key from customer",
    "trunc_hour": "select event_id, date_trunc('hour', ts) as hour from events",
    "format_time_key": """
        select event_id, strftime(ts, '%Y%m%d%H') as time_key, strftime(ts, '%H') as hh
        from events""",
    "names": """
        select o_orderkey, dayname(o_orderdate) as day_of_week,
               monthname(o_orderdate) as month_name from orders""",
    "calendar_parts": """
        select l_orderkey, l_linenumber, l_partkey, cast(year(l_shipdate) as integer) as year,
               cast(month(l_shipdate) as integer) as month, cast(day(l_shipdate) as integer) as day,
               cast(hour(l_shipdate) as integer) as hour,
               cast(quarter(l_shipdate) as integer) as quarter,
               cast(dayofweek(l_shipdate) + 1 as integer) as day_of_week_num,
               dayofweek(l_shipdate) in (0, 6) as is_weekend from lineitem""",
    "key_to_date": sql("""
        select event_id, case when k <> 3 then cast(ts as date) end as agg_date from ev""", "ev"),
    "round_half_up": """
        select l_orderkey, l_linenumber, l_partkey,
               cast(round(cast(l_extendedprice as decimal(18,2)) * cast(l_tax as decimal(4,2)), 2)
                    as double) as tax_2,
               cast(round(cast(l_extendedprice as decimal(18,2)) * cast(l_tax as decimal(4,2))
                    * cast(l_tax as decimal(4,2)), 3) as double) as tax_3
        from lineitem""",
    "cast": sql("""
        select cast(event_id as varchar) as as_string, cast(k as double) as as_double,
               try_cast(user_id as integer) as as_int, cast(ts as date) as as_date,
               try_cast(event_type as integer) as not_an_int from ev""", "ev"),
    "parse_timestamp": """
        select event_id, date_trunc('minute', ts) as plain, date_trunc('minute', ts) as zulu,
               date_trunc('minute', ts) + interval 30 second - interval 2 hour as shifted,
               cast(null as timestamp) as none from events""",
    "epoch_millis": """
        select event_id, date_trunc('millisecond', ts) as at from events""",
    "load_stamp": f"select event_id, {LOADED} as _loaded_at from events",
    "ingest_date": "select event_id, cast(ts as date) as ingested_date from events",
    "interval_arith": f"""
        select event_id, ts - interval 2 hour as two_hours_before,
               datesub('minute', ts, {INGESTED}) as minutes from events""",
    "run_id": "select event_id, strftime(ts, '%Y%m%d_%H%M%S') as run_id from events",
    "sequence_explode": sql("""
        select event_id, unnest(generate_series(date_trunc('hour', ts),
               date_trunc('hour', ts) + (k % 4) * interval 1 hour, interval 1 hour)) as hour
        from ev""", "ev"),
    "array_access": """
        select doc_id, string_split(text, ' ')[1] as first_word,
               string_split(text, ' ')[6] as sixth_word, string_split(text, ' ')[-1] as last_word,
               string_split(text, ' ')[100001] as beyond from documents""",
    "map_build_lookup": sql(f"""
        select event_id, {WIND} as wind, cast(0 as double) as hydro from ev""", "ev"),
    "json_path": sql("""
        select event_id, k, 'none' as missing, cast(null as varchar) as deep from ev""", "ev"),
    "local_to_utc": "select event_id, ts - interval 1 hour as utc from events",
    # --- K
    "stream_upsert": """
        select user_id, date_trunc('hour', ts) as hour, ts, event_id, value,
               cast(ts as date) as hour_date
        from (select *, row_number() over (partition by user_id, date_trunc('hour', ts)
                        order by ts desc, event_id desc) as rn from events) where rn = 1""",
    "stream_dedup": "select distinct user_id, date_trunc('hour', ts) as hour from events",
    "stream_daily": f"""
        select cast(ts as date) as day, event_type, {total('value')} as total, count(*) as n,
               max(value) as max_value from events
        group by 1, 2""",
}

# What is kept up to date load by load equals what is built at once.
ORACLE["incremental_rollup"] = ORACLE["daily_rollup"]
ORACLE["incremental_report"] = ORACLE["monthly_report"]
ORACLE["stored_scd2"] = ORACLE["scd2"]
ORACLE["stored_current_versions"] = ORACLE["current_versions"]
ORACLE["stored_versions_at"] = ORACLE["versions_at"]
ORACLE["unread_files"] = sql("""
    select event_id, ts, value, cast(ts as date) as day, case when k < 80 then 1 else 2 end as load
    from ev""", "ev")
ORACLE["stream_dedup_within"] = ORACLE["stream_dedup"]
ORACLE["stream_windows"] = ORACLE["stream_daily"]
ORACLE["stream_ingest"] = sql("""
    select cast(user_id as varchar) as city, case when k >= 9 then k end as k,
           case when k < 5 then 'payload: malformed JSON' when k < 9 then 'payload: missing' else '' end as reason,
           count(*) as n from ev group by all""", "ev")
ORACLE["observed_contracts"] = ORACLE["contract_results"]
ORACLE["salted_join"] = ORACLE["join_zone_hour"]
