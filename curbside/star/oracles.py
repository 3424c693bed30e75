"""Equivalent SQL (DuckDB dialect) for every query that SQL can express."""

from __future__ import annotations

import zlib

# Fixed values, written out a second time so that a wrong one in the code under test shows.
# Hashing of keys to uniform numbers.
PRIME, KEY_MULTIPLIER = 2147483647, 48271
ROUNDS = ((625341585, 69621), (1540483477, 40692), (461845907, 16807))
# Generated updates.
UPDATE_SEED = 20260923
NEW_FRACTION, DUPLICATE_FRACTION = 0.07, 0.015
FARE_JITTER, DISTANCE_JITTER, PASSENGER_CHANGE = 0.05, 0.10, 0.20
LAST_ROWS, OFFSET_HOURS, REPLAYED, REPLAY_HOURS = 168, 24, 50, 168
# Roles of the star schema.
REGIONS = (("AFRICA", "36", "005"), ("AMERICA", "36", "047"), ("ASIA", "36", "061"), ("EUROPE", "34", "013"))
MONTHS = ("1996-01-01", "1996-04-01")
ROW_KEYS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
BASE_UNTIL, UPDATE_FROM = "2000-01-01", "1999-07-01"
# Bands of particles.
PM25_MISSING, PM25_ABOVE = "Unknown", "Hazardous"
PM25_BANDS = (
    (9.0, "Good"),
    (35.4, "Moderate"),
    (55.4, "Unhealthy for Sensitive"),
    (125.4, "Unhealthy"),
    (225.4, "Very Unhealthy"),
)
AQI_SEGMENTS = (
    (0.0, 9.0, 0.0, 50.0),
    (9.1, 35.4, 51.0, 100.0),
    (35.5, 55.4, 101.0, 150.0),
    (55.5, 125.4, 151.0, 200.0),
    (125.5, 225.4, 201.0, 300.0),
    (225.5, 500.0, 301.0, 500.0),
)
CONDITIONS = (
    (1, "Clear", "Clear"),
    (2, "Fair", "Clear"),
    (3, "Cloudy", "Cloudy"),
    (4, "Overcast", "Cloudy"),
    (5, "Fog", "Fog"),
    (6, "Freezing Fog", "Fog"),
    (7, "Light Rain", "Rain"),
    (8, "Rain", "Rain"),
    (9, "Heavy Rain", "Rain"),
    (10, "Freezing Rain", "Rain"),
    (11, "Heavy Freezing Rain", "Rain"),
    (12, "Sleet", "Snow"),
    (13, "Heavy Sleet", "Snow"),
    (14, "Light Snowfall", "Snow"),
    (15, "Snowfall", "Snow"),
    (16, "Heavy Snowfall", "Snow"),
    (17, "Rain Shower", "Rain"),
    (18, "Heavy Rain Shower", "Rain"),
    (19, "Sleet Shower", "Snow"),
    (20, "Heavy Sleet Shower", "Snow"),
    (21, "Snow Shower", "Snow"),
    (22, "Heavy Snow Shower", "Snow"),
    (23, "Lightning", "Storm"),
    (24, "Hail", "Storm"),
    (25, "Thunderstorm", "Storm"),
    (26, "Heavy Thunderstorm", "Storm"),
    (27, "Storm", "Storm"),
)


def _uniform(seed: int, *keys: str) -> str:
    state = f"{seed % PRIME}::BIGINT"
    for key in keys:
        for part in (f"CAST({key} AS BIGINT)", f"(CAST({key} AS BIGINT) >> 31)"):
            state = f"(xor({state}, {part} & {PRIME}) * {KEY_MULTIPLIER} + {seed % 65536 + 1}) % {PRIME}"
    for mask, multiplier in ROUNDS:
        state = f"(xor({state}, {mask}::BIGINT) * {multiplier}) % {PRIME}"
    return f"(({state}) / {float(PRIME)}::DOUBLE)"


def _band(value: str) -> str:
    arms = " ".join(f"WHEN {value} <= {hi}::DOUBLE THEN '{name}'" for hi, name in PM25_BANDS)
    return f"CASE WHEN {value} IS NULL THEN '{PM25_MISSING}' {arms} ELSE '{PM25_ABOVE}' END"


def _aqi(value: str) -> str:
    arms = " ".join(
        f"WHEN {value} <= {ch}::DOUBLE THEN CAST(round(({value} - {cl}::DOUBLE)"
        f" * {(ih - il) / (ch - cl)!r}::DOUBLE + {il}::DOUBLE) AS INTEGER)"
        for cl, ch, il, ih in AQI_SEGMENTS
    )
    return f"CASE WHEN {value} IS NULL THEN NULL {arms} ELSE 500 END"


def _mode(group: str, value: str, source: str) -> str:
    """(group, value) rows of the most frequent value, lowest on ties."""
    return f"""(
        SELECT {group} AS g, v FROM (
            SELECT {group}, v, row_number() OVER (PARTITION BY {group} ORDER BY n DESC, v) AS nth
            FROM (SELECT {group}, {value} AS v, count(*) AS n FROM {source}
                  WHERE {value} IS NOT NULL GROUP BY 1, 2))
        WHERE nth = 1)"""


_ZONES = """zone AS (
    SELECT c_custkey AS location_id, n_name AS zone, r_name AS borough, n_nationkey AS zone_code
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey)"""

_CODE = {
    column: f"CASE {{0}} {' '.join(f'''WHEN '{row[0]}' THEN '{row[i]}' ''' for row in REGIONS)} END"
    for i, column in ((1, "state_code"), (2, "county_code"))
}


def _codes(column: str) -> str:
    return ", ".join(f"{expr.format(column)} AS {name}" for name, expr in _CODE.items())


_EVENT_TRIPS = f"""{_ZONES},
trip AS (
    SELECT event_id AS trip_id, user_id AS pu_location_id,
           CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS do_location_id,
           ts AS pickup_time_local, ts + to_seconds(CAST(event_id * 37 % 5400 AS BIGINT)) AS dropoff_time_local,
           date_trunc('hour', ts) AS time_utc, value AS trip_distance, value * 2 AS fare_amount,
           strftime(ts, '%Y-%m-%d') AS pickup_date
    FROM events),
placed AS (
    SELECT trip.*, p.zone AS pickup_zone, p.borough AS pickup_borough, d.zone AS dropoff_zone,
           d.borough AS dropoff_borough, {_codes('p.borough')}
    FROM trip LEFT JOIN zone p ON pu_location_id = p.location_id
    LEFT JOIN zone d ON do_location_id = d.location_id),
weather AS (
    SELECT date_trunc('hour', ts) AS hour, avg(value) AS temp, CAST(count(*) * 7 % 30 AS INTEGER) AS coco
    FROM events GROUP BY 1),
air AS (
    SELECT state_code, county_code, hour, avg(value) AS pm25
    FROM (SELECT {_codes('zone.borough')}, date_trunc('hour', ts) AS hour, value
          FROM events JOIN zone ON user_id = location_id)
    WHERE state_code IS NOT NULL GROUP BY 1, 2, 3),
label AS (SELECT * FROM (VALUES {', '.join(f"({c}, '{l}', '{g}')" for c, l, g in CONDITIONS)}) AS t(code, label, bucket)),
full_trip AS (
    SELECT placed.*, temp, coco, pm25, label, bucket, {_band('pm25')} AS band
    FROM placed LEFT JOIN weather ON time_utc = weather.hour
    LEFT JOIN air ON placed.state_code = air.state_code AND placed.county_code = air.county_code
         AND time_utc = air.hour
    LEFT JOIN label ON coco = code)"""

_MONTH_TRIPS = """trip AS (
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate,
           o_orderdate AS pickup_time_local, l_shipdate AS dropoff_time_local, l_quantity AS trip_distance,
           l_linenumber AS passenger_count, l_extendedprice AS fare_amount, l_tax AS airport_fee,
           l_extendedprice * (l_tax + 1) AS total_amount, sn.n_name AS pickup_zone, sr.r_name AS pickup_borough,
           cn.n_name AS dropoff_zone, cr.r_name AS dropoff_borough,
           strftime(o_orderdate, '%Y-%m-%d') AS pickup_date
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN supplier ON l_suppkey = s_suppkey
    LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey LEFT JOIN region sr ON sn.n_regionkey = sr.r_regionkey
    LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey LEFT JOIN region cr ON cn.n_regionkey = cr.r_regionkey)"""


def _events(sql: str) -> str:
    return f"WITH {_EVENT_TRIPS} {sql}"


def _months(sql: str) -> str:
    return f"WITH {_MONTH_TRIPS} {sql}"


_TRENDS = """
SELECT substr(pickup_date, 1, 7) AS pickup_month, count(*) AS total_trips,
       round(avg(trip_distance), 2) AS avg_trip_distance, round(avg(passenger_count), 2) AS avg_passengers,
       round(avg(date_sub('minute', pickup_time_local, dropoff_time_local)), 2) AS avg_trip_duration_minutes,
       CAST(count(*) FILTER (airport_fee > 0) AS BIGINT) AS airport_trips,
       round(100.0::DOUBLE * count(*) FILTER (airport_fee > 0) / count(*), 2) AS airport_trip_percentage,
       round(sum(total_amount), 2) AS total_revenue
FROM trip WHERE {} GROUP BY 1"""

_LINE_ORDER = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, l_shipdate"
)
_NTH = f"row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER})"


def _first_lines(where: str = "true") -> str:
    return f"SELECT * EXCLUDE (nth) FROM (SELECT *, {_NTH} AS nth FROM lineitem WHERE {where}) WHERE nth = 1"


_LINE_OK = "l_quantity >= 2 AND l_quantity <= 45 AND l_discount <= 0.09::DOUBLE"

_BASE_UPDATE = f"""base AS ({_first_lines(f"l_shipdate < TIMESTAMP '{BASE_UNTIL}'")}),
upd AS ({_first_lines(f"l_shipdate >= TIMESTAMP '{UPDATE_FROM}'")})"""


def _unmatched(update: str) -> str:
    return f"""NOT EXISTS (SELECT 1 FROM base WHERE base.l_orderkey IS NOT DISTINCT FROM {update}.l_orderkey
               AND base.l_linenumber IS NOT DISTINCT FROM {update}.l_linenumber)"""


_SHIPMENT_COLUMNS = (
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, l_shipdate, o_orderdate, c_name"
)
_SHIPMENTS = f"""shipment AS (
    SELECT {_SHIPMENT_COLUMNS}
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) ON o_custkey = c_custkey)"""

# The rules one after the other, each on the survivors of the one before.
_WATERFALL = f"""{_SHIPMENTS},
s0 AS (SELECT *, CASE WHEN l_orderkey IS NULL OR l_linenumber IS NULL OR c_name IS NULL THEN 'not_null' END AS r
       FROM shipment),
s1 AS (SELECT * REPLACE (CASE WHEN r IS NULL AND NOT (l_quantity >= 2 AND l_quantity <= 45)
                              THEN 'range' ELSE r END AS r) FROM s0),
s2 AS (SELECT * EXCLUDE (nth) REPLACE (CASE WHEN r IS NULL AND nth > 1 THEN 'duplicate' ELSE r END AS r)
       FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, r IS NULL
                                          ORDER BY {_SHIPMENT_COLUMNS}) AS nth FROM s1)),
s3 AS (SELECT * REPLACE (CASE WHEN r IS NULL AND l_suppkey NOT IN
                                   (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)
                              THEN 'reference' ELSE r END AS r) FROM s2),
s4 AS (SELECT * REPLACE (CASE WHEN r IS NULL AND NOT coalesce(l_shipdate > o_orderdate, false)
                              THEN 'predicate' ELSE r END AS r) FROM s3),
tagged AS (SELECT * REPLACE (CASE WHEN r IS NULL AND l_returnflag NOT IN ('A', 'R')
                                  THEN 'allowed' ELSE r END AS r) FROM s4),
reason AS (SELECT * FROM (VALUES
    (0, 'not_null', 'not_null', 'NULL in required column(s): [''l_orderkey'', ''l_linenumber'', ''c_name'']'),
    (1, 'range', 'numeric_range', 'l_quantity outside [2, 45]'),
    (2, 'duplicate', 'duplicate', 'duplicate on key [''l_orderkey'', ''l_linenumber'']'),
    (3, 'reference', 'reference_integrity', 'l_suppkey has no match in s_suppkey'),
    (4, 'predicate', 'predicate', 'predicate `l_shipdate > o_orderdate` is false or null'),
    (5, 'allowed', 'allowed_values', 'l_returnflag not in [''A'', ''R'']')) AS t(pos, id, kind, why)),
metric AS (
    SELECT pos, id, kind,
           CAST((SELECT count(*) FROM tagged) - (SELECT count(*) FROM tagged JOIN reason e ON r = e.id
                                                 WHERE e.pos < reason.pos) AS BIGINT) AS rows_in,
           CAST((SELECT count(*) FROM tagged WHERE r = reason.id) AS BIGINT) AS rows_failed
    FROM reason)"""


def _outcome(bad: str) -> str:
    return f"""WITH {_SHIPMENTS}
    SELECT CASE WHEN {bad} THEN 'failed' ELSE 'passed' END AS outcome, count(*) AS rows,
           CAST(sum(l_orderkey) AS BIGINT) AS checksum
    FROM shipment GROUP BY 1"""


_NATION_ORDERS = """nation_order AS (
    SELECT * FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
metadata AS (
    SELECT n_name AS table_name, 'orders' AS data_source, '1.0' AS schema_version,
           min(o_orderdate) FILTER (o_orderstatus = 'F') AS created_at,
           max(o_orderdate) FILTER (o_orderstatus = 'F') AS refresh_at
    FROM nation_order GROUP BY 1 HAVING min(n_nationkey) % 5 <> 4)"""

_RUNS = """run AS (
    SELECT o_orderkey AS run_id, o_orderpriority AS dataset, o_orderdate AS executed_at,
           o_totalprice AS execution_time_s, o_custkey AS processed_records, o_custkey % 7 AS rejected_records,
           CASE WHEN o_orderstatus = 'F' THEN o_custkey % 5 ELSE 0 END AS validation_failures
    FROM orders)"""

_RULE_LOG = """log AS (
    SELECT *, CASE WHEN rule_id = 'rule_O' THEN 'range' ELSE 'not_null' END AS rule_type,
           rows_failed * 6 > rows_in AS hard_failure, strftime(executed_at, '%Y-%m') AS run_id
    FROM (SELECT date_trunc('month', l_shipdate)::TIMESTAMP AS executed_at, l_returnflag AS dataset,
                 'rule_' || l_linestatus AS rule_id, count(*) AS rows_in,
                 count(*) FILTER (l_tax = 0) AS rows_failed, avg(l_quantity) AS elapsed_s
          FROM lineitem GROUP BY 1, 2, 3))"""

_PRICED = "priced AS (SELECT * FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)"

_SAMPLE_KEYS = ROW_KEYS
_S = UPDATE_SEED


def _u(stream: str) -> str:
    return _uniform(_S + zlib.crc32(stream.encode()), *_SAMPLE_KEYS)


_UPDATE = f"""bounds AS (
    SELECT date_sub('second', min(pickup_time_local) FILTER ({_u('new')} < {NEW_FRACTION}),
                    max(pickup_time_local)) + 1 AS shift_s,
           CAST(floor(date_sub('second', min(pickup_time_local), max(pickup_time_local))
                      * {NEW_FRACTION}::DOUBLE) AS BIGINT) AS window_s
    FROM trip),
moved AS (
    SELECT trip.*, shift_s + CAST(floor({_u('delay')} * window_s) AS BIGINT) AS by_s
    FROM trip, bounds WHERE {_u('new')} < {NEW_FRACTION})
SELECT l_orderkey, l_partkey, l_linenumber, pickup_time_local + to_seconds(by_s) AS pickup_time_local,
       dropoff_time_local + to_seconds(by_s) AS dropoff_time_local,
       round(fare_amount * (({_u('fare')} * 2 - 1) * {FARE_JITTER}::DOUBLE + 1), 4) AS fare_amount,
       round(trip_distance * (({_u('distance')} * 2 - 1) * {DISTANCE_JITTER}::DOUBLE + 1), 6) AS trip_distance,
       CAST(greatest(1, passenger_count + CASE WHEN {_u('passengers')} < {PASSENGER_CHANGE}
            THEN CASE WHEN {_u('direction')} < 0.5 THEN -1 ELSE 1 END ELSE 0 END) AS INTEGER) AS passenger_count
FROM moved
UNION ALL
SELECT l_orderkey, l_partkey, l_linenumber, pickup_time_local, dropoff_time_local, round(fare_amount, 4),
       round(trip_distance, 6), passenger_count
FROM trip WHERE {_u('copy')} < {DUPLICATE_FRACTION}"""


def _stats(parts: list[tuple[str, str]], source: str, target: str) -> str:
    """Target statistics per value of each (prefix columns, value) part."""
    return " UNION ALL ".join(
        f"SELECT {prefix}, {value} AS value, count(*) AS count, round(avg({target}), 4) AS mean_fare, "
        f"round(stddev_samp({target}), 4) AS std_fare FROM {source} GROUP BY {value}"
        for prefix, value in parts
    )


_TIME_PARTS = {"hour": "hour({})", "day_of_week": "dayofweek({}) + 1", "month": "month({})", "day": "day({})"}

ORACLES: dict[str, str] = {
    # sources, tables, layouts
    "scan_parquet": """SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem
        UNION ALL SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem""",
    "table_overwrite_read": "SELECT * REPLACE (round(o_totalprice * 2, 2) AS o_totalprice) FROM orders",
    "table_append_read": "SELECT * FROM orders",
    "schema_evolve_append": """SELECT * REPLACE (
            CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority,
            CASE WHEN o_orderstatus <> 'F' THEN o_custkey END AS o_custkey) FROM orders""",
    "table_time_travel": "SELECT * FROM orders WHERE o_orderstatus = 'F'",
    "table_history": """WITH n AS (SELECT count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS f FROM orders)
        SELECT 0 AS version, 'overwrite' AS op, f AS n_rows, 1 AS n_batches, false AS is_latest FROM n
        UNION ALL SELECT 1, 'append', n, 2, false FROM n
        UNION ALL SELECT 2, 'overwrite', n - f, 1, false FROM n
        UNION ALL SELECT 3, 'restore', n, 2, true FROM n""",
    "table_restore": "SELECT * FROM orders WHERE o_orderstatus = 'F'",
    "schema_versions": """SELECT * FROM (VALUES (0, '', '1.0'), (1, 'o_orderpriority', '1.1'),
        (2, 'o_custkey,o_orderdate,o_orderpriority', '1.3')) AS t(version, columns_added, schema_version)""",
    "layout_partitioned": _months(
        """SELECT substr(pickup_date, 1, 7) AS pickup_month, count(*) AS trips,
            round(sum(trip_distance), 2) AS distance FROM trip GROUP BY 1"""
    ),
    "storage_footprint": "SELECT count(*) AS rows, true AS has_files, true AS has_bytes FROM lineitem",
    "cached_view": _months(
        """SELECT pickup_zone, count(*) AS trips,
           round(count(*) / sum(count(*)) OVER (PARTITION BY pickup_borough) * 100, 4) AS share
           FROM trip GROUP BY pickup_borough, pickup_zone"""
    ),
    # names, time keys, derived columns
    "snake_case_columns": """SELECT l_orderkey AS pu_location_id, l_linenumber AS vendor_id,
        l_shipdate AS date_gmt, l_extendedprice AS fare_amount FROM lineitem""",
    "time_local_to_utc": _events(
        """SELECT trip_id, pickup_time_local + INTERVAL 5 HOUR AS pickup_time_utc,
           dropoff_time_local + INTERVAL 5 HOUR AS dropoff_time_utc,
           date_trunc('hour', pickup_time_local + INTERVAL 5 HOUR) AS time_utc FROM trip"""
    ),
    "time_from_parts": "SELECT event_id, date_trunc('hour', ts) AS time_utc FROM events",
    "time_from_strings": "SELECT event_id, date_trunc('hour', ts) AS time_utc FROM events",
    "map_region_code": _events("SELECT trip_id, pickup_borough, state_code, county_code FROM placed"),
    "piecewise_index": f"SELECT event_id, value, {_aqi('value')} AS aqi FROM events",
    "scalar_datetime": """SELECT event_id, strftime(ts, '%Y-%m-%d') AS day_text, strftime(ts, '%Y-%m') AS month_text,
        strftime(ts, '%H:%M') AS clock_text, dayname(ts) AS weekday, CAST(ts AS DATE) AS day,
        date_trunc('minute', ts) AS minute, date_trunc('hour', ts) AS hour_start,
        ts + INTERVAL 5 HOUR AS five_later, CAST(floor(epoch(ts)) AS BIGINT) AS epoch_s,
        date_sub('minute', date_trunc('month', ts)::TIMESTAMP, ts) AS minutes, CAST(hour(ts) AS INTEGER) AS hour,
        CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week, CAST(month(ts) AS INTEGER) AS month,
        CAST(day(ts) AS INTEGER) AS day_of_month, current_date > CAST(ts AS DATE) AS in_past FROM events""",
    "scalar_math": f"""SELECT event_id, round(value / 7, 3) AS rounded, abs(value - 50) AS distance,
        greatest(value, 10.0::DOUBLE) AS at_least, event_id % 7 AS remainder, value * 3 - 1 AS linear,
        value / 4 AS quarter, round({_uniform(7, 'event_id')}, 9) AS noise FROM events""",
    "scalar_string": """SELECT event_id, event_type || ' ' || CAST(user_id AS VARCHAR) AS joined,
        'events' AS source, CAST(event_id AS VARCHAR) AS id_text FROM events""",
    "scalar_conditional": """SELECT event_id,
        CASE WHEN value < 10 THEN 'low' WHEN value < 50 THEN 'middle' ELSE 'high' END AS level,
        coalesce(small, -1.0::DOUBLE) AS small_or, nullif(event_type, 'error') AS no_error,
        small IS NULL AS is_missing, small IS NOT NULL AS is_known,
        event_type IN ('view', 'click') AS is_visit,
        small IS NOT DISTINCT FROM nullif(value, 0.0::DOUBLE) AS same, CAST(event_id AS DOUBLE) AS id_double,
        CAST(trunc(value) AS INTEGER) AS value_int, CAST(trunc(value) AS BIGINT) AS value_long
        FROM (SELECT *, CASE WHEN value < 20 THEN value END AS small FROM events)""",
    # filters, cleaning, duplicates
    "filter_excluded_codes": _events(
        """SELECT trip_id, CAST(p.zone_code AS VARCHAR) AS pickup_zone, CAST(d.zone_code AS VARCHAR) AS dropoff_zone
           FROM trip LEFT JOIN zone p ON pu_location_id = p.location_id
           LEFT JOIN zone d ON do_location_id = d.location_id
           WHERE p.zone_code NOT IN (3, 7) AND d.zone_code NOT IN (3, 7)"""
    ),
    "dedup_by_key": _first_lines(),
    "clean_dataset": f"SELECT * FROM ({_first_lines()}) WHERE {_LINE_OK}",
    "clean_counts": f"""SELECT (SELECT count(*) FROM lineitem) AS rows_in, count(*) AS rows_kept,
        (SELECT count(*) FROM lineitem) - count(*) AS rows_rejected FROM ({_first_lines()}) WHERE {_LINE_OK}""",
    "distinct_keys": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
    "time_bounds": "SELECT min(l_shipdate) AS lo, max(l_shipdate) AS hi FROM lineitem",
    # joins
    "join_role_dims": _events(
        "SELECT trip_id, pickup_zone, pickup_borough, dropoff_zone, dropoff_borough FROM placed"
    ),
    "join_hourly": _events(
        """SELECT trip_id, round(temp, 6) AS temperature, coco AS pickup_weather_condition_code FROM full_trip"""
    ),
    "join_composite_preagg": _events(
        "SELECT trip_id, state_code, county_code, time_utc, round(pm25, 6) AS pm25 FROM full_trip"
    ),
    "integrated_trips": _events(
        """SELECT trip_id, pu_location_id, do_location_id, pickup_time_local, dropoff_time_local, time_utc,
           trip_distance, fare_amount, pickup_zone, pickup_borough, dropoff_zone, dropoff_borough, state_code,
           county_code, round(temp, 6) AS temperature, coco AS pickup_weather_condition_code,
           round(pm25, 6) AS pm25, pickup_date FROM full_trip"""
    ),
    # analytical questions
    "count_by_group": _months("SELECT pickup_borough, count(*) AS trips FROM trip GROUP BY 1"),
    "avg_by_group": _months("SELECT pickup_borough, round(avg(fare_amount), 4) AS avg_fare FROM trip GROUP BY 1"),
    "avg_duration_by_day": _months(
        """SELECT pickup_date, round(avg(date_sub('second', pickup_time_local, dropoff_time_local)), 4)
           AS avg_duration_s FROM trip GROUP BY 1"""
    ),
    "monthly_zone_demand": _months(
        """SELECT substr(pickup_date, 1, 7) AS pickup_month, pickup_zone, count(*) AS num_trips
           FROM trip GROUP BY 1, 2"""
    ),
    "metric_by_bucket": _events(
        """SELECT bucket AS weather, round(avg(trip_distance), 2) AS miles, count(*) AS trips
           FROM full_trip GROUP BY 1"""
    ),
    "metric_by_bucket_hint": _events(
        """SELECT bucket AS weather, round(avg(trip_distance), 2) AS miles, count(*) AS trips
           FROM full_trip GROUP BY 1"""
    ),
    "metric_by_label": _events(
        """SELECT coalesce(label, 'Unknown') AS weather, round(avg(trip_distance), 2) AS miles,
           count(*) AS trips FROM full_trip GROUP BY 1"""
    ),
    "demand_by_band": _events(
        """SELECT band AS air_quality_category, count(*) AS trips, count(DISTINCT time_utc) AS hours_observed,
           round(count(*) / count(DISTINCT time_utc), 2) AS avg_trips_per_hour FROM full_trip GROUP BY 1"""
    ),
    "zone_variation": _events(
        """SELECT pickup_zone, round(avg(n), 2) AS avg_trips_per_condition,
           round(stddev_samp(n), 2) AS stddev_trips,
           round(stddev_samp(n) / avg(n) * 100, 2) AS coeff_of_variation
           FROM (SELECT pickup_zone, bucket, count(*) AS n FROM full_trip GROUP BY 1, 2) GROUP BY 1"""
    ),
    "top_hours_per_weekday": _events(
        """SELECT * FROM (SELECT dow, hour, trips,
                 CAST(rank() OVER (PARTITION BY dow ORDER BY trips DESC) AS INTEGER) AS rank
           FROM (SELECT dayname(pickup_time_local) AS dow, CAST(hour(pickup_time_local) AS INTEGER) AS hour,
                        count(*) AS trips FROM trip GROUP BY 1, 2)) WHERE rank <= 3"""
    ),
    "monthly_trends": _months(
        _TRENDS.format(f"pickup_date >= '{MONTHS[0]}' AND pickup_date < '{MONTHS[1]}'")
    ),
    "monthly_trends_unpruned": _months(
        _TRENDS.format(
            f"pickup_time_local >= TIMESTAMP '{MONTHS[0]}' AND pickup_time_local < TIMESTAMP '{MONTHS[1]}'"
        )
    ),
    "group_mode": _months(
        f"""SELECT pickup_borough, count(*) AS trips, any_value(m1.v) AS mode_zone, any_value(m2.v) AS mode_passengers
            FROM trip LEFT JOIN {_mode('pickup_borough', 'dropoff_zone', 'trip')} m1 ON pickup_borough = m1.g
            LEFT JOIN {_mode('pickup_borough', 'passenger_count', 'trip')} m2 ON pickup_borough = m2.g GROUP BY 1"""
    ),
    # data products
    "zone_stats": _months(
        f"""SELECT pickup_zone, count(*) AS trips, round(count(*) / count(DISTINCT pickup_date), 2) AS avg_trip_per_day,
            round(avg(trip_distance), 2) AS avg_trip_distance,
            round(avg(date_sub('minute', pickup_time_local, dropoff_time_local)), 2) AS avg_trip_duration,
            round(avg(fare_amount), 2) AS avg_fare_amount, any_value(m1.v) AS most_common_dropoff_zone,
            CAST(any_value(m2.v) AS INTEGER) AS busiest_hour, any_value(m3.v) AS busiest_week_day
            FROM trip LEFT JOIN {_mode('pickup_zone', 'dropoff_zone', 'trip')} m1 ON pickup_zone = m1.g
            LEFT JOIN {_mode('pickup_zone', 'hour(pickup_time_local)', 'trip')} m2 ON pickup_zone = m2.g
            LEFT JOIN {_mode('pickup_zone', 'dayname(pickup_time_local)', 'trip')} m3 ON pickup_zone = m3.g
            GROUP BY 1"""
    ),
    "band_impact_summary": _events(
        f"""SELECT band AS air_quality_category, count(*) AS trips, count(DISTINCT time_utc) AS total_hours,
            round(count(*) / count(DISTINCT time_utc), 2) AS avg_trips_per_hour,
            round(avg(trip_distance), 2) AS avg_trip_distance, CAST(any_value(m.v) AS INTEGER) AS most_common_hour
            FROM full_trip LEFT JOIN {_mode('band', 'hour(pickup_time_local)', 'full_trip')} m ON band = m.g
            GROUP BY 1"""
    ),
    "borough_summary": _months(
        f"""SELECT pickup_borough, count(*) AS trips, any_value(m1.v) AS most_common_dropoff_borough,
            any_value(m2.v) AS most_common_pickup_borough, any_value(m3.v) AS most_common_dropoff_zone,
            CAST(any_value(m4.v) AS INTEGER) AS most_common_hour,
            round(avg(passenger_count), 2) AS avg_passenger_count_per_trip, any_value(m5.v) AS busiest_week_day
            FROM trip LEFT JOIN {_mode('pickup_borough', 'dropoff_borough', 'trip')} m1 ON pickup_borough = m1.g
            LEFT JOIN {_mode('pickup_borough', 'pickup_zone', 'trip')} m2 ON pickup_borough = m2.g
            LEFT JOIN {_mode('pickup_borough', 'dropoff_zone', 'trip')} m3 ON pickup_borough = m3.g
            LEFT JOIN {_mode('pickup_borough', 'hour(pickup_time_local)', 'trip')} m4 ON pickup_borough = m4.g
            LEFT JOIN {_mode('pickup_borough', 'dayname(pickup_time_local)', 'trip')} m5 ON pickup_borough = m5.g
            GROUP BY 1"""
    ),
    "weekday_summary": _events(
        f"""SELECT week_day, count(*) AS trips, CAST(any_value(m1.v) AS INTEGER) AS busiest_hour,
            any_value(m2.v) AS most_common_pickup_zone, round(avg(fare_amount), 2) AS avg_fare_amount,
            round(avg(date_sub('minute', pickup_time_local, dropoff_time_local)), 2) AS avg_trip_duration
            FROM (SELECT *, dayname(pickup_time_local) AS week_day FROM placed)
            LEFT JOIN {_mode('dow', 'hour(pickup_time_local)',
                             '(SELECT *, dayname(pickup_time_local) AS dow FROM placed)')} m1 ON week_day = m1.g
            LEFT JOIN {_mode('dow', 'pickup_zone',
                             '(SELECT *, dayname(pickup_time_local) AS dow FROM placed)')} m2 ON week_day = m2.g
            GROUP BY 1"""
    ),
    "product_metadata": f"""WITH {_NATION_ORDERS}, refreshed AS (
            SELECT n_name AS table_name, 'orders' AS data_source, '1.1' AS schema_version,
                   max(o_orderdate) AS refresh_at
            FROM nation_order GROUP BY 1 HAVING min(n_nationkey) % 2 = 1)
        SELECT r.table_name, r.data_source, r.schema_version, coalesce(m.created_at, r.refresh_at) AS created_at,
               r.refresh_at FROM refreshed r LEFT JOIN metadata m ON r.table_name = m.table_name
        UNION ALL SELECT * FROM metadata WHERE table_name NOT IN (SELECT table_name FROM refreshed)""",
    "refresh_plan": f"""WITH {_NATION_ORDERS}, dependency AS (
            SELECT DISTINCT n_name AS table_name, c_mktsegment AS dataset FROM nation_order
            WHERE ascii(c_mktsegment) % 5 <> n_nationkey % 5),
        change AS (
            SELECT c_mktsegment AS dataset, max(o_orderdate) AS executed_at,
                   count(*) FILTER (o_orderstatus = 'O' AND o_orderdate >= TIMESTAMP '2001-07-31') AS inserted
            FROM nation_order GROUP BY 1),
        plan AS (
            SELECT d.table_name, count(c.dataset) AS changed_dependencies, any_value(m.refresh_at) AS refresh_at,
                   (SELECT max(executed_at) FROM change WHERE inserted > 0) AS latest_source_time
            FROM dependency d LEFT JOIN change c ON d.dataset = c.dataset AND c.inserted > 0
            LEFT JOIN metadata m ON d.table_name = m.table_name GROUP BY 1)
        SELECT *, coalesce(changed_dependencies > 0 AND (refresh_at IS NULL OR latest_source_time > refresh_at), false)
               AS needs_refresh FROM plan""",
    # order-dependent operators
    "latest_per_key": """SELECT * EXCLUDE (nth) FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS nth FROM events)
        WHERE nth = 1""",
    "last_n_rows": f"""SELECT * FROM events
        ORDER BY date_trunc('hour', ts) DESC, event_id DESC LIMIT {LAST_ROWS}""",
    # update generation
    "expand_offsets": f"""SELECT user_id, event_id, offset_h, new_ts, sample, {_aqi('sample')} AS aqi FROM (
        SELECT user_id, event_id, offset_h, ts + to_hours(CAST(offset_h AS INTEGER)) AS new_ts,
               greatest(0.0::DOUBLE, round(value + ({_uniform(_S, 'user_id', 'offset_h')} * 6.0::DOUBLE - 3.0::DOUBLE), 1)) AS sample
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS nth FROM events),
             range(1, {OFFSET_HOURS + 1}) AS o(offset_h)
        WHERE nth = 1)""",
    "replay_templates": f"""WITH template AS (
            SELECT *, row_number() OVER (ORDER BY ts DESC, event_id) - 1 AS k, max(ts) OVER () AS newest,
                   count(*) OVER () AS n
            FROM (SELECT * FROM events ORDER BY ts DESC, event_id LIMIT {REPLAYED}))
        SELECT offset_h, event_id, newest + to_hours(CAST(offset_h AS INTEGER)) AS new_ts,
               round(value + ({_uniform(_S, 'offset_h')} * 3.0::DOUBLE - 1.5::DOUBLE), 2) AS value
        FROM range(1, {REPLAY_HOURS + 1}) AS o(offset_h) JOIN template ON (offset_h - 1) % n = k""",
    # rules
    "rule_not_null": _outcome("l_orderkey IS NULL OR l_linenumber IS NULL OR c_name IS NULL"),
    "rule_range": _outcome("NOT (l_quantity IS NULL OR (l_quantity >= 2 AND l_quantity <= 45))"),
    "rule_allowed_values": _outcome("l_returnflag NOT IN ('A', 'R')"),
    "rule_predicate": _outcome("NOT coalesce(l_shipdate > o_orderdate, false)"),
    "rule_reference": _outcome("l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)"),
    "rule_duplicate": f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, nth > 1 AS is_duplicate
        FROM (SELECT *, {_NTH} AS nth FROM lineitem)""",
    "validate_waterfall": f"WITH {_WATERFALL} SELECT * EXCLUDE (r) FROM tagged WHERE r IS NULL",
    "validate_rejects": f"""WITH {_WATERFALL}
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, r AS _rule_id, why AS _reject_reason
        FROM tagged JOIN reason ON r = id""",
    "validate_rule_metrics": f"""WITH {_WATERFALL}
        SELECT pos AS rule_order, id AS rule_id, kind AS rule_type, rows_in, rows_failed,
               rows_in - rows_failed AS rows_passed FROM metric""",
    "validate_summary": f"""WITH {_WATERFALL}
        SELECT CAST(sum(rows_failed) FILTER (kind <> 'duplicate') AS BIGINT) AS rejected_invalid_records,
               CAST(sum(rows_failed) FILTER (kind = 'duplicate') AS BIGINT) AS intra_file_duplicate_records
        FROM metric""",
    "schema_contract_report": """WITH n AS (SELECT count(*) AS n FROM lineitem)
        SELECT id AS rule_id, 'schema_contract' AS rule_type, n AS rows_in,
               CASE WHEN hard THEN n ELSE 0 END AS rows_failed, CASE WHEN hard THEN 0 ELSE n END AS rows_passed,
               hard AS hard_failure, present AS extra_columns, flagged AS refused_columns,
               why AS reason
        FROM n, (VALUES
            ('complete', false, '', '', 'complete'),
            ('extra', false, 'l_partkey', '', 'complete; outside the contract: l_partkey'),
            ('extra_strict', false, 'l_partkey', 'l_partkey', 'outside a strict contract: l_partkey'),
            ('missing', true, '', '', 'not found: l_comment'))
            AS t(id, hard, present, flagged, why)""",
    "quarantine_rows": f"""WITH {_WATERFALL}
        SELECT 'run-1' AS _run_id, r AS _rule_id, why AS _reject_reason, count(*) AS rows,
               CAST(sum(l_orderkey) AS BIGINT) AS checksum FROM tagged JOIN reason ON r = id GROUP BY 2, 3""",
    # merge
    "merge_insert_only": f"""WITH {_BASE_UPDATE}
        SELECT * REPLACE (NULL::DOUBLE AS l_tax) FROM base
        UNION ALL SELECT * FROM upd WHERE {_unmatched('upd')}""",
    "merge_stats": f"""WITH {_BASE_UPDATE},
        n AS (SELECT (SELECT count(*) FROM base) AS rows_before, (SELECT count(*) FROM upd) AS considered,
                     (SELECT count(*) FROM upd WHERE {_unmatched('upd')}) AS inserted)
        SELECT rows_before, rows_before + inserted AS rows_after, considered AS update_rows_considered, inserted,
               considered - inserted AS duplicates_ignored_vs_target FROM n""",
    "incremental_update": f"""WITH {_BASE_UPDATE},
        batch AS (SELECT *, {_LINE_OK} AS in_range FROM lineitem WHERE l_shipdate >= TIMESTAMP '{UPDATE_FROM}'),
        numbered AS (SELECT *, {_NTH} AS nth FROM batch WHERE in_range),
        valid AS (SELECT * FROM numbered WHERE nth = 1 AND l_returnflag IN ('A', 'R')),
        fresh AS (SELECT * FROM valid WHERE {_unmatched('valid')}),
        n AS (SELECT (SELECT count(*) FROM batch WHERE NOT in_range)
                     + (SELECT count(*) FROM numbered WHERE nth = 1 AND l_returnflag NOT IN ('A', 'R')) AS invalid,
                     (SELECT count(*) FROM numbered WHERE nth > 1) AS dups,
                     (SELECT count(*) FROM base) AS before, (SELECT count(*) FROM valid) AS considered,
                     (SELECT count(*) FROM fresh) AS inserted)
        SELECT invalid AS rejected_invalid_records, dups AS intra_file_duplicate_records,
               invalid + dups AS quarantined_records, before AS rows_before, before + inserted AS rows_after,
               considered AS update_rows_considered, inserted, considered - inserted AS duplicates_ignored_vs_target,
               considered + invalid + dups AS processed_records, invalid + dups AS validation_failures,
               '1.1' AS schema_version, 'l_tax' AS schema_evolved_on_target, inserted AS rows_with_tax,
               CAST((SELECT sum(l_orderkey) FROM base) + (SELECT sum(l_orderkey) FROM fresh) AS BIGINT) AS checksum
        FROM n""",
    "incremental_integration": f"""WITH {_EVENT_TRIPS},
        name AS (SELECT * FROM (VALUES ('AFRICA', '36', '005'), ('AMERICA', '36', '047'), ('ASIA', '36', '061'),
                                       ('EUROPE', '34', '013')) AS t(region, state, county)),
        mean AS (SELECT state, county, date_trunc('hour', ts) AS hour, avg(value) AS pm25
                 FROM events JOIN zone ON user_id = location_id JOIN name ON borough = region GROUP BY 1, 2, 3),
        whole AS (
            SELECT trip_id, pickup_date, pickup_zone, dropoff_zone, round(temp, 6) AS temperature,
                   coco AS code, round(mean.pm25, 6) AS pm25
            FROM placed LEFT JOIN weather ON time_utc = weather.hour LEFT JOIN name ON pickup_borough = region
            LEFT JOIN mean ON mean.state = name.state AND mean.county = name.county AND mean.hour = time_utc)
        SELECT CAST(0 AS INTEGER) AS run, * FROM whole UNION ALL SELECT 1, * FROM whole""",
    "product_refresh": f"""WITH {_EVENT_TRIPS},
        name AS (SELECT * FROM (VALUES ('AFRICA', '36', '005'), ('AMERICA', '36', '047'), ('ASIA', '36', '061'),
                                       ('EUROPE', '34', '013')) AS t(region, state, county)),
        mean AS (SELECT state, county, date_trunc('hour', ts) AS hour, avg(value) AS pm25
                 FROM events JOIN zone ON user_id = location_id JOIN name ON borough = region GROUP BY 1, 2, 3),
        banded AS (
            SELECT placed.*, dayname(pickup_time_local) AS week_day, CASE WHEN pm25 IS NULL THEN 'Unknown' WHEN pm25 <= 9 THEN 'Good'
                WHEN pm25 <= 35.4 THEN 'Moderate' WHEN pm25 <= 55.4 THEN 'Unhealthy for Sensitive' WHEN pm25 <= 125.4 THEN 'Unhealthy'
                WHEN pm25 <= 225.4 THEN 'Very Unhealthy' ELSE 'Hazardous' END AS band
            FROM placed LEFT JOIN name ON pickup_borough = region
            LEFT JOIN mean ON mean.state = name.state AND mean.county = name.county AND mean.hour = time_utc)
        SELECT 'weekday' AS product, week_day AS name, count(*) AS trips, CAST(any_value(h.v) AS INTEGER) AS busiest_hour,
            any_value(z.v) AS most_common_pickup_zone, round(avg(fare_amount), 2) AS average, CAST(NULL AS BIGINT) AS total_hours
        FROM banded LEFT JOIN {_mode('week_day', 'hour(pickup_time_local)', 'banded')} h ON week_day = h.g
        LEFT JOIN {_mode('week_day', 'pickup_zone', 'banded')} z ON week_day = z.g GROUP BY week_day
        UNION ALL
        SELECT 'band', band, count(*), CAST(any_value(h.v) AS INTEGER), NULL, round(avg(trip_distance), 2), count(DISTINCT time_utc)
        FROM banded LEFT JOIN {_mode('band', 'hour(pickup_time_local)', 'banded')} h ON band = h.g GROUP BY band""",
    # monitoring
    "latest_run": """SELECT l_orderkey AS run_id, o_orderdate AS started_at, l_linenumber AS step,
        l_quantity AS inserted FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE l_orderkey = (SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
                            ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1)""",
    "mon_runs": f"WITH {_RUNS} SELECT executed_at, dataset, processed_records, rejected_records FROM run",
    "mon_failures": f"""WITH {_RUNS} SELECT dataset, count(*) FILTER (validation_failures > 0) AS runs_with_failures,
        CAST(sum(validation_failures) AS BIGINT) AS total_validation_failures FROM run GROUP BY 1""",
    "mon_runtime": f"""WITH {_RUNS} SELECT dataset, round(avg(execution_time_s), 2) AS avg_time_s,
        max(execution_time_s) AS max_time_s FROM run GROUP BY 1""",
    "mon_runtime_change": f"""WITH {_RUNS} SELECT dataset, executed_at, run_id, execution_time_s,
        round(execution_time_s - lag(execution_time_s) OVER (PARTITION BY dataset ORDER BY executed_at, run_id), 2)
        AS change_s FROM run""",
    "mon_rule_failures": f"""WITH {_RULE_LOG} SELECT dataset, rule_id, rule_type,
        CAST(sum(rows_failed) AS BIGINT) AS total_failed, CAST(sum(rows_in) AS BIGINT) AS total_checked,
        round(sum(rows_failed) / nullif(sum(rows_in), 0) * 100, 2) AS fail_pct
        FROM log GROUP BY 1, 2, 3 HAVING sum(rows_failed) > 0""",
    "mon_rule_types": f"""WITH {_RULE_LOG} SELECT rule_type, count(DISTINCT rule_id) AS distinct_rules,
        CAST(sum(rows_failed) AS BIGINT) AS total_failed, round(avg(elapsed_s), 3) AS avg_elapsed_s
        FROM log GROUP BY 1""",
    "mon_hard_failures": f"WITH {_RULE_LOG} SELECT run_id, dataset, executed_at, rule_id FROM log WHERE hard_failure",
    # features and training
    "feature_by_category": f"WITH {_PRICED} "
    + _stats([("'l_returnflag' AS feature", "l_returnflag"), ("'p_type' AS feature", "p_type")], "priced",
             "l_extendedprice"),
    "feature_by_hour": _events(
        _stats(
            [
                (f"'{c}' AS feature, '{part}' AS part", f"CAST({sql.format(c)} AS INTEGER)")
                for c in ("pickup_time_local", "dropoff_time_local")
                for part, sql in _TIME_PARTS.items()
            ],
            "trip",
            "fare_amount",
        )
    ),
    "feature_correlation": " UNION ALL ".join(
        f"SELECT '{c}' AS candidate, round(corr({c}, l_extendedprice), 9) AS correlation FROM lineitem"
        for c in ("l_quantity", "l_discount", "l_tax")
    ),
    "feature_dates": """SELECT event_id AS trip_id, CAST(hour(ts) AS INTEGER) AS pickup_time_local_hour,
        CAST(dayofweek(ts) + 1 AS INTEGER) AS pickup_time_local_day_of_week,
        CAST(month(ts) AS INTEGER) AS pickup_time_local_month FROM events""",
    "training_split": f"""SELECT l_orderkey, l_partkey, l_linenumber,
        CASE WHEN u < 0.7 THEN 'train' WHEN u < 0.85 THEN 'validation' ELSE 'test' END AS split
        FROM (SELECT *, {_uniform(42, *ROW_KEYS)} AS u FROM lineitem)""",
    "impute_median": """SELECT count(*) AS rows, count(*) FILTER (l_discount = 0) AS filled, CAST(0 AS BIGINT) AS changed,
        true AS is_median FROM lineitem""",
    "gbt_predict": f"""SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice, true AS beats_mean
        FROM (SELECT *, {_uniform(42, *ROW_KEYS)} AS u FROM lineitem) WHERE u >= 0.8""",
    "scale_numeric": """SELECT l_orderkey, l_partkey, l_linenumber,
        round(l_quantity / (SELECT stddev_samp(l_quantity) FROM lineitem), 6) AS quantity_scaled,
        round(l_discount / (SELECT stddev_samp(l_discount) FROM lineitem), 6) AS discount_scaled FROM lineitem""",
    "string_index": f"""WITH {_PRICED},
        t AS (SELECT p_type, CAST(row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS DOUBLE) AS i
              FROM priced GROUP BY 1),
        f AS (SELECT l_returnflag, CAST(row_number() OVER (ORDER BY count(*) DESC, l_returnflag) - 1 AS DOUBLE) AS i
              FROM priced GROUP BY 1)
        SELECT priced.p_type, any_value(t.i) AS p_type_index, priced.l_returnflag,
               any_value(f.i) AS l_returnflag_index, count(*) AS rows
        FROM priced JOIN t ON priced.p_type = t.p_type JOIN f ON priced.l_returnflag = f.l_returnflag
        GROUP BY 1, 3""",
    "training_set": f"""WITH {_PRICED},
        drawn AS (SELECT * REPLACE (nullif(l_discount, 0) AS l_discount), {_uniform(42, *ROW_KEYS)} AS u FROM priced),
        median AS (SELECT quantile_disc(l_discount, 0.5) AS m FROM drawn WHERE u < 0.7),
        split AS (SELECT * REPLACE (coalesce(l_discount, (SELECT m FROM median)) AS l_discount),
                         CASE WHEN u < 0.7 THEN 'train' WHEN u < 0.85 THEN 'validation' ELSE 'test' END AS split FROM drawn),
        train AS (SELECT * FROM split WHERE split = 'train'),
        t AS (SELECT p_type, CAST(row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS DOUBLE) AS i
              FROM train GROUP BY 1),
        f AS (SELECT l_returnflag, CAST(row_number() OVER (ORDER BY count(*) DESC, l_returnflag) - 1 AS DOUBLE) AS i
              FROM train GROUP BY 1)
        SELECT split, l_extendedprice,
               round(l_quantity / (SELECT stddev_samp(l_quantity) FROM train), 6) AS quantity,
               round(l_discount / (SELECT stddev_samp(l_discount) FROM train), 6) AS discount,
               round(l_tax / (SELECT stddev_samp(l_tax) FROM train), 6) AS tax, f.i AS returnflag, t.i AS p_type,
               CAST(hour(l_shipdate) AS DOUBLE) AS hour, CAST(dayofweek(l_shipdate) + 1 AS DOUBLE) AS day_of_week,
               CAST(month(l_shipdate) AS DOUBLE) AS month
        FROM split JOIN t ON split.p_type = t.p_type JOIN f ON split.l_returnflag = f.l_returnflag""",
    "regression_metrics": f"""WITH {_PRICED},
        e AS (SELECT l_extendedprice AS y, avg(l_extendedprice) OVER (PARTITION BY l_quantity) AS p FROM priced)
        SELECT round(sqrt(sum((p - y) * (p - y)) / count(*)), 4) AS rmse, round(avg(abs(p - y)), 4) AS mae,
               round(1 - sum((p - y) * (p - y)) / (var_pop(y) * count(*)), 4) AS r2 FROM e""",
}
ORACLES["update_batch"] = f"WITH {_MONTH_TRIPS}, {_UPDATE}"
