"""Oracle SQL (DuckDB dialect) for the registered queries.

Each entry recomputes the same result from the pre-registered ``events`` view
with plain SQL: the flight adapter, the cleaning chain, features, z-scores and
windows are written once as CTEs and shared.  Every double column is rounded to
6 decimals, as the Spark side does.
"""

from __future__ import annotations

ADAPTER = """
ev AS (SELECT event_id, ts, user_id, value FROM events),
ev2 AS (SELECT * FROM ev UNION ALL SELECT * FROM ev WHERE event_id % 20 = 0),
flights AS (
  SELECT event_id,
    CASE WHEN event_id % 211 = 0 THEN NULL ELSE lower(lpad(hex(user_id), 6, '0')) END AS icao24,
    CASE WHEN event_id % 13 = 0 THEN NULL ELSE 'FLT' || CAST(user_id AS VARCHAR) || ' ' END AS callsign,
    'NATION_' || CAST(user_id % 25 AS VARCHAR) AS origin_country,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(floor(epoch(ts)) AS BIGINT) END AS time_position,
    CASE WHEN event_id % 151 = 0 THEN 200.0e0 WHEN event_id % 101 = 0 THEN 0.0e0
         WHEN event_id % 17 = 3 THEN NULL
         ELSE (event_id * 7919 % 36000) / 100.0e0 - 180.0e0 END AS longitude,
    CASE WHEN event_id % 101 = 0 THEN 0.0e0 WHEN event_id % 17 = 3 THEN NULL
         ELSE (event_id * 6007 % 18000) / 100.0e0 - 90.0e0 END AS latitude,
    CASE WHEN event_id % 307 = 0 THEN 60000.0e0 WHEN event_id % 19 = 0 THEN NULL
         ELSE CAST(event_id * 37 % 12000 AS DOUBLE) END AS baro_altitude,
    CASE WHEN event_id % 89 = 0 THEN NULL ELSE event_id % 8 = 0 END AS on_ground,
    CASE WHEN event_id % 401 = 0 THEN -50.0e0 ELSE value END AS velocity,
    CASE WHEN event_id % 409 = 0 THEN 400.0e0 ELSE (event_id * 13 % 3601) / 10.0e0 END AS heading,
    CASE WHEN event_id % 23 = 0 THEN NULL ELSE (event_id * 11 % 601 - 300) / 10.0e0 END AS vertical_rate,
    CASE WHEN event_id % 307 = 0 THEN 60000.0e0 WHEN event_id % 19 = 0 THEN NULL
         ELSE CAST(event_id * 37 % 12000 AS DOUBLE) END + 100.0e0 AS geo_altitude,
    CAST(event_id % 4 AS INTEGER) AS position_source,
    CASE WHEN event_id % 499 = 0 THEN 'not-a-time'
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS ingestion_timestamp,
    TRUE AS data_valid,
    ts AS source_ts
  FROM ev2)"""

CLEAN = """
parsed AS (SELECT * EXCLUDE (source_ts),
    try_cast(replace(replace(ingestion_timestamp, 'T', ' '), 'Z', '') AS TIMESTAMP) AS event_time
  FROM flights),
present AS (SELECT * FROM parsed WHERE icao24 IS NOT NULL AND event_time IS NOT NULL),
dedup AS (SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY icao24, time_position
                                 ORDER BY event_time, event_id) AS rn FROM present)
  WHERE rn = 1),
imputed AS (SELECT * REPLACE (
    CASE WHEN latitude IS NULL OR isnan(latitude) THEN 0.0e0 ELSE latitude END AS latitude,
    CASE WHEN longitude IS NULL OR isnan(longitude) THEN 0.0e0 ELSE longitude END AS longitude,
    CASE WHEN baro_altitude IS NULL OR isnan(baro_altitude) THEN 0.0e0 ELSE baro_altitude END AS baro_altitude,
    CASE WHEN velocity IS NULL OR isnan(velocity) THEN 0.0e0 ELSE velocity END AS velocity,
    CASE WHEN heading IS NULL OR isnan(heading) THEN 0.0e0 ELSE heading END AS heading,
    CASE WHEN vertical_rate IS NULL OR isnan(vertical_rate) THEN 0.0e0 ELSE vertical_rate END AS vertical_rate)
  FROM dedup),
ranged AS (SELECT * FROM imputed
  WHERE latitude BETWEEN -90.0e0 AND 90.0e0 AND longitude BETWEEN -180.0e0 AND 180.0e0
    AND baro_altitude BETWEEN -1000.0e0 AND 50000.0e0 AND velocity BETWEEN 0.0e0 AND 1000.0e0
    AND heading BETWEEN 0.0e0 AND 360.0e0),
cleaned AS (SELECT *,
    CASE WHEN icao24 IS NULL OR (latitude = 0 AND longitude = 0) OR event_time IS NULL
         THEN 'invalid' ELSE 'valid' END AS data_quality
  FROM ranged)"""

FEATURES = """
valid AS (SELECT * FROM cleaned WHERE data_quality = 'valid'),
feat0 AS (SELECT *, CAST(hour(event_time) AS INTEGER) AS hour,
    CAST(dayofweek(event_time) + 1 AS INTEGER) AS day_of_week,
    dayofweek(event_time) IN (0, 6) AS is_weekend
  FROM valid),
feat AS (SELECT *,
    sin(radians(hour * 360.0e0 / 24.0e0)) AS hour_sin,
    cos(radians(hour * 360.0e0 / 24.0e0)) AS hour_cos,
    sin(radians(day_of_week * 360.0e0 / 7.0e0)) AS dow_sin,
    cos(radians(day_of_week * 360.0e0 / 7.0e0)) AS dow_cos,
    sin(radians(heading)) AS heading_sin,
    cos(radians(heading)) AS heading_cos,
    velocity * 3.6e0 AS velocity_kmh,
    velocity * 1.94384e0 AS velocity_knots,
    baro_altitude * 3.28084e0 AS altitude_feet,
    CAST(trunc(baro_altitude * 3.28084e0 / 100) AS INTEGER) AS flight_level,
    CASE WHEN on_ground THEN 'ground'
         WHEN baro_altitude < 1000 THEN 'takeoff_landing'
         WHEN vertical_rate > 5 THEN 'climbing'
         WHEN vertical_rate < -5 THEN 'descending'
         ELSE 'cruise' END AS flight_phase
  FROM feat0)"""


def _zscore(width: str, per_key: bool = False, name: str = "scored") -> str:
    part = "zb, icao24" if per_key else "zb"
    return f"""
{name}_b AS (SELECT *, time_bucket(INTERVAL '{width}', event_time) AS zb FROM feat),
{name}_s AS (SELECT *,
    avg(velocity) OVER (PARTITION BY {part}) AS mv,
    stddev_samp(velocity) OVER (PARTITION BY {part}) AS sv,
    avg(baro_altitude) OVER (PARTITION BY {part}) AS ma,
    stddev_samp(baro_altitude) OVER (PARTITION BY {part}) AS sa
  FROM {name}_b),
{name}_z AS (SELECT * EXCLUDE (zb, mv, sv, ma, sa),
    coalesce((velocity - mv) / nullif(sv, 0.0e0), 0.0e0) AS velocity_zscore,
    coalesce((baro_altitude - ma) / nullif(sa, 0.0e0), 0.0e0) AS altitude_zscore
  FROM {name}_s),
{name} AS (SELECT *, abs(velocity_zscore) > 3.0e0 OR abs(altitude_zscore) > 3.0e0 AS is_stat_anomaly,
    least(abs(velocity_zscore) / 3.0e0, 1.0e0) AS stat_score
  FROM {name}_z)"""


def _windows(width: str, src: str = "scored", name: str = "win") -> str:
    o = "{'a': event_time, 'b': event_id}"
    return f"""
{name}_g AS (SELECT time_bucket(INTERVAL '{width}', event_time) AS window_start, icao24,
    count(*) AS flight_events,
    avg(velocity) AS avg_velocity, max(velocity) AS max_velocity, min(velocity) AS min_velocity,
    stddev_samp(velocity) AS velocity_variance,
    avg(baro_altitude) AS avg_altitude, max(baro_altitude) AS max_altitude,
    min(baro_altitude) AS min_altitude, stddev_samp(baro_altitude) AS altitude_variance,
    avg(vertical_rate) AS avg_vertical_rate, max(vertical_rate) AS max_climb_rate,
    min(vertical_rate) AS max_descent_rate,
    CAST(sum(CASE WHEN is_stat_anomaly THEN 1 ELSE 0 END) AS BIGINT) AS anomaly_count,
    arg_min_null(callsign, {o}) AS callsign,
    arg_min_null(origin_country, {o}) AS origin_country,
    arg_min_null(on_ground, {o}) AS start_on_ground,
    arg_max_null(on_ground, {o}) AS end_on_ground,
    arg_min_null(latitude, {o}) AS start_latitude,
    arg_min_null(longitude, {o}) AS start_longitude,
    arg_max_null(latitude, {o}) AS end_latitude,
    arg_max_null(longitude, {o}) AS end_longitude
  FROM {src} GROUP BY 1, 2),
{name} AS (SELECT window_start, window_start + INTERVAL '{width}' AS window_end, * EXCLUDE (window_start),
    CASE WHEN flight_events > 0 THEN anomaly_count / flight_events * 100 ELSE 0.0e0 END AS anomaly_rate,
    max_altitude - min_altitude AS altitude_change,
    max_velocity - min_velocity AS velocity_range,
    CASE WHEN start_on_ground AND end_on_ground THEN 'stationary'
         WHEN start_on_ground THEN 'takeoff'
         WHEN end_on_ground THEN 'landing'
         WHEN altitude_variance < 100 THEN 'stable_cruise'
         ELSE 'maneuvering' END AS flight_behavior
  FROM {name}_g)"""


TRENDS = """
tr_l AS (SELECT *,
    lag(avg_velocity, 1) OVER (PARTITION BY icao24 ORDER BY window_start) AS prev_avg_velocity,
    lag(avg_altitude, 1) OVER (PARTITION BY icao24 ORDER BY window_start) AS prev_avg_altitude
  FROM win),
tr_c AS (SELECT *, avg_velocity - prev_avg_velocity AS velocity_change,
    avg_altitude - prev_avg_altitude AS altitude_change_from_prev FROM tr_l),
tr_t AS (SELECT *,
    CASE WHEN prev_avg_velocity IS NULL THEN 'no_history'
         WHEN velocity_change > 10 THEN 'accelerating'
         WHEN velocity_change < -10 THEN 'decelerating'
         ELSE 'stable_speed' END AS velocity_trend,
    CASE WHEN prev_avg_altitude IS NULL THEN 'no_history'
         WHEN altitude_change_from_prev > 500 THEN 'climbing'
         WHEN altitude_change_from_prev < -500 THEN 'descending'
         ELSE 'stable_altitude' END AS altitude_trend
  FROM tr_c),
trends AS (SELECT *,
    CASE WHEN velocity_trend = 'no_history' THEN 'initial_observation'
         WHEN velocity_trend = 'stable_speed' AND altitude_trend = 'stable_altitude' THEN 'stable_flight'
         WHEN altitude_trend = 'climbing' THEN 'ascending'
         WHEN altitude_trend = 'descending' THEN 'descending'
         ELSE 'maneuvering' END AS trend_summary
  FROM tr_t)"""

VALIDATOR = """
CASE WHEN icao24 IS NULL OR icao24 = '' THEN 'Missing icao24'
     WHEN latitude IS NOT NULL AND NOT (latitude >= -90.0e0 AND latitude <= 90.0e0)
       THEN 'Invalid latitude: ' || CAST(latitude AS VARCHAR)
     WHEN longitude IS NOT NULL AND NOT (longitude >= -180.0e0 AND longitude <= 180.0e0)
       THEN 'Invalid longitude: ' || CAST(longitude AS VARCHAR)
     WHEN baro_altitude IS NOT NULL AND NOT (baro_altitude >= -1000.0e0 AND baro_altitude <= 50000.0e0)
       THEN 'Invalid baro_altitude: ' || CAST(baro_altitude AS VARCHAR)
     WHEN velocity IS NOT NULL AND NOT (velocity >= 0.0e0)
       THEN 'Invalid velocity: ' || CAST(velocity AS VARCHAR)
     WHEN heading IS NOT NULL AND NOT (heading >= 0.0e0 AND heading <= 360.0e0)
       THEN 'Invalid heading: ' || CAST(heading AS VARCHAR)
END"""

# Message feed derived from the adapter (see trackstream.sources.messages):
# id % 53 -> not JSON, id % 61 -> NULL value, id % 59 -> latitude 'north' (when present),
# id % 7 -> doubly encoded.
MESSAGES = """
msgs AS (SELECT *,
    CASE WHEN event_id % 53 = 0 THEN 'malformed_json'
         WHEN event_id % 61 = 0 THEN 'null_value'
         WHEN event_id % 59 = 0 AND latitude IS NOT NULL THEN 'wrong_type' END AS msg_defect,
    try_cast(replace(replace(ingestion_timestamp, 'T', ' '), 'Z', '') AS TIMESTAMP) AS kafka_timestamp
  FROM flights),
good_msgs AS (SELECT * REPLACE (CASE WHEN msg_defect = 'wrong_type' THEN NULL ELSE latitude END AS latitude)
  FROM msgs WHERE msg_defect IS NULL OR msg_defect = 'wrong_type')"""

SNAPSHOTS = """
snap AS (SELECT *, CAST(floor(event_id / 8) AS BIGINT) AS doc_no FROM flights),
snap_t AS (SELECT *, min(CAST(floor(epoch(source_ts)) AS BIGINT)) OVER (PARTITION BY doc_no) AS snapshot_time
  FROM snap),
states AS (SELECT * FROM snap_t WHERE doc_no % 50 <> 0)"""


def with_(*parts: str, select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


BASE = (ADAPTER, CLEAN)
FEAT = (ADAPTER, CLEAN, FEATURES)
SCORED = (ADAPTER, CLEAN, FEATURES, _zscore("1 day"))
WIN = SCORED + (_windows("1 day"),)

FLIGHT_COLS = ("event_id, icao24, callsign, origin_country, time_position, longitude, latitude, "
               "baro_altitude, on_ground, velocity, heading, vertical_rate, geo_altitude, "
               "position_source, ingestion_timestamp, data_valid")

BURSTS = """
b AS (SELECT event_id, user_id, value, CAST(floor(epoch(ts) / 600) * 600 AS BIGINT) AS t0,
    unnest(range(0, 12 + event_id % 10)) AS k FROM events),
bursts AS (SELECT event_id * 100 + k AS event_id, lower(lpad(hex(user_id), 6, '0')) AS icao24,
    'FLT' || CAST(user_id AS VARCHAR) AS callsign,
    'NATION_' || CAST(user_id % 25 AS VARCHAR) AS origin_country,
    CAST(make_timestamp((t0 + k * 25) * 1000000) AS TIMESTAMP) AS event_time,
    CASE WHEN (event_id + k) % 97 <> 0 THEN t0 + k * 25 - (event_id * 7 + k * 13) % 45 END AS time_position,
    value + 2.0e0 * (k % 5) + CASE WHEN k = 6 AND event_id % 40 = 0 THEN 600.0e0 ELSE 0.0e0 END AS velocity,
    1000.0e0 + event_id * 37 % 9000 + k * (event_id % 3) * 30.0e0 AS baro_altitude,
    CAST(event_id * 11 % 601 - 300 AS DOUBLE) / 10.0e0 AS vertical_rate,
    event_id % 8 = 0 AND k < 5 AS on_ground,
    (event_id * 6007 % 18000) / 100.0e0 - 90.0e0 + k / 1000.0e0 AS latitude,
    (event_id * 7919 % 36000) / 100.0e0 - 180.0e0 AS longitude FROM b),
feat AS (SELECT * FROM bursts)"""


def _every_field() -> str:
    """The validator's message where each field may come as the text 'n/a'."""
    rules = [("latitude", "-90.0e0", "90.0e0"), ("longitude", "-180.0e0", "180.0e0"),
             ("baro_altitude", "-1000.0e0", "50000.0e0"), ("velocity", "0.0e0", None),
             ("heading", "0.0e0", "360.0e0")]
    out = "CASE WHEN icao24 IS NULL OR icao24 = '' THEN 'Missing icao24'"
    for n, (f, lo, hi) in enumerate(rules):
        inside = f"{f} >= {lo}" + (f" AND {f} <= {hi}" if hi else "")
        out += f""" WHEN {f} IS NOT NULL AND wrong = {n} THEN 'Invalid {f}: n/a'
            WHEN {f} IS NOT NULL AND NOT ({inside}) THEN 'Invalid {f}: ' || CAST({f} AS VARCHAR)"""
    return out + " END"


PROCESSED_COLS = """icao24, callsign, origin_country, event_time, latitude, longitude, baro_altitude, velocity,
    heading, vertical_rate, on_ground, round(velocity_kmh, 6) AS velocity_kmh,
    round(altitude_feet, 6) AS altitude_feet, flight_phase, hour, day_of_week, is_weekend,
    is_stat_anomaly, round(velocity_zscore, 6) AS velocity_zscore,
    round(altitude_zscore, 6) AS altitude_zscore, 0.0e0 AS ml_anomaly_score,
    FALSE AS ml_is_anomaly, 'model_unavailable' AS ml_anomaly_reason, data_quality"""

WIN_ALL = """window_start, window_end, icao24, flight_events,
    round(avg_velocity, 6) AS avg_velocity, round(max_velocity, 6) AS max_velocity,
    round(min_velocity, 6) AS min_velocity, round(velocity_variance, 6) AS velocity_variance,
    round(avg_altitude, 6) AS avg_altitude, round(max_altitude, 6) AS max_altitude,
    round(min_altitude, 6) AS min_altitude, round(altitude_variance, 6) AS altitude_variance,
    round(avg_vertical_rate, 6) AS avg_vertical_rate, round(max_climb_rate, 6) AS max_climb_rate,
    round(max_descent_rate, 6) AS max_descent_rate, anomaly_count, callsign, origin_country,
    start_on_ground, end_on_ground, round(start_latitude, 6) AS start_latitude,
    round(start_longitude, 6) AS start_longitude, round(end_latitude, 6) AS end_latitude,
    round(end_longitude, 6) AS end_longitude, round(anomaly_rate, 6) AS anomaly_rate,
    round(altitude_change, 6) AS altitude_change, round(velocity_range, 6) AS velocity_range,
    flight_behavior"""

CLEAN_ALL = FLIGHT_COLS + ", event_time, data_quality"

SQL: dict[str, str] = {
    # ---------------------------------------------------------- clean
    "critical_not_null": with_(*BASE, select=f"SELECT {FLIGHT_COLS}, event_time FROM present"),
    "dedup_events": with_(*BASE, select=f"SELECT {FLIGHT_COLS}, event_time FROM dedup"),
    "impute_defaults": with_(*BASE, select=f"SELECT {FLIGHT_COLS}, event_time FROM imputed"),
    "range_filter": with_(*BASE, select=f"SELECT {FLIGHT_COLS}, event_time FROM ranged"),
    "clean_events": with_(*BASE, select=f"SELECT {CLEAN_ALL} FROM cleaned"),
    "quality_flag": with_(*BASE, select="SELECT data_quality, count(*) AS events FROM cleaned "
                                        "GROUP BY data_quality"),
    "reject_reason": with_(*BASE, select="""
SELECT event_id, icao24, CASE
    WHEN NOT (latitude BETWEEN -90.0e0 AND 90.0e0) THEN 'latitude_out_of_range'
    WHEN NOT (longitude BETWEEN -180.0e0 AND 180.0e0) THEN 'longitude_out_of_range'
    WHEN NOT (baro_altitude BETWEEN -1000.0e0 AND 50000.0e0) THEN 'baro_altitude_out_of_range'
    WHEN NOT (velocity BETWEEN 0.0e0 AND 1000.0e0) THEN 'velocity_out_of_range'
    WHEN NOT (heading BETWEEN 0.0e0 AND 360.0e0) THEN 'heading_out_of_range' END AS reject_reason
FROM imputed
WHERE NOT (latitude BETWEEN -90.0e0 AND 90.0e0 AND longitude BETWEEN -180.0e0 AND 180.0e0
    AND baro_altitude BETWEEN -1000.0e0 AND 50000.0e0 AND velocity BETWEEN 0.0e0 AND 1000.0e0
    AND heading BETWEEN 0.0e0 AND 360.0e0)"""),
    "validate_records": with_(ADAPTER, select=f"""
SELECT event_id, icao24, ({VALIDATOR}) IS NULL AS data_valid, {VALIDATOR} AS validation_error
FROM flights"""),
    "validate_types": with_(ADAPTER, MESSAGES, select=f"""
SELECT event_id, icao24,
    (CASE WHEN msg_defect = 'wrong_type' AND NOT (icao24 IS NULL OR icao24 = '')
          THEN 'Invalid latitude: north' ELSE {VALIDATOR} END) IS NULL AS data_valid,
    CASE WHEN msg_defect = 'wrong_type' AND NOT (icao24 IS NULL OR icao24 = '')
         THEN 'Invalid latitude: north' ELSE {VALIDATOR} END AS validation_error
FROM good_msgs"""),
    # ---------------------------------------------------------- sources
    "parse_payload": with_(ADAPTER, MESSAGES, select=f"""
SELECT icao24 AS key, {FLIGHT_COLS}, kafka_timestamp FROM good_msgs"""),
    "unwrap_nested_json": with_(ADAPTER, MESSAGES, select="""
SELECT event_id, icao24, event_id % 7 = 0 AS was_nested FROM good_msgs"""),
    "dead_letter_json": with_(ADAPTER, MESSAGES, select="""
SELECT icao24 AS key, kafka_timestamp, msg_defect AS reason FROM msgs WHERE msg_defect IS NOT NULL"""),
    "explode_states": with_(ADAPTER, SNAPSHOTS, select="""
SELECT doc_no, snapshot_time, icao24, 17 AS n_slots FROM states"""),
    "decode_states": with_(ADAPTER, SNAPSHOTS, select="""
SELECT doc_no, icao24, trim(callsign) AS callsign, origin_country, time_position, longitude,
    latitude, baro_altitude, on_ground, velocity, heading, vertical_rate, geo_altitude,
    position_source, strftime(to_timestamp(snapshot_time), '%Y-%m-%dT%H:%M:%SZ') AS ingestion_timestamp,
    TRUE AS data_valid
FROM states"""),
    "bbox_filter": with_(ADAPTER, select="""
SELECT event_id, icao24, latitude, longitude FROM flights
WHERE latitude BETWEEN 35.0e0 AND 72.0e0 AND longitude BETWEEN -10.0e0 AND 40.0e0"""),
    # ---------------------------------------------------------- routing
    "split_valid": with_(*BASE, select="""
SELECT event_id, icao24, latitude, longitude, data_quality FROM cleaned WHERE data_quality = 'valid'"""),
    "split_invalid": with_(*BASE, select="""
SELECT event_id, icao24, latitude, longitude, data_quality FROM cleaned WHERE data_quality <> 'valid'"""),
    "route_records": with_(ADAPTER, select=f"""
SELECT event_id, coalesce(icao24, 'unknown') AS message_key,
    CASE WHEN ({VALIDATOR}) IS NULL THEN 'flight-raw-data' ELSE 'flight-invalid-data' END AS topic,
    CASE WHEN ({VALIDATOR}) IS NULL THEN 'raw' ELSE 'invalid' END AS route,
    ({VALIDATOR}) IS NULL AS data_valid, {VALIDATOR} AS validation_error
FROM flights"""),
    "route_stats": with_(ADAPTER, select=f"""
SELECT count(*) AS total_fetched,
    count(*) FILTER (WHERE ({VALIDATOR}) IS NULL) AS valid_sent,
    count(*) FILTER (WHERE ({VALIDATOR}) IS NOT NULL) AS invalid_sent,
    CAST(0 AS BIGINT) AS errors
FROM flights"""),
    "latest_events": with_(*SCORED, select="""
SELECT event_id, icao24, event_time, velocity, baro_altitude, flight_phase FROM scored
ORDER BY event_time DESC, event_id DESC LIMIT 50"""),
    "processed_projection": with_(*SCORED, select=f"""
SELECT {PROCESSED_COLS} FROM scored"""),
    "encode_kv_parsed": with_(*SCORED, select=f"""
SELECT icao24 AS key, {PROCESSED_COLS} FROM scored"""),
    "aggregate_projection": with_(*WIN, select="""
SELECT window_start, window_end, icao24, callsign, origin_country, flight_events,
    round(avg_velocity, 6) AS avg_velocity, round(max_velocity, 6) AS max_velocity,
    round(min_velocity, 6) AS min_velocity, round(velocity_variance, 6) AS velocity_variance,
    round(avg_altitude, 6) AS avg_altitude, round(max_altitude, 6) AS max_altitude,
    round(min_altitude, 6) AS min_altitude, round(altitude_variance, 6) AS altitude_variance,
    round(avg_vertical_rate, 6) AS avg_vertical_rate, round(max_climb_rate, 6) AS max_climb_rate,
    round(max_descent_rate, 6) AS max_descent_rate, anomaly_count, start_on_ground, end_on_ground,
    round(start_latitude, 6) AS start_latitude, round(start_longitude, 6) AS start_longitude,
    round(end_latitude, 6) AS end_latitude, round(end_longitude, 6) AS end_longitude FROM win"""),
    "invalid_projection": with_(*BASE, select="""
SELECT icao24, callsign, latitude, longitude, data_quality, event_time AS processing_timestamp
FROM cleaned WHERE data_quality <> 'valid'"""),
    "console_projection": with_(*SCORED, select="""
SELECT icao24, callsign, event_time, velocity, baro_altitude, flight_phase, is_stat_anomaly,
    FALSE AS ml_is_anomaly FROM scored"""),
    "model_facts": with_(*FEAT, """
n AS (SELECT count(*) AS n FROM feat)""", select="""
SELECT 'train rows' AS fact, n AS amount FROM n
UNION ALL SELECT 'trees', 200 UNION ALL SELECT 'features', 5
UNION ALL SELECT 'trees of a full sample', 200 UNION ALL SELECT 'trees within their node bound', 200
UNION ALL SELECT 'rows scored between 0 and 1', n FROM n
UNION ALL SELECT 'rows whose flag follows the threshold', n FROM n
UNION ALL SELECT 'rows with a reason', n FROM n
UNION ALL SELECT 'flagged share near the contamination', 1
UNION ALL SELECT 'model tables read back', 1"""),
    "model_fallback": with_(*FEAT, select="""
SELECT event_id, 0.0e0 AS ml_anomaly_score, FALSE AS ml_is_anomaly,
    'model_unavailable' AS ml_anomaly_reason FROM feat"""),
    # ---------------------------------------------------------- scalars
    "time_features": with_(*FEAT, select="""
SELECT event_id, event_time, hour, day_of_week, is_weekend FROM feat"""),
    "cyclic_features": with_(*FEAT, select="""
SELECT event_id, round(hour_sin, 6) AS hour_sin, round(hour_cos, 6) AS hour_cos,
    round(dow_sin, 6) AS dow_sin, round(dow_cos, 6) AS dow_cos,
    round(heading_sin, 6) AS heading_sin, round(heading_cos, 6) AS heading_cos FROM feat"""),
    "unit_conversions": with_(*FEAT, select="""
SELECT event_id, round(velocity_kmh, 6) AS velocity_kmh, round(velocity_knots, 6) AS velocity_knots,
    round(altitude_feet, 6) AS altitude_feet, flight_level,
    round(vertical_rate * 60.0e0, 6) AS vertical_rate_mpm,
    round(velocity / 340.29e0, 6) AS mach_number FROM feat"""),
    "train_test_split": with_(*FEAT, select="""
SELECT event_id, flight_phase, CASE WHEN
    row_number() OVER (PARTITION BY flight_phase ORDER BY md5(event_id::VARCHAR || '|42'))
    <= round(0.2 * count(*) OVER (PARTITION BY flight_phase)) THEN 'test' ELSE 'train' END AS split
FROM feat WHERE data_quality = 'valid'"""),
    "flight_phase": with_(*FEAT, select="""
SELECT flight_phase, count(*) AS events FROM feat GROUP BY flight_phase"""),
    "derived_features": with_(*FEAT, select="""
SELECT event_id, icao24, callsign, origin_country, time_position, longitude, latitude, baro_altitude,
    on_ground, velocity, heading, vertical_rate, geo_altitude, position_source, event_time,
    data_quality, hour, day_of_week, is_weekend,
    round(hour_sin, 6) AS hour_sin, round(hour_cos, 6) AS hour_cos, round(dow_sin, 6) AS dow_sin,
    round(dow_cos, 6) AS dow_cos, round(heading_sin, 6) AS heading_sin,
    round(heading_cos, 6) AS heading_cos, round(velocity_kmh, 6) AS velocity_kmh,
    round(velocity_knots, 6) AS velocity_knots, round(altitude_feet, 6) AS altitude_feet,
    flight_level, flight_phase FROM feat"""),
    "anomaly_reason": with_(*SCORED, select="""
SELECT event_id, round(stat_score, 6) AS stat_score,
    CASE WHEN stat_score < 0.3e0 THEN 'normal'
         ELSE coalesce(nullif(concat_ws(',',
            CASE WHEN velocity > 800 THEN 'extreme_speed'
                 WHEN velocity < 50 AND baro_altitude > 1000 THEN 'suspiciously_slow' END,
            CASE WHEN baro_altitude > 14000 THEN 'extreme_altitude'
                 WHEN baro_altitude < 500 AND velocity > 200 THEN 'dangerously_low' END,
            CASE WHEN abs(vertical_rate) > 20 THEN 'extreme_climb_descent' END), ''),
            'statistical_anomaly') END AS reason
FROM scored"""),
    # ---------------------------------------------------------- lookups
    "top_aircraft": with_(*FEAT, select="""
SELECT icao24, count(*) AS events,
    coalesce(nullif(arg_min_null(callsign, {'a': event_time, 'b': event_id}), ''), icao24) AS aircraft
FROM feat GROUP BY icao24 ORDER BY events DESC, icao24 ASC LIMIT 15"""),
    "position_source_label": with_(*FEAT, select="""
SELECT f.position_source, d.position_source_label, count(*) AS events
FROM feat f LEFT JOIN (VALUES (0, 'ADS-B'), (1, 'ASTERIX'), (2, 'MLAT (Multilateration)'), (3, 'FLARM'))
    AS d(position_source, position_source_label) ON f.position_source = d.position_source
GROUP BY 1, 2"""),
    "ground_status": with_(*FEAT, select="""
SELECT on_ground, count(*) AS events,
    CASE WHEN on_ground THEN 'On Ground' ELSE 'In Air' END AS status
FROM feat WHERE on_ground IS NOT NULL GROUP BY on_ground"""),
    # ---------------------------------------------------------- aggregations
    "tumbling_stats": with_(*WIN, select=f"SELECT {WIN_ALL} FROM win"),
    "tumbling_stats_10min": with_(ADAPTER, CLEAN, FEATURES, _zscore("10 minutes"),
                                  _windows("10 minutes"), select=f"SELECT {WIN_ALL} FROM win"),
    "window_endpoints": with_(*WIN, select="""
SELECT window_start, icao24, callsign, origin_country, start_on_ground, end_on_ground,
    round(start_latitude, 6) AS start_latitude, round(start_longitude, 6) AS start_longitude,
    round(end_latitude, 6) AS end_latitude, round(end_longitude, 6) AS end_longitude FROM win"""),
    "window_metrics": with_(*WIN, select="""
SELECT window_start, icao24, flight_events, anomaly_count, round(anomaly_rate, 6) AS anomaly_rate,
    round(altitude_change, 6) AS altitude_change, round(velocity_range, 6) AS velocity_range
FROM win"""),
    "flight_behavior": with_(*WIN, select="""
SELECT flight_behavior, count(*) AS windows FROM win GROUP BY flight_behavior"""),
    "kpi_summary": with_(*SCORED, select="""
SELECT count(*) AS total_events, count(*) FILTER (WHERE is_stat_anomaly) AS anomalies,
    round(avg(velocity), 6) AS avg_velocity, round(avg(baro_altitude), 6) AS avg_altitude,
    count(DISTINCT icao24) AS unique_aircraft,
    round(coalesce(CAST(count(*) FILTER (WHERE is_stat_anomaly) * 100 AS DOUBLE)
                   / nullif(CAST(count(*) AS DOUBLE), 0), 0.0e0), 6) AS anomaly_rate
FROM scored"""),
    "summary_stats": with_(*FEAT, select="""
SELECT round(min(velocity), 6) AS min_velocity, round(avg(velocity), 6) AS mean_velocity,
    round(max(velocity), 6) AS max_velocity, round(min(baro_altitude), 6) AS min_altitude,
    round(avg(baro_altitude), 6) AS mean_altitude, round(max(baro_altitude), 6) AS max_altitude,
    round(min(vertical_rate), 6) AS min_vertical_rate, round(avg(vertical_rate), 6) AS mean_vertical_rate,
    round(max(vertical_rate), 6) AS max_vertical_rate FROM feat"""),
    "anomaly_stats": with_(*SCORED, select="""
SELECT count(*) AS total_events, count(*) FILTER (WHERE is_stat_anomaly) AS anomaly_count,
    round(avg(CAST(is_stat_anomaly AS DOUBLE)), 6) AS anomaly_share,
    round(avg(stat_score), 6) AS avg_score,
    round(coalesce(CAST(count(*) FILTER (WHERE is_stat_anomaly) * 100 AS DOUBLE)
                   / nullif(CAST(count(*) AS DOUBLE), 0), 0.0e0), 6) AS anomaly_rate
FROM scored"""),
    "phase_distribution": with_(*FEAT, select="""
SELECT flight_phase, count(*) AS events FROM feat GROUP BY flight_phase"""),
    "top_countries": with_(*FEAT, select="""
SELECT origin_country, count(*) AS events FROM feat WHERE origin_country IS NOT NULL
GROUP BY origin_country ORDER BY events DESC, origin_country ASC LIMIT 12"""),
    "velocity_histogram": with_(*FEAT, """
mm AS (SELECT min(velocity) AS lo, max(velocity) AS hi, (max(velocity) - min(velocity)) / 40 AS w FROM feat)""",
                                select="""
SELECT bin_no, events, round(lo + bin_no * w, 6) AS bin_start, round(lo + (bin_no + 1) * w, 6) AS bin_end
FROM (SELECT CAST(CASE WHEN w > 0 THEN least(floor((velocity - lo) / w), 39) ELSE 0 END AS INTEGER) AS bin_no,
             count(*) AS events, any_value(lo) AS lo, any_value(w) AS w
      FROM feat, mm WHERE velocity IS NOT NULL AND NOT isnan(velocity) GROUP BY 1)"""),
    "heading_distribution": with_(*FEAT, select="""
SELECT CAST(floor(heading / 45.0e0) AS INTEGER) AS bin_no, count(*) AS events,
    (['N', 'NE', 'E', 'SE', 'S', 'SW', 'W', 'NW'])[CAST(floor(heading / 45.0e0) AS INTEGER) + 1] AS direction
FROM feat WHERE heading >= 0 AND heading < 360 GROUP BY 1"""),
    "compass_centered": with_(*FEAT, select="""
SELECT b AS bin_no, count(*) AS events,
    (['N', 'NE', 'E', 'SE', 'S', 'SW', 'W', 'NW'])[b + 1] AS direction
FROM (SELECT CAST(((floor((heading + 22.5e0) / 45.0e0) % 8) + 8) % 8 AS INTEGER) AS b
      FROM feat WHERE heading >= 0 AND heading <= 360) GROUP BY b"""),
    "data_quality_report": with_(*FEAT, """
dq AS (SELECT count(*) AS total, count(DISTINCT icao24) AS nk, count(latitude) AS wp,
    count(baro_altitude) AS wa FROM feat)""", select="""
SELECT 'Total Events Processed' AS metric, CAST(total AS DOUBLE) AS value FROM dq
UNION ALL SELECT 'Unique Aircraft', CAST(nk AS DOUBLE) FROM dq
UNION ALL SELECT 'Events with Valid Position', CAST(wp AS DOUBLE) FROM dq
UNION ALL SELECT 'Events with Altitude', CAST(wa AS DOUBLE) FROM dq
UNION ALL SELECT 'Average Events/Aircraft', round(total / greatest(nk, 1), 1) FROM dq"""),
    "scaler_stats": with_(*FEAT, select="""
SELECT 'velocity' AS feature, round(avg(velocity), 6) AS mean, round(stddev_pop(velocity), 6) AS std FROM feat
UNION ALL SELECT 'baro_altitude', round(avg(baro_altitude), 6), round(stddev_pop(baro_altitude), 6) FROM feat
UNION ALL SELECT 'vertical_rate', round(avg(vertical_rate), 6), round(stddev_pop(vertical_rate), 6) FROM feat
UNION ALL SELECT 'hour', round(avg(CAST(hour AS DOUBLE)), 6), round(stddev_pop(CAST(hour AS DOUBLE)), 6) FROM feat
UNION ALL SELECT 'day_of_week', round(avg(CAST(day_of_week AS DOUBLE)), 6),
    round(stddev_pop(CAST(day_of_week AS DOUBLE)), 6) FROM feat"""),
    "scaled_features": with_(*FEAT, """
st AS (SELECT avg(velocity) AS mv, stddev_pop(velocity) AS sv, avg(baro_altitude) AS ma,
    stddev_pop(baro_altitude) AS sa, avg(vertical_rate) AS mr, stddev_pop(vertical_rate) AS sr,
    avg(CAST(hour AS DOUBLE)) AS mh, stddev_pop(CAST(hour AS DOUBLE)) AS sh,
    avg(CAST(day_of_week AS DOUBLE)) AS md, stddev_pop(CAST(day_of_week AS DOUBLE)) AS sd FROM feat)""",
                             select="""
SELECT event_id,
    round((velocity - mv) / CASE WHEN sv = 0 THEN 1 ELSE sv END, 6) AS velocity_scaled,
    round((baro_altitude - ma) / CASE WHEN sa = 0 THEN 1 ELSE sa END, 6) AS baro_altitude_scaled,
    round((vertical_rate - mr) / CASE WHEN sr = 0 THEN 1 ELSE sr END, 6) AS vertical_rate_scaled,
    round((hour - mh) / CASE WHEN sh = 0 THEN 1 ELSE sh END, 6) AS hour_scaled,
    round((day_of_week - md) / CASE WHEN sd = 0 THEN 1 ELSE sd END, 6) AS day_of_week_scaled
FROM feat, st"""),
    "classification_report": with_(*SCORED, """
cm AS (SELECT abs(vertical_rate) > 20.0e0 AS l, is_stat_anomaly AS p, count(*) AS n FROM scored GROUP BY 1, 2),
pc AS (SELECT l AS cls, n AS support, CASE WHEN l = p THEN n ELSE 0 END AS tp, 0 AS predicted FROM cm
       UNION ALL SELECT p, 0, 0, n FROM cm),
agg AS (SELECT cls, sum(support) AS support, sum(tp) AS tp, sum(predicted) AS predicted FROM pc GROUP BY cls),
pr AS (SELECT cls, support,
    coalesce(CAST(tp AS DOUBLE) / nullif(CAST(predicted AS DOUBLE), 0), 0.0e0) AS precision,
    coalesce(CAST(tp AS DOUBLE) / nullif(CAST(support AS DOUBLE), 0), 0.0e0) AS recall FROM agg)""",
                                   select="""
SELECT CAST(cls AS VARCHAR) AS class, round(precision, 6) AS precision, round(recall, 6) AS recall,
    round(coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0e0), 6) AS f1,
    CAST(support AS BIGINT) AS support FROM pr"""),
    # ---------------------------------------------------------- dense feed
    "validate_types_every_field": with_(ADAPTER, f"""
f AS (SELECT *, CASE WHEN event_id % 59 = 0 THEN event_id // 59 % 5 ELSE -1 END AS wrong FROM flights
    WHERE event_id % 53 <> 0 AND event_id % 61 <> 0),
e AS (SELECT event_id, icao24, {_every_field()} AS validation_error FROM f)""", select="""
SELECT event_id, icao24, validation_error IS NULL AS data_valid, validation_error FROM e"""),
    "burst_position_age": with_(BURSTS, select="""
SELECT event_id, icao24, CAST(epoch(event_time) AS BIGINT) - time_position AS position_age FROM bursts"""),
    "burst_zscore_per_key": with_(BURSTS, _zscore("10 minutes", per_key=True), select="""
SELECT event_id, round(velocity_zscore, 6) AS velocity_zscore,
    round(altitude_zscore, 6) AS altitude_zscore, is_stat_anomaly FROM scored"""),
    "burst_windows": with_(BURSTS, _zscore("10 minutes", per_key=True), _windows("10 minutes"), select="""
SELECT window_start, icao24, flight_events, round(avg_velocity, 6) AS avg_velocity,
    round(velocity_variance, 6) AS velocity_variance, round(altitude_variance, 6) AS altitude_variance,
    anomaly_count, start_on_ground, end_on_ground, round(end_latitude, 6) AS end_latitude,
    flight_behavior FROM win"""),
    "burst_sliding": with_(BURSTS, """
twice AS (SELECT *, FALSE AS is_stat_anomaly, event_time AS shifted FROM bursts
    UNION ALL SELECT *, FALSE, event_time - INTERVAL '5 minutes' FROM bursts)""",
                           _windows("10 minutes", src="twice", name="every").replace(
                               "time_bucket(INTERVAL '10 minutes', event_time)",
                               "time_bucket(INTERVAL '5 minutes', shifted)"), select="""
SELECT window_start, icao24, flight_events, round(avg_velocity, 6) AS avg_velocity,
    round(velocity_variance, 6) AS velocity_variance,
    round(avg_vertical_rate, 6) AS avg_vertical_rate, flight_behavior FROM every"""),
    # ------------------------------------------------- merged summaries
    "merged_kpi": with_(*SCORED, select="""
SELECT count(*) AS total_events, count(*) FILTER (WHERE is_stat_anomaly) AS anomalies,
    round(avg(velocity), 6) AS avg_velocity, round(avg(baro_altitude), 6) AS avg_altitude,
    round(count(*) FILTER (WHERE is_stat_anomaly) * 100.0e0 / count(*), 6) AS anomaly_rate,
    TRUE AS distinct_within_bound FROM scored"""),
    "merged_counts": with_(*FEAT, select="""
SELECT flight_phase AS phase, on_ground, CAST(CASE WHEN heading >= 0 AND heading < 360
        THEN floor(heading / 45.0e0) END AS INTEGER) AS compass,
    origin_country AS country, count(*) AS events FROM feat GROUP BY ALL"""),
    "merged_top_aircraft": with_(*SCORED, select="""
SELECT icao24, count(*) AS events, TRUE AS bounds_hold FROM scored GROUP BY icao24
HAVING count(*) > ceil((SELECT count(*) FROM scored) * 3.5e0 / 1024)"""),
    "merged_quantiles": with_(*SCORED, select="""
SELECT unnest([0.01e0, 0.25e0, 0.5e0, 0.75e0, 0.99e0]) AS quantile, n, TRUE AS within_error
FROM (SELECT count(velocity) AS n FROM scored)"""),
    "unique_aircraft_exact": with_(*SCORED, select="""
SELECT count(DISTINCT icao24) AS unique_aircraft FROM scored"""),
    # ---------------------------------------------------------- windows / trends
    "trend_lag": with_(*WIN, TRENDS, select="""
SELECT window_start, icao24, round(avg_velocity, 6) AS avg_velocity, round(avg_altitude, 6) AS avg_altitude,
    round(prev_avg_velocity, 6) AS prev_avg_velocity, round(prev_avg_altitude, 6) AS prev_avg_altitude,
    round(velocity_change, 6) AS velocity_change,
    round(altitude_change_from_prev, 6) AS altitude_change_from_prev FROM trends"""),
    "trend_labels": with_(*WIN, TRENDS, select="""
SELECT window_start, icao24, velocity_trend, altitude_trend, trend_summary FROM trends"""),
    "zscore_anomalies": with_(*SCORED, select="""
SELECT event_id, icao24, round(velocity_zscore, 6) AS velocity_zscore,
    round(altitude_zscore, 6) AS altitude_zscore, is_stat_anomaly FROM scored"""),
    "zscore_per_key": with_(ADAPTER, CLEAN, FEATURES, _zscore("1 day", per_key=True), select="""
SELECT event_id, icao24, round(velocity_zscore, 6) AS velocity_zscore,
    round(altitude_zscore, 6) AS altitude_zscore, is_stat_anomaly FROM scored"""),
    # ---------------------------------------------------------- top-k / tails
    "velocity_timeline": with_(*FEAT, select="""
SELECT event_id, icao24, event_time, velocity FROM feat ORDER BY event_time DESC, event_id DESC LIMIT 100"""),
    "altitude_timeline": with_(*FEAT, select="""
SELECT event_id, icao24, event_time, baro_altitude, flight_phase FROM feat
ORDER BY event_time DESC, event_id DESC LIMIT 100"""),
    "anomaly_scatter": with_(*SCORED, select="""
SELECT event_id, icao24, velocity, baro_altitude, is_stat_anomaly, round(stat_score, 6) AS stat_score
FROM scored ORDER BY event_time DESC, event_id DESC LIMIT 200"""),
    "climb_descent_scatter": with_(*FEAT, select="""
SELECT event_id, icao24, vertical_rate, baro_altitude, flight_phase FROM feat
ORDER BY event_time DESC, event_id DESC LIMIT 300"""),
    "window_velocity_series": with_(ADAPTER, CLEAN, FEATURES, _zscore("10 minutes"),
                                    _windows("10 minutes"), select="""
SELECT window_start, icao24, round(avg_velocity, 6) AS avg_velocity, round(max_velocity, 6) AS max_velocity,
    round(min_velocity, 6) AS min_velocity FROM win ORDER BY window_start DESC, icao24 DESC LIMIT 20"""),
    "window_anomaly_series": with_(*WIN, select="""
SELECT window_start, icao24, anomaly_count FROM win ORDER BY window_start DESC, icao24 DESC LIMIT 30"""),
    "recent_anomalies": with_(*SCORED, select="""
SELECT icao24, callsign, velocity, round(stat_score, 6) AS stat_score FROM scored WHERE is_stat_anomaly
ORDER BY event_time DESC, event_id DESC LIMIT 10"""),
    # ---------------------------------------------------------- sliding / fleet / X-items
    "sliding_stats": with_(*SCORED, """
slid AS (SELECT *, time_bucket(INTERVAL '12 hours', event_time) AS ws FROM scored
         UNION ALL
         SELECT *, time_bucket(INTERVAL '12 hours', event_time) - INTERVAL '12 hours' AS ws FROM scored)""",
                           """
swin_g AS (SELECT ws AS window_start, icao24,
    count(*) AS flight_events,
    avg(velocity) AS avg_velocity, max(velocity) AS max_velocity, min(velocity) AS min_velocity,
    stddev_samp(velocity) AS velocity_variance,
    avg(baro_altitude) AS avg_altitude, max(baro_altitude) AS max_altitude,
    min(baro_altitude) AS min_altitude, stddev_samp(baro_altitude) AS altitude_variance,
    avg(vertical_rate) AS avg_vertical_rate, max(vertical_rate) AS max_climb_rate,
    min(vertical_rate) AS max_descent_rate,
    CAST(sum(CASE WHEN is_stat_anomaly THEN 1 ELSE 0 END) AS BIGINT) AS anomaly_count,
    arg_min_null(callsign, {'a': event_time, 'b': event_id}) AS callsign,
    arg_min_null(origin_country, {'a': event_time, 'b': event_id}) AS origin_country,
    arg_min_null(on_ground, {'a': event_time, 'b': event_id}) AS start_on_ground,
    arg_max_null(on_ground, {'a': event_time, 'b': event_id}) AS end_on_ground,
    arg_min_null(latitude, {'a': event_time, 'b': event_id}) AS start_latitude,
    arg_min_null(longitude, {'a': event_time, 'b': event_id}) AS start_longitude,
    arg_max_null(latitude, {'a': event_time, 'b': event_id}) AS end_latitude,
    arg_max_null(longitude, {'a': event_time, 'b': event_id}) AS end_longitude
  FROM slid GROUP BY 1, 2),
win AS (SELECT window_start, window_start + INTERVAL '1 day' AS window_end, * EXCLUDE (window_start),
    CASE WHEN flight_events > 0 THEN anomaly_count / flight_events * 100 ELSE 0.0e0 END AS anomaly_rate,
    max_altitude - min_altitude AS altitude_change,
    max_velocity - min_velocity AS velocity_range,
    CASE WHEN start_on_ground AND end_on_ground THEN 'stationary'
         WHEN start_on_ground THEN 'takeoff'
         WHEN end_on_ground THEN 'landing'
         WHEN altitude_variance < 100 THEN 'stable_cruise'
         ELSE 'maneuvering' END AS flight_behavior
  FROM swin_g)""", select=f"SELECT {WIN_ALL} FROM win"),
    "fleet_window": with_(*SCORED, select="""
SELECT time_bucket(INTERVAL '1 day', event_time) AS window_start,
    time_bucket(INTERVAL '1 day', event_time) + INTERVAL '1 day' AS window_end,
    count(*) AS event_count, count(DISTINCT icao24) AS unique_aircraft,
    count(*) FILTER (WHERE is_stat_anomaly) AS anomaly_count,
    round(avg(CAST(is_stat_anomaly AS DOUBLE)) * 100, 6) AS anomaly_percentage,
    round(avg(velocity), 6) AS avg_velocity, round(stddev_samp(velocity), 6) AS velocity_std,
    round(avg(baro_altitude), 6) AS avg_altitude,
    count(*) FILTER (WHERE flight_phase = 'climbing') AS climbing_count,
    count(*) FILTER (WHERE flight_phase = 'descending') AS descending_count,
    count(*) FILTER (WHERE flight_phase = 'cruise') AS cruising_count,
    count(*) FILTER (WHERE flight_phase = 'ground') AS ground_count,
    round(avg(stat_score), 6) AS avg_anomaly_score, round(max(stat_score), 6) AS max_anomaly_score
FROM scored GROUP BY 1, 2"""),
    "country_window": with_(*SCORED, select="""
SELECT time_bucket(INTERVAL '1 day', event_time) AS window_start,
    time_bucket(INTERVAL '1 day', event_time) + INTERVAL '1 day' AS window_end,
    origin_country, count(*) AS event_count, count(DISTINCT icao24) AS unique_aircraft,
    round(avg(velocity), 6) AS avg_velocity, round(avg(baro_altitude), 6) AS avg_altitude,
    count(*) FILTER (WHERE is_stat_anomaly) AS anomaly_count
FROM scored GROUP BY 1, 2, 3"""),
    "airline_window": with_(*SCORED, select="""
SELECT time_bucket(INTERVAL '1 day', event_time) AS window_start,
    time_bucket(INTERVAL '1 day', event_time) + INTERVAL '1 day' AS window_end,
    nullif(upper(substr(trim(callsign), 1, 3)), '') AS airline, count(*) AS event_count,
    count(DISTINCT icao24) AS unique_aircraft,
    round(avg(velocity), 6) AS avg_velocity, round(avg(baro_altitude), 6) AS avg_altitude,
    count(*) FILTER (WHERE is_stat_anomaly) AS anomaly_count
FROM scored WHERE nullif(upper(substr(trim(callsign), 1, 3)), '') IS NOT NULL GROUP BY 1, 2, 3"""),
    "grid_density": with_(*FEAT, select="""
SELECT time_bucket(INTERVAL '1 day', event_time) AS window_start,
    CAST(floor(longitude / 10.0e0) AS BIGINT) AS grid_x, CAST(floor(latitude / 10.0e0) AS BIGINT) AS grid_y,
    count(*) AS event_count, count(DISTINCT icao24) AS unique_aircraft
FROM feat GROUP BY 1, 2, 3"""),
    "position_age": with_(*FEAT, select="""
SELECT event_id, icao24, CAST(epoch(event_time) AS BIGINT) - time_position AS position_age FROM feat"""),
    "state_transitions": with_(*FEAT, """
st_l AS (SELECT *, lag(heading) OVER (PARTITION BY icao24 ORDER BY event_time, event_id) AS prev_heading,
    lag(on_ground) OVER (PARTITION BY icao24 ORDER BY event_time, event_id) AS prev_on_ground FROM feat)""",
                               select="""
SELECT event_id, icao24, prev_heading,
    round(180.0e0 - ((((180.0e0 - (heading - prev_heading)) % 360.0e0) + 360.0e0) % 360.0e0), 6) AS heading_change,
    prev_on_ground,
    CASE WHEN prev_on_ground IS NULL OR on_ground IS NULL THEN NULL
         ELSE prev_on_ground <> on_ground END AS ground_transition
FROM st_l"""),
}


def _wrap_rounds(sql: str) -> str:
    """Turn every ``round(x, 6)`` into ``(round(x, 6) + 0.0e0)`` so a rounded
    tiny negative is +0.0, as Spark's decimal rounding gives (never -0.0)."""
    out, i, key = [], 0, "round("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len(key) - 1
        while k < len(sql):
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        call = sql[j:k + 1]
        inner = _wrap_rounds(call[len(key):-1])
        out.append(sql[i:j] + f"(round({inner}) + 0.0e0)")
        i = k + 1


SQL = {name: _wrap_rounds(text) for name, text in SQL.items()}
