"""Oracle SQL (DuckDB dialect) for the streaming queries: the batch form of what
the job publishes, with the windows that the last watermark closes."""

from __future__ import annotations

from trackstream.plans import oracle as O

# Messages that are no dead letters; the cleaned rows of all of them.  A row without a
# position time is a duplicate of its re-delivery only.
_CLEAN = (O.CLEAN.replace("FROM flights", "FROM msgs WHERE msg_defect IS NULL")
          .replace("PARTITION BY icao24, time_position", "PARTITION BY icao24, time_position, "
                   "CASE WHEN time_position IS NULL THEN event_id END"))
# z-scores look at every row within range, before the split by quality
_FEATURES = O.FEATURES.replace(" WHERE data_quality = 'valid'", "")
_BASE = (O.ADAPTER, O.MESSAGES, _CLEAN, _FEATURES, O._zscore("1 day"), """
closed AS (SELECT max(event_time) - INTERVAL '10 minutes' AS upto FROM dedup),
processed AS (SELECT * FROM scored WHERE data_quality = 'valid'
    AND time_bucket(INTERVAL '1 day', event_time) + INTERVAL '1 day' <= (SELECT upto FROM closed)),
closed_win AS (SELECT max(event_time) - INTERVAL '10 minutes' AS upto FROM processed)""", """
rejected AS (SELECT *, CASE
    WHEN NOT latitude BETWEEN -90.0e0 AND 90.0e0 THEN 'latitude_out_of_range'
    WHEN NOT longitude BETWEEN -180.0e0 AND 180.0e0 THEN 'longitude_out_of_range'
    WHEN NOT baro_altitude BETWEEN -1000.0e0 AND 50000.0e0 THEN 'baro_altitude_out_of_range'
    WHEN NOT velocity BETWEEN 0.0e0 AND 1000.0e0 THEN 'velocity_out_of_range'
    WHEN NOT heading BETWEEN 0.0e0 AND 360.0e0 THEN 'heading_out_of_range' END AS reject_reason
  FROM imputed),
invalid AS (SELECT *, 'invalid' AS data_quality FROM rejected
  WHERE (reject_reason IS NOT NULL OR (latitude = 0 AND longitude = 0))
    AND time_bucket(INTERVAL '1 day', event_time) + INTERVAL '1 day' <= (SELECT upto FROM closed))""")
_WIN = (*_BASE, O._windows("1 day", src="processed", name="every"), """
win AS (SELECT * FROM every WHERE window_end <= (SELECT upto FROM closed_win))""")

# a previous window of more than three days ago has expired
_TRENDS = O.TRENDS.replace(
    "lag(avg_velocity, 1) OVER (PARTITION BY icao24 ORDER BY window_start)",
    "CASE WHEN lag(window_start, 1) OVER w >= window_start - INTERVAL '3 days' "
    "THEN lag(avg_velocity, 1) OVER w END").replace(
    "lag(avg_altitude, 1) OVER (PARTITION BY icao24 ORDER BY window_start)",
    "CASE WHEN lag(window_start, 1) OVER w >= window_start - INTERVAL '3 days' "
    "THEN lag(avg_altitude, 1) OVER w END").replace(
    "FROM win)", "FROM win WINDOW w AS (PARTITION BY icao24 ORDER BY window_start))", 1)

_SLIDING = (*_BASE, """
twice AS (SELECT *, event_time AS shifted FROM processed
    UNION ALL SELECT *, event_time - INTERVAL '12 hours' AS shifted FROM processed)""",
            O._windows("1 day", src="twice", name="every")
            .replace("time_bucket(INTERVAL '1 day', event_time)", "time_bucket(INTERVAL '12 hours', shifted)"),
            """
win AS (SELECT * FROM every WHERE window_end <= (SELECT upto FROM closed_win))""")

STREAM_SQL = {
    "stream_processed": O.with_(*_BASE, select="""
SELECT event_id, icao24, event_time, round(velocity, 6) AS velocity,
    round(baro_altitude, 6) AS baro_altitude, flight_phase,
    round(velocity_zscore, 6) AS velocity_zscore, round(altitude_zscore, 6) AS altitude_zscore,
    is_stat_anomaly, 'model_unavailable' AS ml_anomaly_reason FROM processed"""),
    "stream_invalid": O.with_(*_BASE, select="""
SELECT icao24, data_quality, reject_reason, count(*) AS rows FROM invalid GROUP BY ALL"""),
    "stream_windows": O.with_(*_WIN, select="""
SELECT window_start, window_end, icao24, callsign, origin_country, flight_events,
    round(avg_velocity, 6) AS avg_velocity, round(velocity_variance, 6) AS velocity_variance,
    round(avg_altitude, 6) AS avg_altitude, round(altitude_variance, 6) AS altitude_variance,
    round(avg_vertical_rate, 6) AS avg_vertical_rate, anomaly_count,
    round(anomaly_rate, 6) AS anomaly_rate, start_on_ground, end_on_ground,
    round(start_latitude, 6) AS start_latitude, round(end_longitude, 6) AS end_longitude,
    round(altitude_change, 6) AS altitude_change, round(velocity_range, 6) AS velocity_range,
    flight_behavior FROM win"""),
    "stream_trends": O.with_(*_WIN, _TRENDS, select="""
SELECT window_start, icao24, round(prev_avg_velocity, 6) AS prev_avg_velocity,
    round(prev_avg_altitude, 6) AS prev_avg_altitude, velocity_trend, altitude_trend,
    trend_summary FROM trends"""),
    "stream_sliding": O.with_(*_SLIDING, select="""
SELECT window_start, window_end, icao24, flight_events, round(avg_velocity, 6) AS avg_velocity,
    round(velocity_variance, 6) AS velocity_variance, round(avg_altitude, 6) AS avg_altitude,
    round(altitude_variance, 6) AS altitude_variance,
    round(avg_vertical_rate, 6) AS avg_vertical_rate, round(max_climb_rate, 6) AS max_climb_rate,
    anomaly_count, callsign, round(end_latitude, 6) AS end_latitude, flight_behavior FROM win"""),
    "stream_accounting": O.with_(*_BASE, select="""
SELECT 'landed' AS account, count(*) AS rows FROM dedup
UNION ALL SELECT 'processed', count(*) FROM processed
UNION ALL SELECT 'invalid', count(*) FROM invalid
UNION ALL SELECT 'dead: ' || coalesce(msg_defect, CASE WHEN icao24 IS NULL THEN 'missing_key'
        ELSE 'unreadable_time' END), count(*) FROM msgs
    WHERE msg_defect IS NOT NULL OR icao24 IS NULL OR kafka_timestamp IS NULL GROUP BY 1"""),
}
