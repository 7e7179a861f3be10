"""Flight view over the generic ``events`` table.

The driver's tables hold no aircraft; this deterministic adapter turns each
event into one flight position report with planted defects (missing keys,
missing or impossible coordinates, bad time text, exact re-deliveries) so that
every cleaning and validation branch is exercised on data that grows with the
input.  It is one projection plus a ``Generate`` (for re-deliveries) over a
single scan, whose rows are dealt evenly to tasks first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed values of the adapter (moduli that plant each defect).
REDELIVER_EVERY = 20          # id % 20 = 0 -> delivered twice
NULL_KEY_EVERY = 211
NULL_CALLSIGN_EVERY = 13
NULL_POSITION_TIME_EVERY = 97
BAD_LONGITUDE_EVERY = 151     # longitude 200
ZERO_POSITION_EVERY = 101     # latitude = longitude = 0
NULL_POSITION_MOD, NULL_POSITION_REM = 17, 3
HIGH_ALTITUDE_EVERY = 307     # altitude 60000
NULL_ALTITUDE_EVERY = 19
NULL_GROUND_EVERY = 89
NEGATIVE_SPEED_EVERY = 401    # velocity -50
BAD_HEADING_EVERY = 409       # heading 400
NULL_VRATE_EVERY = 23
BAD_TIME_EVERY = 499          # ingestion text 'not-a-time'


def flights_from_events(events: DataFrame, *, keep_source_time: bool = False) -> DataFrame:
    """``events(event_id, ts, user_id, value, ...)`` -> flight reports
    (:data:`trackstream.schema.FLIGHT_SCHEMA` plus ``event_id``; plus the
    event's ``ts`` as ``source_ts`` when ``keep_source_time``).

    Written as SQL expressions: one analysed projection instead of hundreds of
    Column round-trips while the plan is built (the plan is the same)."""
    ts = "CAST(ts AS TIMESTAMP)"           # timestamp_ntz -> session (UTC) timestamp
    baro = (f"CASE WHEN event_id % {HIGH_ALTITUDE_EVERY} = 0 THEN 60000.0D "
            f"WHEN event_id % {NULL_ALTITUDE_EVERY} = 0 THEN CAST(NULL AS DOUBLE) "
            f"ELSE CAST(event_id * 37 % 12000 AS DOUBLE) END")
    null_pos = f"event_id % {NULL_POSITION_MOD} = {NULL_POSITION_REM}"
    base = events.selectExpr(
        "event_id", "ts", "user_id", "value",
        f"explode(CASE WHEN event_id % {REDELIVER_EVERY} = 0 THEN array(0, 1) "
        f"ELSE array(0) END) AS _copy")
    exprs = [
        "event_id",
        f"CASE WHEN event_id % {NULL_KEY_EVERY} = 0 THEN CAST(NULL AS STRING) "
        f"ELSE lower(lpad(hex(user_id), 6, '0')) END AS icao24",
        f"CASE WHEN event_id % {NULL_CALLSIGN_EVERY} = 0 THEN CAST(NULL AS STRING) "
        f"ELSE concat('FLT', CAST(user_id AS STRING), ' ') END AS callsign",
        "concat('NATION_', CAST(user_id % 25 AS STRING)) AS origin_country",
        f"CASE WHEN event_id % {NULL_POSITION_TIME_EVERY} = 0 THEN CAST(NULL AS BIGINT) "
        f"ELSE unix_seconds({ts}) END AS time_position",
        f"CASE WHEN event_id % {BAD_LONGITUDE_EVERY} = 0 THEN 200.0D "
        f"WHEN event_id % {ZERO_POSITION_EVERY} = 0 THEN 0.0D "
        f"WHEN {null_pos} THEN CAST(NULL AS DOUBLE) "
        f"ELSE (event_id * 7919 % 36000) / 100.0D - 180.0D END AS longitude",
        f"CASE WHEN event_id % {ZERO_POSITION_EVERY} = 0 THEN 0.0D "
        f"WHEN {null_pos} THEN CAST(NULL AS DOUBLE) "
        f"ELSE (event_id * 6007 % 18000) / 100.0D - 90.0D END AS latitude",
        f"{baro} AS baro_altitude",
        f"CASE WHEN event_id % {NULL_GROUND_EVERY} = 0 THEN CAST(NULL AS BOOLEAN) "
        f"ELSE event_id % 8 = 0 END AS on_ground",
        f"CASE WHEN event_id % {NEGATIVE_SPEED_EVERY} = 0 THEN -50.0D ELSE value END AS velocity",
        f"CASE WHEN event_id % {BAD_HEADING_EVERY} = 0 THEN 400.0D "
        f"ELSE (event_id * 13 % 3601) / 10.0D END AS heading",
        f"CASE WHEN event_id % {NULL_VRATE_EVERY} = 0 THEN CAST(NULL AS DOUBLE) "
        f"ELSE (event_id * 11 % 601 - 300) / 10.0D END AS vertical_rate",
        f"{baro} + 100.0D AS geo_altitude",
        "CAST(event_id % 4 AS INT) AS position_source",
        f"CASE WHEN event_id % {BAD_TIME_EVERY} = 0 THEN 'not-a-time' "
        f"ELSE date_format({ts}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") END AS ingestion_timestamp",
        "true AS data_valid",
    ]
    if keep_source_time:
        exprs.append(f"{ts} AS source_ts")
    return base.selectExpr(*exprs)


def bursts_from_events(events: DataFrame) -> DataFrame:
    """A denser feed of the same rows: each event becomes a burst of 12 to 21 clean reports
    of its aircraft, 25 seconds apart from the start of a 10-minute window on.

    Position fixes are up to 44 seconds older than their report (some are unknown), and
    every 40th event has one report that is 600 faster than its neighbours, so windows
    hold many rows of an aircraft and its own z-scores can flag one."""
    base = events.selectExpr(
        "event_id", "user_id", "value",
        "unix_seconds(CAST(ts AS TIMESTAMP)) div 600 * 600 AS at",
        "explode(sequence(0L, 11L + event_id % 10)) AS k")
    return base.selectExpr(
        "event_id * 100 + k AS event_id", "lower(lpad(hex(user_id), 6, '0')) AS icao24",
        "concat('FLT', CAST(user_id AS STRING)) AS callsign",
        "concat('NATION_', CAST(user_id % 25 AS STRING)) AS origin_country",
        "timestamp_seconds(at + k * 25) AS event_time",
        "CASE WHEN (event_id + k) % 97 <> 0 THEN at + k * 25 - (event_id * 7 + k * 13) % 45 END "
        "AS time_position",
        "value + 2.0D * (k % 5) + CASE WHEN k = 6 AND event_id % 40 = 0 THEN 600.0D ELSE 0.0D END "
        "AS velocity",
        "1000.0D + event_id * 37 % 9000 + k * (event_id % 3) * 30.0D AS baro_altitude",
        "CAST(event_id * 11 % 601 - 300 AS DOUBLE) / 10.0D AS vertical_rate",
        "event_id % 8 = 0 AND k < 5 AS on_ground",
        "(event_id * 6007 % 18000) / 100.0D - 90.0D + k / 1000.0D AS latitude",
        "(event_id * 7919 % 36000) / 100.0D - 180.0D AS longitude")


#: Rows of a table that a task takes at most; fewer where each becomes a burst of reports.
ROWS_PER_TASK = 250_000
EVENTS_PER_TASK = 50_000


def ensure_parallelism(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Deal a scan's rows evenly to tasks: as many as the cluster has cores, and more once a
    task would take more than ``rows_per_task``.

    The number of splits says nothing about that: a row group lies in one split whole,
    so a file with one or a few large ones has one or a few tasks with rows, however many
    splits it has.  Rows are counted from the files' footers."""
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session has no RDD API
        return df
    return df.repartition(max(cores, -(-df.count() // rows_per_task)))


def read_table(spark: SparkSession, sf_dir: str, name: str,
               rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    return ensure_parallelism(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"),
                              rows_per_task)


def load_flights(spark: SparkSession, sf_dir: str, *, keep_source_time: bool = False
                 ) -> DataFrame:
    """Flight reports derived from ``{sf_dir}/events.parquet``."""
    return flights_from_events(read_table(spark, sf_dir, "events"),
                               keep_source_time=keep_source_time)


def load_bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dense feed derived from ``{sf_dir}/events.parquet``."""
    return bursts_from_events(read_table(spark, sf_dir, "events", EVENTS_PER_TASK))
