"""Flight schema, column-name presets and the fixed values the operators use.

Operators are generic over column names; :data:`FLIGHT` supplies the names of
the aircraft-position preset.  The constants below are values whose exact
numbers determine results and so must stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Flight record as carried in messages (declared, never inferred).
# --------------------------------------------------------------------------
FLIGHT_SCHEMA = T.StructType([
    T.StructField("icao24", T.StringType(), False),
    T.StructField("callsign", T.StringType(), True),
    T.StructField("origin_country", T.StringType(), True),
    T.StructField("time_position", T.LongType(), True),
    T.StructField("longitude", T.DoubleType(), True),
    T.StructField("latitude", T.DoubleType(), True),
    T.StructField("baro_altitude", T.DoubleType(), True),
    T.StructField("on_ground", T.BooleanType(), True),
    T.StructField("velocity", T.DoubleType(), True),
    T.StructField("heading", T.DoubleType(), True),
    T.StructField("vertical_rate", T.DoubleType(), True),
    T.StructField("geo_altitude", T.DoubleType(), True),
    T.StructField("position_source", T.IntegerType(), True),
    T.StructField("ingestion_timestamp", T.StringType(), False),
    T.StructField("data_valid", T.BooleanType(), False),
])

FLIGHT_FIELDS = [f.name for f in FLIGHT_SCHEMA.fields]

# Message-level schema used when the adapter carries its tiebreak id along.
FLIGHT_SCHEMA_WITH_ID = T.StructType(
    [T.StructField("event_id", T.LongType(), True)] + list(FLIGHT_SCHEMA.fields))


@dataclass(frozen=True)
class FlightColumns:
    """Column names an operator reads.  Replace fields to reuse operators on
    another entity type (ships, vehicles, ...)."""

    key: str = "icao24"
    label: str = "callsign"
    category: str = "origin_country"
    position_time: str = "time_position"
    lon: str = "longitude"
    lat: str = "latitude"
    altitude: str = "baro_altitude"
    on_ground: str = "on_ground"
    velocity: str = "velocity"
    heading: str = "heading"
    vertical_rate: str = "vertical_rate"
    geo_altitude: str = "geo_altitude"
    position_source: str = "position_source"
    ingest_text: str = "ingestion_timestamp"
    data_valid: str = "data_valid"
    event_time: str = "event_time"
    tiebreak: str = "event_id"
    quality: str = "data_quality"
    phase: str = "flight_phase"
    stat_flag: str = "is_stat_anomaly"
    ml_score: str = "ml_anomaly_score"
    ml_flag: str = "ml_is_anomaly"
    ml_reason: str = "ml_anomaly_reason"

    def with_names(self, **kw) -> "FlightColumns":
        return replace(self, **kw)


FLIGHT = FlightColumns()

# --------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results)
# --------------------------------------------------------------------------

# Columns imputed with 0.0 when null or NaN, in this order.
IMPUTE_COLUMNS = ["latitude", "longitude", "baro_altitude", "velocity", "heading",
                  "vertical_rate"]

# Physical-range filter, inclusive bounds; vertical_rate is unbounded.
PHYSICAL_RANGES = {
    "latitude": (-90.0, 90.0),
    "longitude": (-180.0, 180.0),
    "baro_altitude": (-1000.0, 50000.0),
    "velocity": (0.0, 1000.0),
    "heading": (0.0, 360.0),
}

# Producer-side record validator: rules in the order they are checked; the
# first failing rule names the error.  ``None`` bound = unbounded on that side.
VALIDATION_RULES = [
    ("latitude", -90.0, 90.0),
    ("longitude", -180.0, 180.0),
    ("baro_altitude", -1000.0, 50000.0),
    ("velocity", 0.0, None),
    ("heading", 0.0, 360.0),
]
MISSING_KEY_MESSAGE = "Missing icao24"

# Bounding box of the preset feed (Europe): lat 35..72 N, lon -10..40 E.
DEFAULT_BBOX = {"lat_min": 35.0, "lat_max": 72.0, "lon_min": -10.0, "lon_max": 40.0}

# Positional state vector: slot index of each decoded field (17 slots, 0-based).
# Slots 4 (last_contact), 12 (sensors), 14 (squawk) and 15 (spi) are not decoded.
STATE_VECTOR_SLOTS = {
    "icao24": 0,
    "callsign": 1,
    "origin_country": 2,
    "time_position": 3,
    "longitude": 5,
    "latitude": 6,
    "baro_altitude": 7,
    "on_ground": 8,
    "velocity": 9,
    "heading": 10,
    "vertical_rate": 11,
    "geo_altitude": 13,
    "position_source": 16,
}
STATE_VECTOR_LENGTH = 17

# Unit conversions.
MS_TO_KMH = 3.6
MS_TO_KNOTS = 1.94384
M_TO_FEET = 3.28084
MS_TO_M_PER_MIN = 60.0
SPEED_OF_SOUND_MS = 340.29  # Mach denominator (sea level, standard atmosphere)

# Flight phase thresholds: altitude below which a moving aircraft is in
# takeoff/landing, and vertical rates for climbing / descending.
PHASE_LOW_ALTITUDE = 1000.0
PHASE_CLIMB_RATE = 5.0
PHASE_DESCENT_RATE = -5.0

# Window behaviour: altitude stddev below which a window is a stable cruise.
STABLE_CRUISE_STDDEV = 100.0

# Trend thresholds between consecutive windows.
TREND_VELOCITY_DELTA = 10.0
TREND_ALTITUDE_DELTA = 500.0

# Rule-based anomaly reasons.
REASON_SCORE_FLOOR = 0.3
REASON_EXTREME_SPEED = 800.0
REASON_SLOW_SPEED = 50.0
REASON_SLOW_MIN_ALTITUDE = 1000.0
REASON_EXTREME_ALTITUDE = 14000.0
REASON_LOW_ALTITUDE = 500.0
REASON_LOW_MIN_SPEED = 200.0
REASON_EXTREME_VERTICAL = 20.0

# Compass rose: 8 half-open 45-degree bins from 0, in display order.
COMPASS_LABELS = ["N", "NE", "E", "SE", "S", "SW", "W", "NW"]

# Position source enum labels.
POSITION_SOURCE_LABELS = [(0, "ADS-B"), (1, "ASTERIX"), (2, "MLAT (Multilateration)"), (3, "FLARM")]

# Ground status labels.
GROUND_LABELS = {True: "On Ground", False: "In Air"}

# Time windows of the streaming job.
WINDOW_DURATION = "10 minutes"
SLIDE_DURATION = "5 minutes"
WATERMARK_DELAY = "10 minutes"
TRIGGER_INTERVAL = "10 seconds"

# Topic names of the message bus: raw and rejected records of the producer; processed,
# windowed and invalid rows of the streaming job.
RAW_TOPIC = "flight-raw-data"
INVALID_TOPIC = "flight-invalid-data"
PROCESSED_TOPIC = "flight-processed-data"
AGGREGATED_TOPIC = "flight-aggregated-data"
INVALID_OUT_TOPIC = "flight-invalid-spark"

# Model defaults: isolation forest of 200 trees, 256-row sub-samples,
# contamination 1 %, seed 42, five features.
MODEL_FEATURES = ["velocity", "baro_altitude", "vertical_rate", "hour", "day_of_week"]
FOREST_TREES = 200
FOREST_SAMPLE = 256
FOREST_CONTAMINATION = 0.01
FOREST_SEED = 42

# Output projections.
PROCESSED_COLUMNS = [
    "icao24", "callsign", "origin_country", "event_time",
    "latitude", "longitude", "baro_altitude", "velocity",
    "heading", "vertical_rate", "on_ground",
    "velocity_kmh", "altitude_feet", "flight_phase",
    "hour", "day_of_week", "is_weekend",
    "is_stat_anomaly", "velocity_zscore", "altitude_zscore",
    "ml_anomaly_score", "ml_is_anomaly", "ml_anomaly_reason",
    "data_quality", "processing_timestamp",
]
INVALID_COLUMNS = ["icao24", "callsign", "latitude", "longitude", "data_quality",
                   "processing_timestamp"]
AGGREGATE_COLUMNS = [
    "window_start", "window_end", "icao24", "callsign", "origin_country", "flight_events",
    "avg_velocity", "max_velocity", "min_velocity", "velocity_variance",
    "avg_altitude", "max_altitude", "min_altitude", "altitude_variance",
    "avg_vertical_rate", "max_climb_rate", "max_descent_rate", "anomaly_count",
    "start_on_ground", "end_on_ground", "start_latitude", "start_longitude",
    "end_latitude", "end_longitude",
]
CONSOLE_COLUMNS = ["icao24", "callsign", "event_time", "velocity", "baro_altitude",
                   "flight_phase", "is_stat_anomaly", "ml_is_anomaly"]


@dataclass(frozen=True)
class PipelineConfig:
    """Knobs of the composed pipeline (batch and streaming)."""

    window: str = WINDOW_DURATION
    slide: str | None = None
    watermark: str = WATERMARK_DELAY
    zscore_window: str = WINDOW_DURATION
    zscore_threshold: float = 3.0
    zscore_per_key: bool = False
    null_keys: str = "equal"
    require_data_valid: bool = False
    #: Windows after which a silent entity's trend state expires on a stream.
    trend_expiry: int = 144
    cols: FlightColumns = field(default_factory=FlightColumns)
