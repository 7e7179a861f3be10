"""Feature operators: time, cyclic, unit conversions, flight phase, grid cell,
position age, per-entity state transitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackstream import schema as S
from trackstream.functions import expressions as X
from trackstream.schema import FLIGHT, FlightColumns


def add_time_features(df: DataFrame, *, cols: FlightColumns = FLIGHT) -> DataFrame:
    """hour, day_of_week (1 = Sunday), is_weekend."""
    t = cols.event_time
    return df.withColumns({
        "hour": X.hour_of(t),
        "day_of_week": X.day_of_week(t),
        "is_weekend": X.is_weekend(t),
    })


def add_cyclic_features(df: DataFrame, *, cols: FlightColumns = FLIGHT) -> DataFrame:
    """sin/cos of hour (period 24), weekday (period 7), heading (360)."""
    hs, hc = X.cyclic("hour", 24.0)
    ds, dc = X.cyclic("day_of_week", 7.0)
    gs, gc = X.cyclic(cols.heading, 360.0)
    return df.withColumns({"hour_sin": hs, "hour_cos": hc, "dow_sin": ds, "dow_cos": dc,
                           "heading_sin": gs, "heading_cos": gc})


def add_unit_conversions(df: DataFrame, *, cols: FlightColumns = FLIGHT,
                         extended: bool = False) -> DataFrame:
    """F5/F6 (+X8 when ``extended``): km/h, knots, feet, flight level
    (truncating), and optionally vertical rate in m/min and Mach number."""
    out = df.withColumns({
        "velocity_kmh": F.col(cols.velocity) * S.MS_TO_KMH,
        "velocity_knots": F.col(cols.velocity) * S.MS_TO_KNOTS,
        "altitude_feet": F.col(cols.altitude) * S.M_TO_FEET,
    })
    out = out.withColumn("flight_level", X.truncating_int(F.col("altitude_feet") / 100))
    if extended:
        out = out.withColumns({
            "vertical_rate_mpm": F.col(cols.vertical_rate) * S.MS_TO_M_PER_MIN,
            "mach_number": F.col(cols.velocity) / S.SPEED_OF_SOUND_MS,
        })
    return out


def add_flight_phase(df: DataFrame, *, cols: FlightColumns = FLIGHT) -> DataFrame:
    """ground / takeoff_landing / climbing / descending / cruise."""
    return df.withColumn(cols.phase, X.flight_phase(cols.on_ground, cols.altitude,
                                                    cols.vertical_rate))


def add_derived_features(df: DataFrame, *, cols: FlightColumns = FLIGHT,
                         processing_time: bool = True) -> DataFrame:
    """F8: the whole feature stage in two projections (CollapseProject merges
    them).  ``processing_timestamp`` is ``current_timestamp()`` (constant per
    query / micro-batch); pass ``processing_time=False`` for reproducible output."""
    out = df
    if processing_time:
        out = out.withColumn("processing_timestamp", F.current_timestamp())
    return (out.transform(add_time_features, cols=cols)
               .transform(add_cyclic_features, cols=cols)
               .transform(add_unit_conversions, cols=cols)
               .transform(add_flight_phase, cols=cols))


def add_grid_cell(df: DataFrame, *, cols: FlightColumns = FLIGHT,
                  size_deg: float = 1.0) -> DataFrame:
    """grid_x / grid_y cell of ``size_deg`` degrees."""
    return df.withColumns({
        "grid_x": F.floor(F.col(cols.lon) / F.lit(size_deg)),
        "grid_y": F.floor(F.col(cols.lat) / F.lit(size_deg)),
    })


def add_position_age(df: DataFrame, *, cols: FlightColumns = FLIGHT) -> DataFrame:
    """Seconds between the event time and the last position fix."""
    return df.withColumn(
        "position_age",
        F.unix_seconds(F.col(cols.event_time)) - F.col(cols.position_time))


def state_transitions(df: DataFrame, *, cols: FlightColumns = FLIGHT,
                      bucket: str = "1 day") -> DataFrame:
    """Per entity, ordered by (event_time, tiebreak): previous heading, the
    signed circular heading change in (-180, 180], and whether ``on_ground``
    changed.  Batch only (non-time windows are rejected in streaming).

    A hot entity is not sent to one task: rows are ordered within
    (entity, time bucket) segments.  Only a segment's first and last rows, two at
    most, are then ordered by entity, where a first row takes its predecessor from
    the last row before it.  Events are scanned and shuffled once; the result
    equals an unsplit per-entity lag.
    """
    order_cols = [cols.event_time] + ([cols.tiebreak] if cols.tiebreak in df.columns else [])
    base = df.withColumn("_tb", F.window(F.col(cols.event_time), bucket).start)
    w = Window.partitionBy(cols.key, "_tb").orderBy(*order_cols)
    state = F.struct(F.col(cols.heading).alias("h"), F.col(cols.on_ground).alias("g"))
    base = base.withColumns({"_before": F.lag(state).over(w),
                             "_first": F.row_number().over(w) == 1,
                             "_last": F.lead(F.lit(True)).over(w).isNull()})
    ends = base.filter(F.col("_first") | F.col("_last"))
    by_entity = Window.partitionBy(cols.key).orderBy(*order_cols)
    ends = ends.withColumn("_before", F.when(F.col("_first"), F.lag(state).over(by_entity))
                           .otherwise(F.col("_before")))
    out = base.filter(~F.col("_first") & ~F.col("_last")).unionByName(ends)
    out = out.withColumns({"prev_heading": F.col("_before.h"), "prev_on_ground": F.col("_before.g")}) \
        .drop("_before", "_first", "_last", "_tb")
    diff = F.col(cols.heading) - F.col("prev_heading")
    circ = F.lit(180.0) - F.pmod(F.lit(180.0) - diff, F.lit(360.0))
    return out.withColumns({
        "heading_change": circ,
        "ground_transition": (F.when(F.col("prev_on_ground").isNull()
                                     | F.col(cols.on_ground).isNull(), F.lit(None))
                              .otherwise(F.col("prev_on_ground") != F.col(cols.on_ground))),
    })
