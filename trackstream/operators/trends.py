"""Trend labels between consecutive windows of one entity (W1-W5), batch form.

The streaming form keeps the previous window in keyed state; see
:mod:`trackstream.streaming.stateful`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackstream.functions import expressions as X


def add_trend_lag(df: DataFrame, *, key: str = "icao24", order: str = "window_start",
                  velocity: str = "avg_velocity", altitude: str = "avg_altitude",
                  max_gap: str | None = None) -> DataFrame:
    """Previous window's averages and the change from them.

    With ``max_gap`` (an interval text) a previous window that started longer ago
    counts as none, as on a stream whose state has expired.

    One shuffle on the entity key over the *windowed* table (one row per
    entity and window), so a partition holds whole tracks of many entities and
    a single entity is bounded by its number of windows.
    """
    w = Window.partitionBy(key).orderBy(order)
    near = F.lit(True) if max_gap is None else (
        F.lag(order, 1).over(w) >= F.col(order) - F.expr(f"INTERVAL {max_gap}"))
    out = df.withColumns({
        "prev_avg_velocity": F.when(near, F.lag(velocity, 1).over(w)),
        "prev_avg_altitude": F.when(near, F.lag(altitude, 1).over(w)),
    })
    return out.withColumns({
        "velocity_change": F.col(velocity) - F.col("prev_avg_velocity"),
        "altitude_change_from_prev": F.col(altitude) - F.col("prev_avg_altitude"),
    })


def add_trend_labels(df: DataFrame) -> DataFrame:
    """velocity_trend, altitude_trend, trend_summary from the W1/W2 columns."""
    out = df.withColumns({
        "velocity_trend": X.velocity_trend("prev_avg_velocity", "velocity_change"),
        "altitude_trend": X.altitude_trend("prev_avg_altitude", "altitude_change_from_prev"),
    })
    return out.withColumn("trend_summary",
                          X.trend_summary("velocity_trend", "altitude_trend"))


def calculate_trends(df: DataFrame, *, key: str = "icao24",
                     order: str = "window_start", max_gap: str | None = None) -> DataFrame:
    """W1-W5 in one call."""
    return add_trend_labels(add_trend_lag(df, key=key, order=order, max_gap=max_gap))
