"""Column-expression builders.

Everything here returns a :class:`pyspark.sql.Column` built from
``pyspark.sql.functions`` only, so it compiles into whole-stage codegen and runs
identically in batch and streaming plans.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trackstream import schema as S

__all__ = [
    "c", "strip_text", "iso_utc_text", "parse_iso_time", "null_or_nan",
    "impute_zero", "in_range", "hour_of", "day_of_week", "is_weekend", "cyclic",
    "flight_phase", "compass_bin", "compass_label", "anomaly_reason",
    "flight_behavior", "velocity_trend", "altitude_trend", "trend_summary",
    "ground_label", "truncating_int", "safe_ratio",
]


def c(name_or_col) -> Column:
    return F.col(name_or_col) if isinstance(name_or_col, str) else name_or_col


def strip_text(x) -> Column:
    """Strip leading and trailing whitespace (tabs and newlines too, unlike
    ``trim``, which strips spaces only).  Null stays null."""
    return F.regexp_replace(c(x), r"^\s+|\s+$", "")


def iso_utc_text(ts) -> Column:
    """Format a timestamp as ``yyyy-MM-ddTHH:mm:ssZ`` (session zone is UTC)."""
    return F.date_format(c(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def parse_iso_time(text) -> Column:
    """ISO-8601 text -> TIMESTAMP; unparseable text -> NULL (never fails the job
    under ANSI mode)."""
    return F.try_to_timestamp(c(text))


def null_or_nan(x) -> Column:
    x = c(x)
    return x.isNull() | F.isnan(x)


def impute_zero(x) -> Column:
    """NULL or NaN -> 0.0."""
    x = c(x)
    return F.when(null_or_nan(x), F.lit(0.0)).otherwise(x)


def in_range(x, lo, hi) -> Column:
    """Inclusive range test; an open side is ``None``."""
    x = c(x)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (x >= F.lit(float(lo)))
    if hi is not None:
        cond = cond & (x <= F.lit(float(hi)))
    return cond


def hour_of(ts) -> Column:
    return F.hour(c(ts))


def day_of_week(ts) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(c(ts))


def is_weekend(ts) -> Column:
    return F.dayofweek(c(ts)).isin(1, 7)


def cyclic(x, period: float) -> tuple[Column, Column]:
    """(sin, cos) of ``x`` on a circle of ``period`` units."""
    angle = F.radians(c(x) * 360.0 / period) if period != 360.0 else F.radians(c(x))
    return F.sin(angle), F.cos(angle)


def truncating_int(x) -> Column:
    """Double -> INT truncating toward zero (the callers bound the input)."""
    return c(x).cast("int")


def flight_phase(on_ground, altitude, vertical_rate) -> Column:
    """ground / takeoff_landing / climbing / descending / cruise.  A NULL
    ``on_ground`` falls through to the altitude tests."""
    return (F.when(c(on_ground), F.lit("ground"))
            .when(c(altitude) < S.PHASE_LOW_ALTITUDE, F.lit("takeoff_landing"))
            .when(c(vertical_rate) > S.PHASE_CLIMB_RATE, F.lit("climbing"))
            .when(c(vertical_rate) < S.PHASE_DESCENT_RATE, F.lit("descending"))
            .otherwise(F.lit("cruise")))


def compass_bin(heading, centered: bool = False) -> Column:
    """0..7 for half-open 45-degree bins starting at 0 (N = [0,45)).  360 and
    out-of-range values get NULL.  ``centered=True`` centres N on 0 (337.5..22.5)
    and keeps 360 in N."""
    h = c(heading)
    if centered:
        return F.when((h >= 0) & (h <= 360),
                      F.pmod(F.floor((h + F.lit(22.5)) / F.lit(45.0)), F.lit(8)).cast("int"))
    return F.when((h >= 0) & (h < 360), F.floor(h / F.lit(45.0)).cast("int"))


def compass_label(bin_no) -> Column:
    labels = F.array(*[F.lit(x) for x in S.COMPASS_LABELS])
    return F.element_at(labels, c(bin_no) + 1)


def anomaly_reason(velocity, altitude, vertical_rate, score) -> Column:
    """Rule-based explanation of a score.  Below the score floor -> 'normal';
    otherwise a comma list of the rules that fire, or 'statistical_anomaly'."""
    v, a, vr, s = c(velocity), c(altitude), c(vertical_rate), c(score)
    speed = (F.when(v > S.REASON_EXTREME_SPEED, F.lit("extreme_speed"))
             .when((v < S.REASON_SLOW_SPEED) & (a > S.REASON_SLOW_MIN_ALTITUDE),
                   F.lit("suspiciously_slow")))
    alt = (F.when(a > S.REASON_EXTREME_ALTITUDE, F.lit("extreme_altitude"))
           .when((a < S.REASON_LOW_ALTITUDE) & (v > S.REASON_LOW_MIN_SPEED),
                 F.lit("dangerously_low")))
    vert = F.when(F.abs(vr) > S.REASON_EXTREME_VERTICAL, F.lit("extreme_climb_descent"))
    parts = F.concat_ws(",", speed, alt, vert)
    return (F.when(s < S.REASON_SCORE_FLOOR, F.lit("normal"))
            .otherwise(F.coalesce(F.nullif(parts, F.lit("")), F.lit("statistical_anomaly"))))


def flight_behavior(start_on_ground, end_on_ground, altitude_stddev) -> Column:
    """Window label; a NULL stddev (single-event window) is 'maneuvering'."""
    s, e = c(start_on_ground), c(end_on_ground)
    return (F.when(s & e, F.lit("stationary"))
            .when(s, F.lit("takeoff"))
            .when(e, F.lit("landing"))
            .when(c(altitude_stddev) < S.STABLE_CRUISE_STDDEV, F.lit("stable_cruise"))
            .otherwise(F.lit("maneuvering")))


def velocity_trend(prev, change) -> Column:
    return (F.when(c(prev).isNull(), F.lit("no_history"))
            .when(c(change) > S.TREND_VELOCITY_DELTA, F.lit("accelerating"))
            .when(c(change) < -S.TREND_VELOCITY_DELTA, F.lit("decelerating"))
            .otherwise(F.lit("stable_speed")))


def altitude_trend(prev, change) -> Column:
    return (F.when(c(prev).isNull(), F.lit("no_history"))
            .when(c(change) > S.TREND_ALTITUDE_DELTA, F.lit("climbing"))
            .when(c(change) < -S.TREND_ALTITUDE_DELTA, F.lit("descending"))
            .otherwise(F.lit("stable_altitude")))


def trend_summary(v_trend, a_trend) -> Column:
    v, a = c(v_trend), c(a_trend)
    return (F.when(v == "no_history", F.lit("initial_observation"))
            .when((v == "stable_speed") & (a == "stable_altitude"), F.lit("stable_flight"))
            .when(a == "climbing", F.lit("ascending"))
            .when(a == "descending", F.lit("descending"))
            .otherwise(F.lit("maneuvering")))


def ground_label(on_ground) -> Column:
    g = c(on_ground)
    return (F.when(g, F.lit(S.GROUND_LABELS[True]))
            .when(~g, F.lit(S.GROUND_LABELS[False])))


def safe_ratio(num, den) -> Column:
    """num / den, 0.0 when the denominator is 0 or NULL."""
    return F.coalesce(F.try_divide(c(num).cast("double"), c(den).cast("double")), F.lit(0.0))
