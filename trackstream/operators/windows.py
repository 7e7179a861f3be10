"""Event-time window aggregates (tumbling and sliding) per entity, per fleet,
per category and per airline.

Each is one ``groupBy(window(...), key)``: Spark plans a partial aggregate in
every map task and a final one after the shuffle, so a hot entity or a hot
window costs one partial row per input partition, not all of its rows.  The
window operators never set a watermark; the streaming pipeline sets it once.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackstream.functions import expressions as X
from trackstream.schema import FLIGHT, FlightColumns


def _window(cols: FlightColumns, duration: str, slide: str | None) -> Column:
    t = F.col(cols.event_time)
    return F.window(t, duration, slide) if slide else F.window(t, duration)


def arrival_order(df: DataFrame, cols: FlightColumns = FLIGHT) -> Column:
    """Deterministic order key for first/last: (event_time, tiebreak)."""
    if cols.tiebreak in df.columns:
        return F.struct(F.col(cols.event_time), F.col(cols.tiebreak))
    return F.col(cols.event_time)


def _flag_count(df: DataFrame, name: str) -> Column:
    if name in df.columns:
        return F.sum(F.when(F.col(name), 1).otherwise(0))
    return F.lit(0).cast("bigint")


def _finish(g: DataFrame, window_time: bool) -> DataFrame:
    """The derived columns (A4-A6) on aggregated windows with a ``window`` column."""
    out = g.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *([F.window_time("window").alias("window_time")] if window_time else []),
        *[F.col(x) for x in g.columns if x != "window"],
    )
    return out.withColumns({
        "anomaly_rate": F.when(F.col("flight_events") > 0,
                               F.col("anomaly_count") / F.col("flight_events") * 100)
                         .otherwise(F.lit(0.0)),
        "altitude_change": F.col("max_altitude") - F.col("min_altitude"),
        "velocity_range": F.col("max_velocity") - F.col("min_velocity"),
        "flight_behavior": X.flight_behavior("start_on_ground", "end_on_ground",
                                             "altitude_variance"),
    })


def window_stats(df: DataFrame, *, duration: str = "10 minutes", slide: str | None = None,
                 window_time: bool = False, cols: FlightColumns = FLIGHT) -> DataFrame:
    """A2-A6 (and G3 with ``slide``): per (window, entity) statistics.

    Output: window_start, window_end, key, callsign, origin_country,
    flight_events, velocity/altitude avg-max-min-stddev (the stddev columns keep
    the reference's ``*_variance`` names), vertical-rate avg/max/min,
    anomaly_count (statistical flag), ml_anomaly_count (model flag, when
    present), first/last on_ground and position (by event time, then id),
    anomaly_rate, altitude_change, velocity_range, flight_behavior.

    Sliding windows are merged from panes (:func:`pane_stats`).  With
    ``window_time`` the windows keep their event time, for a stateful operator
    that follows on a stream.
    """
    if slide and pd.Timedelta(slide) != pd.Timedelta(duration):
        return merge_panes(pane_stats(df, duration=pane_length(duration, slide), cols=cols),
                           duration=duration, slide=slide, window_time=window_time, cols=cols)
    order = arrival_order(df, cols)
    v, a, vr = cols.velocity, cols.altitude, cols.vertical_rate
    aggs = [
        F.count(F.lit(1)).alias("flight_events"),
        F.avg(v).alias("avg_velocity"),
        F.max(v).alias("max_velocity"),
        F.min(v).alias("min_velocity"),
        F.stddev_samp(v).alias("velocity_variance"),
        F.avg(a).alias("avg_altitude"),
        F.max(a).alias("max_altitude"),
        F.min(a).alias("min_altitude"),
        F.stddev_samp(a).alias("altitude_variance"),
        F.avg(vr).alias("avg_vertical_rate"),
        F.max(vr).alias("max_climb_rate"),
        F.min(vr).alias("max_descent_rate"),
        _flag_count(df, cols.stat_flag).alias("anomaly_count"),
        *_endpoints(order, order, cols, {}),
    ]
    if cols.ml_flag in df.columns:
        aggs.append(_flag_count(df, cols.ml_flag).alias("ml_anomaly_count"))
    g = df.groupBy(_window(cols, duration, None).alias("window"), F.col(cols.key)).agg(*aggs)
    return _finish(g, window_time)


def _endpoints(first, last, cols: FlightColumns, named: dict) -> list[Column]:
    """A3: first and last values by arrival order; ``named`` maps an output to
    its source column where panes are merged."""
    source = {"callsign": cols.label, "origin_country": cols.category,
              "start_on_ground": cols.on_ground, "end_on_ground": cols.on_ground,
              "start_latitude": cols.lat, "start_longitude": cols.lon,
              "end_latitude": cols.lat, "end_longitude": cols.lon} | named
    return [(F.max_by(c, last) if name.startswith("end_") else F.min_by(c, first)).alias(name)
            for name, c in source.items()]


def pane_length(duration: str, slide: str) -> str:
    """The longest pane that every sliding window is made of whole."""
    return f"{math.gcd(pd.Timedelta(duration).value, pd.Timedelta(slide).value) // 1000} microseconds"


_MOMENTS = "struct<n: bigint, mean: double, m2: double>"


def _moments(c: str) -> Column:
    """Count, mean and sum of squared deviations: what merges into a wider window."""
    return F.struct(F.count(c).alias("n"), F.avg(c).alias("mean"),
                    (F.var_pop(c) * F.count(c)).alias("m2")).cast(_MOMENTS)


def _merged(parts: Column) -> Column:
    """Moments of a list of moments, each step by the deviation of its mean."""
    def add(x, y):
        n = x.n + y.n
        d = y.mean - x.mean
        return F.when(y.n == 0, x).when(x.n == 0, y).otherwise(F.struct(
            n.alias("n"), (x.mean + d * y.n / n).alias("mean"),
            (x.m2 + y.m2 + d * d * x.n * y.n / n).alias("m2"))).cast(_MOMENTS)

    start = F.struct(F.lit(0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    return F.aggregate(F.array_sort(parts), start.cast(_MOMENTS), add)


def pane_stats(df: DataFrame, *, duration: str, cols: FlightColumns = FLIGHT) -> DataFrame:
    """Mergeable per-(pane, entity) statistics: every event row is aggregated once,
    whatever the number of sliding windows that its pane belongs to."""
    order = arrival_order(df, cols)
    v, a, vr = cols.velocity, cols.altitude, cols.vertical_rate
    aggs = [
        F.count(F.lit(1)).alias("flight_events"),
        _moments(v).alias("velocity_moments"), F.max(v).alias("max_velocity"),
        F.min(v).alias("min_velocity"),
        _moments(a).alias("altitude_moments"), F.max(a).alias("max_altitude"),
        F.min(a).alias("min_altitude"),
        F.sum(vr).alias("sum_vertical_rate"), F.count(vr).alias("n_vertical_rate"),
        F.max(vr).alias("max_climb_rate"), F.min(vr).alias("max_descent_rate"),
        _flag_count(df, cols.stat_flag).alias("anomaly_count"),
        F.min(order).alias("first_at"), F.max(order).alias("last_at"),
        *_endpoints(order, order, cols, {}),
    ]
    if cols.ml_flag in df.columns:
        aggs.append(_flag_count(df, cols.ml_flag).alias("ml_anomaly_count"))
    return df.groupBy(_window(cols, duration, None).alias("pane"), F.col(cols.key)).agg(*aggs)


def merge_panes(panes: DataFrame, *, duration: str, slide: str, window_time: bool = False,
                cols: FlightColumns = FLIGHT) -> DataFrame:
    """Sliding windows from panes.  Only pane rows are copied to the
    duration / slide windows they lie in; a window merges at most
    duration / pane of them."""
    ends = ("callsign", "origin_country", "start_on_ground", "end_on_ground", "start_latitude",
            "start_longitude", "end_latitude", "end_longitude")
    g = (panes.groupBy(F.window(F.window_time("pane"), duration, slide).alias("window"),
                       F.col(cols.key))
         .agg(F.sum("flight_events").alias("flight_events"),
              _merged(F.collect_list("velocity_moments")).alias("_v"),
              F.max("max_velocity").alias("max_velocity"), F.min("min_velocity").alias("min_velocity"),
              _merged(F.collect_list("altitude_moments")).alias("_a"),
              F.max("max_altitude").alias("max_altitude"), F.min("min_altitude").alias("min_altitude"),
              (F.sum("sum_vertical_rate") / F.nullif(F.sum("n_vertical_rate"), F.lit(0)))
              .alias("avg_vertical_rate"),
              F.max("max_climb_rate").alias("max_climb_rate"),
              F.min("max_descent_rate").alias("max_descent_rate"),
              F.sum("anomaly_count").alias("anomaly_count"),
              *_endpoints("first_at", "last_at", cols, {e: e for e in ends}),
              *([F.sum("ml_anomaly_count").alias("ml_anomaly_count")]
                if "ml_anomaly_count" in panes.columns else [])))

    def mean(m):
        return F.when(F.col(f"{m}.n") > 0, F.col(f"{m}.mean"))

    def stddev(m):
        return F.when(F.col(f"{m}.n") > 1, F.sqrt(F.col(f"{m}.m2") / (F.col(f"{m}.n") - 1)))

    out = []
    for c in g.columns:
        if c in ("_v", "_a"):
            continue
        out.append(F.col(c))
        if c in ("min_velocity", "min_altitude"):
            m = "_v" if c == "min_velocity" else "_a"
            what = c.removeprefix("min_")
            out += [mean(m).alias(f"avg_{what}"), stddev(m).alias(f"{what}_variance")]
    return _finish(g.select(*out), window_time)


def tumbling_stats(df: DataFrame, *, duration: str = "10 minutes",
                   cols: FlightColumns = FLIGHT) -> DataFrame:
    """A2: tumbling windows per entity."""
    return window_stats(df, duration=duration, cols=cols)


def sliding_stats(df: DataFrame, *, duration: str = "10 minutes", slide: str = "5 minutes",
                  cols: FlightColumns = FLIGHT) -> DataFrame:
    """Sliding windows per entity, merged from panes of rows aggregated once."""
    return window_stats(df, duration=duration, slide=slide, cols=cols)


def _distinct(col_name: str, streaming: bool) -> Column:
    # Exact distinct counts are not supported on streams; use HLL++ there.
    return F.approx_count_distinct(col_name) if streaming else F.countDistinct(col_name)


def fleet_window(df: DataFrame, *, duration: str = "10 minutes", slide: str | None = None,
                 score_col: str | None = None, cols: FlightColumns = FLIGHT) -> DataFrame:
    """Fleet-wide metrics per window: event_count, unique_aircraft,
    anomaly_count/percentage, velocity stddev, optional score avg/max and the
    per-phase counts (climbing / descending / cruising / ground)."""
    flag = F.col(cols.stat_flag) if cols.stat_flag in df.columns else F.lit(False)
    phase = F.col(cols.phase)
    aggs = [
        F.count(F.lit(1)).alias("event_count"),
        _distinct(cols.key, df.isStreaming).alias("unique_aircraft"),
        F.count_if(flag).alias("anomaly_count"),
        (F.avg(flag.cast("double")) * 100).alias("anomaly_percentage"),
        F.avg(cols.velocity).alias("avg_velocity"),
        F.stddev_samp(cols.velocity).alias("velocity_std"),
        F.avg(cols.altitude).alias("avg_altitude"),
        F.count_if(phase == "climbing").alias("climbing_count"),
        F.count_if(phase == "descending").alias("descending_count"),
        F.count_if(phase == "cruise").alias("cruising_count"),
        F.count_if(phase == "ground").alias("ground_count"),
    ]
    if score_col:
        aggs += [F.avg(score_col).alias("avg_anomaly_score"),
                 F.max(score_col).alias("max_anomaly_score")]
    g = df.groupBy(_window(cols, duration, slide).alias("window")).agg(*aggs)
    return g.select(F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"),
                    *[c for c in g.columns if c != "window"])


def _group_window(df: DataFrame, group: Column, group_name: str, duration: str,
                  cols: FlightColumns) -> DataFrame:
    flag = F.col(cols.stat_flag) if cols.stat_flag in df.columns else F.lit(False)
    g = (df.groupBy(_window(cols, duration, None).alias("window"), group.alias(group_name))
           .agg(F.count(F.lit(1)).alias("event_count"),
                _distinct(cols.key, df.isStreaming).alias("unique_aircraft"),
                F.avg(cols.velocity).alias("avg_velocity"),
                F.avg(cols.altitude).alias("avg_altitude"),
                F.count_if(flag).alias("anomaly_count")))
    return g.select(F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"),
                    *[c for c in g.columns if c != "window"])


def country_window(df: DataFrame, *, duration: str = "10 minutes",
                   cols: FlightColumns = FLIGHT) -> DataFrame:
    """Per (window, origin country)."""
    return _group_window(df, F.col(cols.category), "origin_country", duration, cols)


def airline_code(label_col: str) -> Column:
    """First three characters of the stripped, upper-cased callsign (NULL when
    the callsign is missing or blank)."""
    code = F.upper(F.substring(X.strip_text(label_col), 1, 3))
    return F.nullif(code, F.lit(""))


def airline_window(df: DataFrame, *, duration: str = "10 minutes",
                   cols: FlightColumns = FLIGHT) -> DataFrame:
    """Per (window, airline code); rows without a callsign are skipped."""
    base = df.filter(airline_code(cols.label).isNotNull())
    return _group_window(base, airline_code(cols.label), "airline", duration, cols)


def grid_density(df: DataFrame, *, duration: str = "1 day", size_deg: float = 1.0,
                 cols: FlightColumns = FLIGHT) -> DataFrame:
    """Events and distinct entities per (window, grid cell)."""
    gx = F.floor(F.col(cols.lon) / F.lit(size_deg)).alias("grid_x")
    gy = F.floor(F.col(cols.lat) / F.lit(size_deg)).alias("grid_y")
    g = (df.groupBy(_window(cols, duration, None).alias("window"), gx, gy)
           .agg(F.count(F.lit(1)).alias("event_count"),
                _distinct(cols.key, df.isStreaming).alias("unique_aircraft")))
    return g.select(F.col("window.start").alias("window_start"),
                    *[c for c in g.columns if c != "window"])
