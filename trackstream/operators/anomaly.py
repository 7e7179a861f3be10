"""Statistical anomaly detection (windowed z-score), rule-based reasons and
the no-model fallback."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackstream.functions import expressions as X
from trackstream.schema import FLIGHT, FlightColumns


def _z(x, mean, std):
    """(x - mean) / std; 0.0 when std is NULL (single row) or 0."""
    return F.coalesce((F.col(x) - mean) / F.nullif(std, F.lit(0.0)), F.lit(0.0))


def zscore_anomalies(df: DataFrame, *, window_duration: str = "10 minutes",
                     threshold: float = 3.0, per_key: bool = False,
                     columns: tuple[str, str] | None = None,
                     cols: FlightColumns = FLIGHT) -> DataFrame:
    """Z-scores of velocity and altitude against their event-time window
    (fleet-wide by default, or per entity with ``per_key``), plus
    ``is_stat_anomaly = |z_v| > t OR |z_a| > t``.

    Plans (batch):

    * fleet-wide: one partially-aggregated ``groupBy(window)`` gives one stats
      row per window, joined back by window.  Nothing runs while the plan is
      built; where ``df`` holds a shuffle (the dedup does) both sides read it, so
      its source is scanned once.  Spark broadcasts the statistics if their
      measured size allows it; beyond that the join splits a hot window.
    * per entity: a window function over (window, entity); every group is one
      entity's events in one window, bounded by its report rate.
    """
    vcol, acol = columns or (cols.velocity, cols.altitude)
    bucket = F.window(F.col(cols.event_time), window_duration).start
    if per_key:
        w = Window.partitionBy(bucket, F.col(cols.key))
        mv, sv = F.avg(vcol).over(w), F.stddev_samp(vcol).over(w)
        ma, sa = F.avg(acol).over(w), F.stddev_samp(acol).over(w)
        out = df.withColumns({"velocity_zscore": _z(vcol, mv, sv),
                              "altitude_zscore": _z(acol, ma, sa)})
    else:
        keyed = df.withColumn("_zbucket", bucket)
        stats = (keyed.groupBy("_zbucket")
                      .agg(F.avg(vcol).alias("_mv"), F.stddev_samp(vcol).alias("_sv"),
                           F.avg(acol).alias("_ma"), F.stddev_samp(acol).alias("_sa")))
        joined = keyed.join(stats, "_zbucket", "left")
        out = (joined.withColumns({
                    "velocity_zscore": _z(vcol, F.col("_mv"), F.col("_sv")),
                    "altitude_zscore": _z(acol, F.col("_ma"), F.col("_sa"))})
                     .drop("_zbucket", "_mv", "_sv", "_ma", "_sa"))
    return out.withColumn(
        cols.stat_flag,
        (F.abs(F.col("velocity_zscore")) > threshold)
        | (F.abs(F.col("altitude_zscore")) > threshold))


def window_moments(df: DataFrame, *, window_duration: str = "10 minutes", per_key: bool = False,
                   cols: FlightColumns = FLIGHT) -> DataFrame:
    """W6 in two steps, first: mean and deviation of velocity and altitude per event-time
    window (fleet-wide, or per entity).

    The aggregate's state is count, mean and squared deviations, which merge: partial
    sums run before the shuffle, and on a stream a window's state is six numbers however
    many rows it takes.  Rows with a ``reject_reason`` count for nothing, but their
    window is there.  Output: window_start, window_end[, key], _mv, _sv, _ma, _sa."""
    ranged = F.col("reject_reason").isNull() if "reject_reason" in df.columns else F.lit(True)
    v, a = F.when(ranged, F.col(cols.velocity)), F.when(ranged, F.col(cols.altitude))
    keys = [F.window(F.col(cols.event_time), window_duration).alias("_w")]
    keys += [F.col(cols.key)] if per_key else []
    g = df.groupBy(*keys).agg(F.avg(v).alias("_mv"), F.stddev_samp(v).alias("_sv"),
                              F.avg(a).alias("_ma"), F.stddev_samp(a).alias("_sa"))
    return g.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                    *[F.col(c) for c in g.columns if c != "_w"])


def apply_moments(df: DataFrame, moments: DataFrame, *, window_duration: str = "10 minutes",
                  per_key: bool = False, threshold: float = 3.0,
                  cols: FlightColumns = FLIGHT) -> DataFrame:
    """W6, second step: rows of the windows in ``moments`` with their z-scores and flag.
    A row with a ``reject_reason`` scores 0.0."""
    on = ["_start"] + [cols.key] * per_key
    stats = moments.withColumnRenamed("window_start", "_start").drop("window_end")
    keyed = df.withColumn("_start", F.window(F.col(cols.event_time), window_duration).start)
    out = keyed.join(stats, on).drop("_start")
    ranged = F.col("reject_reason").isNull() if "reject_reason" in df.columns else F.lit(True)
    out = out.withColumns({
        "velocity_zscore": F.when(ranged, _z(cols.velocity, F.col("_mv"), F.col("_sv"))).otherwise(0.0),
        "altitude_zscore": F.when(ranged, _z(cols.altitude, F.col("_ma"), F.col("_sa"))).otherwise(0.0)})
    return out.drop("_mv", "_sv", "_ma", "_sa").withColumn(
        cols.stat_flag, (F.abs(F.col("velocity_zscore")) > threshold)
        | (F.abs(F.col("altitude_zscore")) > threshold))


def add_anomaly_reason(df: DataFrame, *, score_col: str = "ml_anomaly_score",
                       out_col: str = "ml_anomaly_reason",
                       cols: FlightColumns = FLIGHT) -> DataFrame:
    """Rule-based reason for a score, as one native expression."""
    return df.withColumn(out_col, X.anomaly_reason(cols.velocity, cols.altitude,
                                                   cols.vertical_rate, score_col))


def model_fallback(df: DataFrame, *, cols: FlightColumns = FLIGHT) -> DataFrame:
    """Constant model columns when no model is available."""
    return df.withColumns({
        cols.ml_score: F.lit(0.0),
        cols.ml_flag: F.lit(False),
        cols.ml_reason: F.lit("model_unavailable"),
    })
