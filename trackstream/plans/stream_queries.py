"""Streaming queries: the job over a landed, time-ordered message feed.

Each query lands the whole feed as files in time order, runs the part of the
streaming job it is about with ``availableNow``, and returns what the job
published.  The batch SQL in :mod:`trackstream.plans.oracle` states the same
rows from the ``events`` table: a window is there if it ends by the last
watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackstream.plans import compose as P
from trackstream.plans.catalog import round_doubles
from trackstream.schema import PipelineConfig
from trackstream.session import scratch_path
from trackstream.sources import messages as M
from trackstream.sources.streams import MESSAGE_SCHEMA, read_stream
from trackstream.streaming import runner as R
from trackstream.streaming.ledger import Ledger

#: Micro-batches of the feed.
SLICES = 4
#: Days as windows; a silent entity's trend state expires after three of them.
CONFIG = PipelineConfig(window="1 day", zscore_window="1 day", watermark="10 minutes",
                        null_keys="distinct", trend_expiry=3)


def _written(df: DataFrame) -> DataFrame:
    """``df`` as a table of the checkpoint folder: its extremes are read from one column, and
    each step from columns, not from rows that are taken apart again."""
    path = scratch_path(df.sparkSession, "messages")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def land_feed(spark: SparkSession, sf_dir: str, path: str, slices: int = SLICES) -> None:
    """Write the message feed in ``slices`` steps of equal time, one after another: a
    file stream takes files by their age, and older rows would come late."""
    msgs = _written(M.messages_from_flights(P.flights(spark, sf_dir)))
    lo, hi = msgs.agg(F.min(F.unix_micros("timestamp")), F.max(F.unix_micros("timestamp"))).first()
    step = ((hi or 0) - (lo or 0)) // slices + 1
    nth = F.coalesce(F.floor((F.unix_micros("timestamp") - F.lit(lo or 0)) / step), F.lit(0))
    for k in range(slices):
        msgs.filter(nth == k).write.mode("append").parquet(path)


def run_job(spark: SparkSession, sf_dir: str, last: str, cfg: PipelineConfig = CONFIG
            ) -> R.StreamLayout:
    """Land the feed and run the job's queries up to ``last``."""
    root = scratch_path(spark, "stream")
    land_feed(spark, sf_dir, f"{root}/feed")
    # a slice has one file a core at most, so as many files are about a slice
    per_trigger = max(1, len(spark.read.parquet(f"{root}/feed").inputFiles()) // SLICES)
    raw = read_stream(spark, "files", path=f"{root}/feed", schema=MESSAGE_SCHEMA,
                      max_per_trigger=per_trigger)
    layout = R.StreamLayout(f"{root}/out", f"{root}/checkpoints")
    R.start_landed(raw, layout, cfg, trigger="availableNow").awaitTermination()
    if last == "landed":
        return layout
    R.start_scored(spark, layout, R.landed_schema(raw, cfg), cfg,
                   trigger="availableNow").awaitTermination()
    if last == "windows":
        R.start_windows(spark, layout, R.processed_schema(raw, cfg), cfg,
                        trigger="availableNow").awaitTermination()
    if last == "accounting":
        R.start_dead_letters(raw, layout, cfg, trigger="availableNow").awaitTermination()
    return layout


def stream_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed rows with the z-scores of their closed window."""
    layout = run_job(spark, sf_dir, "processed")
    return spark.read.parquet(layout.table("processed")).select(
        "event_id", "icao24", "event_time", "velocity", "baro_altitude", "flight_phase",
        "velocity_zscore", "altitude_zscore", "is_stat_anomaly", "ml_anomaly_reason")


def stream_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: invalid rows and rows out of range, with their reason."""
    layout = run_job(spark, sf_dir, "processed")
    return (spark.read.parquet(layout.table("invalid"))
            .groupBy("icao24", "data_quality", "reject_reason").agg(F.count(F.lit(1)).alias("rows")))


def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed windows with a live anomaly count."""
    layout = run_job(spark, sf_dir, "windows")
    return R.latest_windows(spark, layout.table("windows")).select(
        "window_start", "window_end", "icao24", "callsign", "origin_country", "flight_events",
        "avg_velocity", "velocity_variance", "avg_altitude", "altitude_variance",
        "avg_vertical_rate", "anomaly_count", "anomaly_rate", "start_on_ground", "end_on_ground",
        "start_latitude", "end_longitude", "altitude_change", "velocity_range", "flight_behavior")


def stream_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trend labels from state that expires."""
    layout = run_job(spark, sf_dir, "windows")
    return R.latest_windows(spark, layout.table("windows")).select(
        "window_start", "icao24", "prev_avg_velocity", "prev_avg_altitude", "velocity_trend",
        "altitude_trend", "trend_summary")


def stream_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed sliding windows, merged from panes."""
    from dataclasses import replace

    layout = run_job(spark, sf_dir, "windows", replace(CONFIG, slide="12 hours"))
    return R.latest_windows(spark, layout.table("windows")).select(
        "window_start", "window_end", "icao24", "flight_events", "avg_velocity",
        "velocity_variance", "avg_altitude", "altitude_variance", "avg_vertical_rate",
        "max_climb_rate", "anomaly_count", "callsign", "end_latitude", "flight_behavior")


def stream_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each table by the ledger, dead letters by their reason."""
    layout = run_job(spark, sf_dir, "accounting")
    ledger = Ledger(spark, layout.output_root)
    tables = (ledger.entries().filter("table <> 'dead_letters'").groupBy("table")
              .agg(F.sum("rows").alias("rows")).select(F.col("table").alias("account"), "rows"))
    dead = (spark.read.parquet(layout.table("dead_letters")).groupBy("reason")
            .agg(F.count(F.lit(1)).alias("rows"))
            .select(F.concat(F.lit("dead: "), "reason").alias("account"), "rows"))
    return tables.union(dead)


def _rounded(fn):
    return lambda spark, sf_dir: round_doubles(fn(spark, sf_dir))


STREAM_QUERIES = {f.__name__: _rounded(f) for f in (
    stream_processed, stream_invalid, stream_windows, stream_trends, stream_sliding,
    stream_accounting)}
