"""Console monitor (K5) and report refresh over the landed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackstream.operators import reports, routing, summaries


def console_monitor(df: DataFrame, *, rows: int = 10, trigger: str | None = None):
    """K5: print the 8 monitor columns, untruncated, every trigger."""
    w = (routing.console_projection(df).writeStream.format("console")
         .option("truncate", "false").option("numRows", str(rows)).outputMode("append"))
    if trigger:
        w = w.trigger(processingTime=trigger)
    return w.start()


def refresh_summaries(spark: SparkSession, output_root: str) -> dict[str, DataFrame]:
    """G10, incremental: the reports from the summaries that ``start_summaries`` publishes.

    Each refresh merges the last merged state with the batches published since and
    publishes the result (tables ``merged`` and ``merged_counts``), so it reads a few
    small rows however long the feed has run.  The state names the last batch of each
    query that it holds; a refresh without new batches changes nothing."""
    from trackstream.streaming.ledger import Ledger

    ledger = Ledger(spark, output_root)
    one, counts = (spark.read.parquet(ledger.table(t)) for t in ("summaries", "summary_counts"))
    one = one.drop("query_id", "batch_id").schema
    counts = counts.drop("query_id", "batch_id").schema
    held, n = {}, -1
    for e in ledger.entries("merged").orderBy("batch_id").collect():
        n = e.batch_id
    state = T.StructType(one.fields + [T.StructField("upto", T.MapType(T.StringType(), T.LongType()))])
    if n >= 0:
        held = ledger.read_batches("merged", state, [("report", n)]).first()["upto"]
    fresh = [(e.query_id, e.batch_id) for e in ledger.entries("summary_counts").collect()
             if e.batch_id > held.get(e.query_id, -1)]
    if fresh:
        for q, b in fresh:
            held[q] = max(b, held.get(q, -1))
        upto = F.create_map(*[F.lit(x) for kv in held.items() for x in kv])
        old = [("report", n)] * (n >= 0)
        merged = summaries.merge(ledger.read_batches("summaries", one, fresh).unionByName(
            ledger.read_batches("merged", state, old).drop("upto"))).withColumn("upto", upto)
        all_counts = summaries.merge_counts(ledger.read_batches("summary_counts", counts, fresh)
                                            .unionByName(ledger.read_batches("merged_counts", counts, old)))
        n += 1
        # the counts first: the state below names the batches that both hold
        ledger.publish(all_counts, "merged_counts", "report", n)
        ledger.publish(merged, "merged", "report", n)
    merged = ledger.read_batches("merged", state, [("report", n)])
    counted = ledger.read_batches("merged_counts", counts, [("report", n)])
    return {
        "kpi_summary": summaries.kpi_summary(merged),
        "summary_stats": summaries.summary_stats(merged),
        "anomaly_stats": summaries.anomaly_stats(merged),
        "top_aircraft": summaries.top_aircraft(merged),
        "top_countries": summaries.top_countries(counted),
        "phase_distribution": summaries.by_dimension(counted, "phase", "flight_phase"),
        "ground_status": summaries.by_dimension(counted, "on_ground"),
        "heading_distribution": summaries.by_dimension(counted, "compass", "bin_no"),
    }


def refresh_reports(spark: SparkSession, processed_path: str, windows_path: str | None = None,
                    *, flag_col: str = "ml_is_anomaly", score_col: str = "ml_anomaly_score"
                    ) -> dict[str, DataFrame]:
    """Every dashboard report recomputed over the whole landed tables
    (not a 500-row buffer); call on each refresh tick."""
    p = spark.read.parquet(processed_path)
    out = {
        "kpi_summary": reports.kpi_summary(p, flag_col=flag_col),
        "summary_stats": reports.summary_stats(p),
        "anomaly_stats": reports.anomaly_stats(p, flag_col=flag_col, score_col=score_col),
        "phase_distribution": reports.phase_distribution(p),
        "ground_status": reports.ground_status(p),
        "top_countries": reports.top_countries(p),
        "top_aircraft": reports.top_aircraft(p),
        "velocity_histogram": reports.velocity_histogram(p),
        "heading_distribution": reports.heading_distribution(p),
        "data_quality_report": reports.data_quality_report(p),
        "latest_events": reports.latest(p, 50),
        "recent_anomalies": reports.recent_anomalies(p, flag_col=flag_col, score_col=score_col),
    }
    if windows_path:
        w = spark.read.parquet(windows_path)
        out["window_velocity_series"] = reports.latest(w, 20, order=["window_start", "icao24"])
        out["window_anomaly_series"] = reports.latest(w, 30, order=["window_start", "icao24"])
    return out
