"""Merged summaries equal a recompute over the whole table, within the stated errors."""

import math
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from trackstream.operators import forest, reports, summaries
from trackstream.plans import compose as P
from trackstream.schema import PipelineConfig
from trackstream.sources import messages as M
from trackstream.sources.streams import MESSAGE_SCHEMA, read_stream
from trackstream.streaming import runner as R
from trackstream.streaming.sinks import refresh_summaries


def rows(df, *cols):
    return sorted(str([round(x, 6) if isinstance(x, float) else x for x in r])
                  for r in df.select(*cols).collect())


def test_refresh_equals_recompute_after_each_slice(spark):
    """The merged state after each slice gives the reports of the whole table."""
    work = tempfile.mkdtemp(prefix="ts-sum-")
    msgs = M.messages_from_flights(P.flights(spark, SF_SMALL)).withColumn(
        "s", F.coalesce(F.floor(F.dayofmonth("timestamp") / 8), F.lit(0))).cache()
    layout = R.StreamLayout(work + "/out", work + "/ckpt")
    cfg = PipelineConfig(null_keys="distinct")
    for k in range(4):
        msgs.filter(F.col("s") == k).drop("s").coalesce(1).write.mode("append").parquet(work + "/in")
        raw = read_stream(spark, "files", path=work + "/in", schema=MESSAGE_SCHEMA)
        R.start_processed(raw, layout, cfg, trigger="availableNow").awaitTermination()
        R.start_summaries(spark, layout, R.processed_schema(raw, cfg), cfg,
                          trigger="availableNow").awaitTermination()
        got = refresh_summaries(spark, layout.output_root)
        p = spark.read.parquet(layout.table("processed"))
        exact = ["total_events", "anomalies", "avg_velocity", "avg_altitude", "anomaly_rate"]
        assert rows(got["kpi_summary"], *exact) == rows(reports.kpi_summary(p), *exact)
        assert rows(got["summary_stats"], "*") == rows(reports.summary_stats(p), "*")
        assert rows(got["top_countries"], "origin_country", "events") == \
            rows(reports.top_countries(p), "origin_country", "events")
        assert rows(got["phase_distribution"], "flight_phase", "events") == \
            rows(reports.phase_distribution(p), "flight_phase", "events")
        assert rows(got["heading_distribution"], "bin_no", "events") == \
            rows(reports.heading_distribution(p), "bin_no", "events")
        n = p.select("icao24").distinct().count()
        assert abs(got["kpi_summary"].first().approx_unique_aircraft - n) <= max(1, 0.1 * n)
        true = {r[0]: r[1] for r in p.groupBy("icao24").count().collect()}
        assert all(r.least_events <= true[r.icao24] <= r.most_events
                   for r in got["top_aircraft"].collect())
    msgs.unpersist()
    # without new batches nothing is read or published again
    before = spark.read.parquet(layout.table("merged")).count()
    refresh_summaries(spark, layout.output_root)
    assert spark.read.parquet(layout.table("merged")).count() == before == 4


def test_top_bounds_on_many_entities(spark):
    """With far more entities than slots the bounds hold and no frequent entity
    is left out, however the slices are cut."""
    n = 60_000
    df = spark.range(n).select(
        F.when(F.col("id") % 5 == 0, F.concat(F.lit("hot"), F.col("id") % 35))
         .otherwise(F.concat(F.lit("k"), F.col("id") % 20_011)).alias("icao24"),
        F.lit(1.0).alias("latitude"), F.lit(1.0).alias("baro_altitude"), F.lit(2.0).alias("velocity"),
        F.lit(0.0).alias("vertical_rate"), (F.col("id") % 7).alias("part"))
    merged = summaries.merge(summaries.summarize(df, by=["part"]))
    true = {r[0]: r[1] for r in df.groupBy("icao24").count().collect()}
    got = {r.icao24: r for r in summaries.top_aircraft(merged, k=summaries.TOP_ITEMS).collect()}
    error = math.ceil(summaries.top_error(n))
    assert all(r.least_events <= true[k] <= r.most_events for k, r in got.items())
    must = {k for k, c in true.items() if c > error}
    assert len(must) >= 5 and must <= set(got)
    assert len(true) > 10_000


def test_quantiles_merge(spark):
    df = spark.range(50_000).select(((F.col("id") * 7919) % 50_000).cast("double").alias("velocity"),
                                    (F.col("id") % 9).alias("part"), F.lit("a").alias("icao24"),
                                    F.lit(1.0).alias("latitude"), F.lit(1.0).alias("baro_altitude"),
                                    F.lit(0.0).alias("vertical_rate"))
    merged = summaries.merge(summaries.summarize(df, by=["part"]))
    for q in (0.01, 0.5, 0.99):
        x = merged.select(summaries.score_quantile(q, "velocity_ranks")).first()[0]
        assert abs(x / 50_000 - q) <= summaries.RANK_ERROR
    assert merged.select(summaries.score_quantile(0.5)).first()[0] is None     # no scores


def test_model_calibrates_from_merged_ranks(spark):
    """The threshold from sketches of slices is within the rank error of the exact one."""
    v = P.valid_features(spark, "/root/testdata/sf0.01").cache()
    model = forest.fit_isolation_forest(v, n_trees=20)
    exact = (model.raw_min, model.raw_max)
    ranks = forest.raw_ranks(v, model, by=[F.to_date("event_time").alias("day")])
    assert ranks.count() > 10
    forest.calibrate_from_ranks(model, forest.merge_ranks(ranks))
    assert (model.raw_min, model.raw_max) == pytest.approx(exact)
    share = forest.score_frame(v, model).agg(F.avg(F.col("ml_is_anomaly").cast("double"))).first()[0]
    assert abs(share - model.contamination) <= summaries.RANK_ERROR + 1 / v.count()
    drift = summaries.flag_drift(summaries.summarize(
        forest.score_frame(v, model), by=[F.to_date("event_time").alias("day")]), ["day"]).collect()
    total = sum(r.rows * r.share for r in drift) / sum(r.rows for r in drift)
    assert total == pytest.approx(share) and all(0 <= r.approx_score_99 <= 1 for r in drift)
    v.unpersist()


def test_summaries_of_nothing(spark):
    empty = P.valid_features(spark, SF_SMALL).filter("1 = 0")
    merged = summaries.merge(summaries.summarize(empty))
    k = summaries.kpi_summary(merged).first()
    assert (k.total_events, k.avg_velocity, k.approx_unique_aircraft) == (0, None, 0)
    assert summaries.top_aircraft(merged).count() == 0
    assert summaries.merge_counts(summaries.dimension_counts(empty)).count() == 0
