"""Composed batch flows over the flight adapter: the shared stages every
registered query builds on (clean -> features -> z-score -> windows)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackstream.operators import anomaly, clean, features, windows
from trackstream.operators.routing import split_valid_invalid
from trackstream.schema import PipelineConfig
from trackstream.session import configure
from trackstream.sources.adapter import load_bursts, load_flights


def flights(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    configure(spark)
    return load_flights(spark, sf_dir, **kw)


def bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return load_bursts(spark, sf_dir)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_events(flights(spark, sf_dir))


def valid_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid cleaned rows with the feature stage (no processing timestamp, so
    the output is reproducible)."""
    valid, _ = split_valid_invalid(cleaned(spark, sf_dir))
    return features.add_derived_features(valid, processing_time=False)


def scored(spark: SparkSession, sf_dir: str, *, window: str = "1 day",
           per_key: bool = False) -> DataFrame:
    """Valid rows with features and fleet-wide (or per-entity) z-scores."""
    return anomaly.zscore_anomalies(valid_features(spark, sf_dir), window_duration=window,
                                    per_key=per_key)


def windowed(spark: SparkSession, sf_dir: str, *, window: str = "1 day") -> DataFrame:
    return windows.window_stats(scored(spark, sf_dir, window=window), duration=window)


def batch_flow(df: DataFrame, cfg: PipelineConfig = PipelineConfig(), *,
               model=None, share_clean: bool = True) -> dict[str, DataFrame]:
    """The whole reference flow on a batch of raw flight rows:
    clean -> features -> z-score -> split -> score -> windows -> trends.

    Returns the four outputs (processed, windows, trends, invalid).  Rows outside
    the physical ranges go to the invalid output with their ``reject_reason`` (NULL
    for its other rows); they take no part in the z-score, so theirs is NULL.  ``model``
    is a fitted :class:`trackstream.operators.forest.ForestModel`; without it
    the model columns take their fallback values.

    With ``share_clean`` the cleaned, featured table is written once to the
    shared checkpoint folder: the dedup shuffle then runs once for all four
    outputs and the z-score statistics, instead of once per output written.
    """
    from trackstream.operators import trends
    from trackstream.operators.forest import score_frame

    cols = cfg.cols
    c = clean.clean_with_rejects(df, cols=cols, null_keys=cfg.null_keys).transform(
        clean.flag_rejects, cols=cols)
    feat = features.add_derived_features(c, cols=cols)
    if share_clean:
        from trackstream.plans.joins import materialize
        feat = materialize(feat)
    ranged = feat.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    z = anomaly.zscore_anomalies(ranged, window_duration=cfg.zscore_window,
                                 threshold=cfg.zscore_threshold, per_key=cfg.zscore_per_key,
                                 cols=cols)
    valid, invalid = split_valid_invalid(z, cols=cols)
    ml = score_frame(valid, model, cols=cols) if model is not None \
        else anomaly.model_fallback(valid, cols=cols)
    win = windows.window_stats(ml, duration=cfg.window, slide=cfg.slide, cols=cols)
    return {
        "processed": ml,
        "windows": win.withColumn("trend_summary", F.lit("not_calculated")),
        "trends": trends.calculate_trends(win, key=cols.key),
        "invalid": invalid.unionByName(feat.filter(F.col("reject_reason").isNotNull()),
                                       allowMissingColumns=True),
    }
