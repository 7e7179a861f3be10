"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver's ``events`` table (through the flight adapter)
and so grows with it; no query runs on fixed input only.  Double columns are
rounded to 6 decimals for presentation, exactly as in the matching oracle SQL
(:mod:`trackstream.plans.oracle`), so engine-level last-bit differences of
sums and square roots do not show.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackstream.operators import (anomaly, clean, features, reports, routing, summaries, trends,
                                   windows)
from trackstream.plans import compose as P
from trackstream.plans.joins import materialize
from trackstream.sources import messages as M
from trackstream.sources import snapshots as SN

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir, _fn=fn: round_doubles(_fn(spark, sf_dir))
        return fn
    return deco


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            out.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


FLIGHT_OUT = ["event_id", "icao24", "callsign", "origin_country", "time_position",
              "longitude", "latitude", "baro_altitude", "on_ground", "velocity", "heading",
              "vertical_rate", "geo_altitude", "position_source", "ingestion_timestamp",
              "data_valid"]


def _present(spark, d):
    return P.flights(spark, d).transform(clean.parse_event_time) \
        .transform(clean.drop_missing_critical)


# ---------------------------------------------------------------- 2.3 clean
@register("critical_not_null")
def q_critical_not_null(spark, d):
    return _present(spark, d)


@register("dedup_events")
def q_dedup_events(spark, d):
    return _present(spark, d).transform(clean.dedup_events)


@register("impute_defaults")
def q_impute_defaults(spark, d):
    return _present(spark, d).transform(clean.dedup_events).transform(clean.impute_defaults)


@register("range_filter")
def q_range_filter(spark, d):
    return (_present(spark, d).transform(clean.dedup_events)
            .transform(clean.impute_defaults).transform(clean.range_filter))


@register("clean_events")
def q_clean_events(spark, d):
    return P.cleaned(spark, d)


@register("quality_flag")
def q_quality_flag(spark, d):
    return reports.frequency(P.cleaned(spark, d), "data_quality")


@register("reject_reason")
def q_reject_reason(spark, d):
    df = clean.clean_with_rejects(P.flights(spark, d))
    return (df.filter(F.col("reject_reason").isNotNull())
              .select("event_id", "icao24", "reject_reason"))


@register("validate_records")
def q_validate_records(spark, d):
    v = clean.validate_records(P.flights(spark, d))
    return v.select("event_id", "icao24", "data_valid", "validation_error")


def _messages(spark, d):
    # The derived feed stands in for landed broker messages: write it once
    # (reliable checkpoint) so the parse operators read stored text rather
    # than having the encoder inlined into their predicates.
    return M.envelope(materialize(M.messages_from_flights(P.flights(spark, d))))


@register("validate_types")
def q_validate_types(spark, d):
    msgs = M.unwrap_nested_json(_messages(spark, d))
    fields = [r[0] for r in clean.S.VALIDATION_RULES]
    raw = M.raw_field_text(msgs, fields)
    good = M.good_records(raw)
    v = clean.validate_records(good, raw={f: "raw_" + f for f in fields})
    return v.select("event_id", "icao24", "data_valid", "validation_error")


@register("validate_types_every_field")
def q_validate_types_every_field(spark, d):
    """V8: each validated field comes with a wrong type somewhere."""
    fields = [r[0] for r in clean.S.VALIDATION_RULES]
    feed = M.messages_from_flights(P.flights(spark, d), wrong_fields=fields)
    msgs = M.unwrap_nested_json(M.envelope(materialize(feed)))
    good = M.good_records(M.raw_field_text(msgs, fields))
    v = clean.validate_records(good, raw={f: "raw_" + f for f in fields})
    return v.select("event_id", "icao24", "data_valid", "validation_error")


# ------------------------------------------------------------- 2.1 sources
@register("parse_payload")
def q_parse_payload(spark, d):
    return M.good_records(_messages(spark, d)).select("key", *FLIGHT_OUT, "kafka_timestamp")


@register("unwrap_nested_json")
def q_unwrap_nested_json(spark, d):
    msgs = _messages(spark, d).withColumn(
        "was_nested", F.get_json_object("value", "$.value").isNotNull())
    return M.good_records(msgs).select("event_id", "icao24", "was_nested")


@register("dead_letter_json")
def q_dead_letter_json(spark, d):
    return M.dead_letters(_messages(spark, d)).select("key", "kafka_timestamp", "reason")


def _states(spark, d):
    docs = SN.snapshots_from_flights(P.flights(spark, d, keep_source_time=True))
    return SN.explode_states(docs)


@register("explode_states")
def q_explode_states(spark, d):
    st = _states(spark, d)
    return st.select("doc_no", "snapshot_time", F.col("state")[0].alias("icao24"),
                     F.size("state").alias("n_slots"))


@register("decode_states")
def q_decode_states(spark, d):
    st = _states(spark, d)
    dec = SN.decode_states(st, ingest_time=F.timestamp_seconds("snapshot_time"))
    return dec.drop("snapshot_time")


@register("bbox_filter")
def q_bbox_filter(spark, d):
    return SN.bbox_filter(P.flights(spark, d)).select("event_id", "icao24", "latitude",
                                                      "longitude")


# ------------------------------------------------------- 2.2 sinks/routing
@register("split_valid")
def q_split_valid(spark, d):
    v, _ = routing.split_valid_invalid(P.cleaned(spark, d))
    return v.select("event_id", "icao24", "latitude", "longitude", "data_quality")


@register("split_invalid")
def q_split_invalid(spark, d):
    _, inv = routing.split_valid_invalid(P.cleaned(spark, d))
    return inv.select("event_id", "icao24", "latitude", "longitude", "data_quality")


@register("route_records")
def q_route_records(spark, d):
    r = routing.route_records(P.flights(spark, d))
    return r.select("event_id", "message_key", "topic", "route", "data_valid",
                    "validation_error")


@register("route_stats")
def q_route_stats(spark, d):
    return routing.route_stats(routing.route_records(P.flights(spark, d)))


@register("encode_kv")
def q_encode_kv(spark, d):
    s = anomaly.model_fallback(P.scored(spark, d))
    return routing.encode_kv(routing.processed_projection(s, include_processing_time=False))


@register("latest_events")
def q_latest_events(spark, d):
    return reports.latest(P.scored(spark, d), 50,
                          columns=["event_id", "icao24", "event_time", "velocity",
                                   "baro_altitude", "flight_phase"])


@register("processed_projection")
def q_processed_projection(spark, d):
    s = anomaly.model_fallback(P.scored(spark, d))
    return routing.processed_projection(s, include_processing_time=False)


@register("encode_kv_parsed")
def q_encode_kv_parsed(spark, d):
    """K1: the encoded messages, parsed back with the feed's schema."""
    s = routing.processed_projection(anomaly.model_fallback(P.scored(spark, d)),
                                     include_processing_time=False)
    kv = routing.encode_kv(s)
    back = kv.select("key", F.from_json("value", s.schema).alias("r"))
    return back.select("key", "r.*")


@register("aggregate_projection")
def q_aggregate_projection(spark, d):
    return routing.aggregate_projection(P.windowed(spark, d))


@register("invalid_projection")
def q_invalid_projection(spark, d):
    _, inv = routing.split_valid_invalid(P.cleaned(spark, d))
    return routing.invalid_projection(inv.withColumn("processing_timestamp", F.col("event_time")))


@register("console_projection")
def q_console_projection(spark, d):
    return routing.console_projection(anomaly.model_fallback(P.scored(spark, d)))


@register("model_fallback")
def q_model_fallback(spark, d):
    s = anomaly.model_fallback(P.valid_features(spark, d))
    return s.select("event_id", "ml_anomaly_score", "ml_is_anomaly", "ml_anomaly_reason")


# ------------------------------------------------------------- 2.9 scalars
@register("time_features")
def q_time_features(spark, d):
    return P.valid_features(spark, d).select("event_id", "event_time", "hour", "day_of_week",
                                             "is_weekend")


@register("cyclic_features")
def q_cyclic_features(spark, d):
    return P.valid_features(spark, d).select("event_id", "hour_sin", "hour_cos", "dow_sin",
                                             "dow_cos", "heading_sin", "heading_cos")


@register("unit_conversions")
def q_unit_conversions(spark, d):
    v, _ = routing.split_valid_invalid(P.cleaned(spark, d))
    u = features.add_unit_conversions(v, extended=True)
    return u.select("event_id", "velocity_kmh", "velocity_knots", "altitude_feet",
                    "flight_level", "vertical_rate_mpm", "mach_number")


@register("flight_phase")
def q_flight_phase(spark, d):
    return reports.phase_distribution(P.valid_features(spark, d))


@register("derived_features")
def q_derived_features(spark, d):
    return P.valid_features(spark, d).drop("ingestion_timestamp", "data_valid")


def _stat_score():
    # Statistical score in [0, 1]: |velocity z| relative to the threshold.
    return F.least(F.abs(F.col("velocity_zscore")) / F.lit(3.0), F.lit(1.0))


@register("anomaly_reason")
def q_anomaly_reason(spark, d):
    s = P.scored(spark, d).withColumn("stat_score", _stat_score())
    s = anomaly.add_anomaly_reason(s, score_col="stat_score", out_col="reason")
    return s.select("event_id", "stat_score", "reason")


# -------------------------------------------------------- 2.4 joins (lookups)
@register("top_aircraft")
def q_top_aircraft(spark, d):
    return reports.top_aircraft(P.valid_features(spark, d))


@register("position_source_label")
def q_position_source_label(spark, d):
    j = reports.position_source_label(P.valid_features(spark, d))
    return (j.groupBy("position_source", "position_source_label")
             .agg(F.count(F.lit(1)).alias("events")))


@register("ground_status")
def q_ground_status(spark, d):
    return reports.ground_status(P.valid_features(spark, d))


# ------------------------------------------------------- 2.5 aggregations
@register("tumbling_stats")
def q_tumbling_stats(spark, d):
    return P.windowed(spark, d, window="1 day")


@register("tumbling_stats_10min")
def q_tumbling_stats_10min(spark, d):
    return windows.window_stats(P.scored(spark, d, window="10 minutes"),
                                duration="10 minutes")


@register("window_endpoints")
def q_window_endpoints(spark, d):
    return P.windowed(spark, d).select(
        "window_start", "icao24", "callsign", "origin_country", "start_on_ground",
        "end_on_ground", "start_latitude", "start_longitude", "end_latitude", "end_longitude")


@register("window_metrics")
def q_window_metrics(spark, d):
    return P.windowed(spark, d).select("window_start", "icao24", "flight_events",
                                       "anomaly_count", "anomaly_rate", "altitude_change",
                                       "velocity_range")


@register("flight_behavior")
def q_flight_behavior(spark, d):
    return reports.frequency(P.windowed(spark, d), "flight_behavior", out="windows")


@register("kpi_summary")
def q_kpi_summary(spark, d):
    return reports.kpi_summary(P.scored(spark, d), flag_col="is_stat_anomaly")


@register("summary_stats")
def q_summary_stats(spark, d):
    return reports.summary_stats(P.valid_features(spark, d))


@register("anomaly_stats")
def q_anomaly_stats(spark, d):
    s = P.scored(spark, d).withColumn("stat_score", _stat_score())
    return reports.anomaly_stats(s, flag_col="is_stat_anomaly", score_col="stat_score")


@register("phase_distribution")
def q_phase_distribution(spark, d):
    return reports.phase_distribution(P.valid_features(spark, d))


@register("top_countries")
def q_top_countries(spark, d):
    return reports.top_countries(P.valid_features(spark, d))


@register("velocity_histogram")
def q_velocity_histogram(spark, d):
    return reports.velocity_histogram(P.valid_features(spark, d))


@register("heading_distribution")
def q_heading_distribution(spark, d):
    return reports.heading_distribution(P.valid_features(spark, d))


@register("data_quality_report")
def q_data_quality_report(spark, d):
    return reports.data_quality_report(P.valid_features(spark, d))


@register("scaler_stats")
def q_scaler_stats(spark, d):
    return reports.scaler_stats(P.valid_features(spark, d))


@register("scaled_features")
def q_scaled_features(spark, d):
    s = reports.standardize(P.valid_features(spark, d))
    return s.select("event_id", *[f + "_scaled" for f in clean.S.MODEL_FEATURES])


@register("classification_report")
def q_classification_report(spark, d):
    s = P.scored(spark, d).withColumn(
        "rule_label", F.abs(F.col("vertical_rate")) > F.lit(20.0))
    return reports.classification_report(s, label_col="rule_label", pred_col="is_stat_anomaly")


# ------------------------------------------- reports from merged summaries
def _daily(spark, d):
    """A summary of each day of the feed, as a stream would leave them."""
    s = P.scored(spark, d).withColumn("stat_score", _stat_score())
    return s, summaries.summarize(s, by=[F.to_date("event_time").alias("day")],
                                  flag_col="is_stat_anomaly", score_col="stat_score")


@register("merged_kpi")
def q_merged_kpi(spark, d):
    s, daily = _daily(spark, d)
    kpi = summaries.kpi_summary(summaries.merge(daily)).withColumn("j", F.lit(1))
    exact = s.agg(F.countDistinct("icao24").alias("exact")).withColumn("j", F.lit(1))
    # five standard errors of the sketch
    near = F.abs(F.col("approx_unique_aircraft") - F.col("exact")) <= F.greatest(
        F.lit(1.0), F.col("exact") * 5 * 1.04 / 2 ** (summaries.LG_K / 2))
    return kpi.join(exact, "j").select(
        "total_events", "anomalies", "avg_velocity", "avg_altitude", "anomaly_rate",
        near.alias("distinct_within_bound"))


@register("merged_counts")
def q_merged_counts(spark, d):
    daily = summaries.dimension_counts(P.valid_features(spark, d),
                                       by=[F.to_date("event_time").alias("day")])
    return summaries.merge_counts(daily)


@register("merged_top_aircraft")
def q_merged_top_aircraft(spark, d):
    """Every entity that the sketch must name (more events than its error), with its exact
    count and whether the sketch's bounds hold it."""
    s, daily = _daily(spark, d)
    merged = summaries.merge(daily)
    top = summaries.top_aircraft(merged, k=summaries.TOP_ITEMS)
    exact = s.groupBy("icao24").agg(F.count(F.lit(1)).alias("events"))
    least = merged.select(F.ceil(summaries.top_error(F.col("rows"))).alias("error"),
                          F.lit(1).alias("j"))
    sure = (exact.withColumn("j", F.lit(1)).join(least, "j")
            .filter(F.col("events") > F.col("error")))
    holds = F.col("events").between(F.col("least_events"), F.col("most_events"))
    return sure.join(top, "icao24", "left").select(
        "icao24", "events", F.coalesce(holds, F.lit(False)).alias("bounds_hold"))


@register("merged_quantiles")
def q_merged_quantiles(spark, d):
    """Quantiles of the velocity from merged sketches: whether their exact rank is within
    the stated error."""
    s, daily = _daily(spark, d)
    points = [0.01, 0.25, 0.5, 0.75, 0.99]
    got = summaries.merge(daily).select(F.lit(1).alias("j"), F.array(*[
        summaries.score_quantile(q, "velocity_ranks") for q in points]).alias("x"))   # one row
    v = s.select("velocity", F.lit(1).alias("j")).join(F.broadcast(got), "j")
    counts = v.agg(F.count("velocity").alias("n"), F.array(*[F.struct(
        F.lit(q).alias("quantile"), F.count_if(F.col("velocity") < F.get("x", F.lit(k))).alias("below"),
        F.count_if(F.col("velocity") <= F.get("x", F.lit(k))).alias("upto"))
        for k, q in enumerate(points)]).alias("r"))
    each = counts.select("n", F.explode("r").alias("r")).select("n", "r.*")
    slack = F.col("n") * summaries.RANK_ERROR + 1
    return each.select("quantile", "n", (
        (F.col("below") <= F.col("quantile") * F.col("n") + slack)
        & (F.col("upto") >= F.col("quantile") * F.col("n") - slack)).alias("within_error"))


@register("unique_aircraft_exact")
def q_unique_aircraft_exact(spark, d):
    return summaries.exact_distinct(P.windowed(spark, d))


# ---------------------------------------------------------- 2.6 windows
@register("trend_lag")
def q_trend_lag(spark, d):
    t = trends.add_trend_lag(P.windowed(spark, d))
    return t.select("window_start", "icao24", "avg_velocity", "avg_altitude",
                    "prev_avg_velocity", "prev_avg_altitude", "velocity_change",
                    "altitude_change_from_prev")


@register("trend_labels")
def q_trend_labels(spark, d):
    t = trends.calculate_trends(P.windowed(spark, d))
    return t.select("window_start", "icao24", "velocity_trend", "altitude_trend",
                    "trend_summary")


@register("zscore_anomalies")
def q_zscore_anomalies(spark, d):
    return P.scored(spark, d).select("event_id", "icao24", "velocity_zscore",
                                     "altitude_zscore", "is_stat_anomaly")


@register("zscore_per_key")
def q_zscore_per_key(spark, d):
    return P.scored(spark, d, per_key=True).select("event_id", "icao24", "velocity_zscore",
                                                   "altitude_zscore", "is_stat_anomaly")


# ------------------------------------------------------------ 2.7 top-k
@register("velocity_timeline")
def q_velocity_timeline(spark, d):
    return reports.latest(P.valid_features(spark, d), 100,
                          columns=["event_id", "icao24", "event_time", "velocity"])


@register("altitude_timeline")
def q_altitude_timeline(spark, d):
    return reports.latest(P.valid_features(spark, d), 100,
                          columns=["event_id", "icao24", "event_time", "baro_altitude",
                                   "flight_phase"])


@register("anomaly_scatter")
def q_anomaly_scatter(spark, d):
    s = P.scored(spark, d).withColumn("stat_score", _stat_score())
    return reports.latest(s, 200, columns=["event_id", "icao24", "velocity", "baro_altitude",
                                           "is_stat_anomaly", "stat_score"])


@register("climb_descent_scatter")
def q_climb_descent_scatter(spark, d):
    return reports.latest(P.valid_features(spark, d), 300,
                          columns=["event_id", "icao24", "vertical_rate", "baro_altitude",
                                   "flight_phase"])


@register("window_velocity_series")
def q_window_velocity_series(spark, d):
    w = windows.window_stats(P.scored(spark, d, window="10 minutes"), duration="10 minutes")
    return reports.latest(w, 20, order=["window_start", "icao24"],
                          columns=["window_start", "icao24", "avg_velocity", "max_velocity",
                                   "min_velocity"])


@register("window_anomaly_series")
def q_window_anomaly_series(spark, d):
    w = P.windowed(spark, d)
    return reports.latest(w, 30, order=["window_start", "icao24"],
                          columns=["window_start", "icao24", "anomaly_count"])


@register("recent_anomalies")
def q_recent_anomalies(spark, d):
    s = P.scored(spark, d).withColumn("stat_score", _stat_score())
    return reports.recent_anomalies(s, n=10, flag_col="is_stat_anomaly",
                                    score_col="stat_score")


# ---------------------------------------------------- 2.10 / 2.12 windows
@register("sliding_stats")
def q_sliding_stats(spark, d):
    return windows.sliding_stats(P.scored(spark, d), duration="1 day", slide="12 hours")


@register("fleet_window")
def q_fleet_window(spark, d):
    s = P.scored(spark, d).withColumn("stat_score", _stat_score())
    return windows.fleet_window(s, duration="1 day", score_col="stat_score")


@register("country_window")
def q_country_window(spark, d):
    return windows.country_window(P.scored(spark, d), duration="1 day")


@register("airline_window")
def q_airline_window(spark, d):
    return windows.airline_window(P.scored(spark, d), duration="1 day")


@register("grid_density")
def q_grid_density(spark, d):
    return windows.grid_density(P.valid_features(spark, d), duration="1 day", size_deg=10.0)


@register("position_age")
def q_position_age(spark, d):
    return features.add_position_age(P.valid_features(spark, d)).select(
        "event_id", "icao24", "position_age")


@register("burst_position_age")
def q_burst_position_age(spark, d):
    return features.add_position_age(P.bursts(spark, d)).select("event_id", "icao24", "position_age")


@register("burst_zscore_per_key")
def q_burst_zscore_per_key(spark, d):
    z = anomaly.zscore_anomalies(P.bursts(spark, d), window_duration="10 minutes", per_key=True)
    return z.select("event_id", "velocity_zscore", "altitude_zscore", "is_stat_anomaly")


@register("burst_windows")
def q_burst_windows(spark, d):
    z = anomaly.zscore_anomalies(P.bursts(spark, d), window_duration="10 minutes", per_key=True)
    return windows.window_stats(z, duration="10 minutes").select(
        "window_start", "icao24", "flight_events", "avg_velocity", "velocity_variance",
        "altitude_variance", "anomaly_count", "start_on_ground", "end_on_ground", "end_latitude",
        "flight_behavior")


@register("burst_sliding")
def q_burst_sliding(spark, d):
    return windows.sliding_stats(P.bursts(spark, d), duration="10 minutes", slide="5 minutes").select(
        "window_start", "icao24", "flight_events", "avg_velocity", "velocity_variance",
        "avg_vertical_rate", "flight_behavior")


@register("state_transitions")
def q_state_transitions(spark, d):
    return features.state_transitions(P.valid_features(spark, d)).select(
        "event_id", "icao24", "prev_heading", "heading_change", "prev_on_ground",
        "ground_transition")


@register("compass_centered")
def q_compass_centered(spark, d):
    return reports.heading_distribution(P.valid_features(spark, d), centered=True)
