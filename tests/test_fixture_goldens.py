"""Stage counts of the flight adapter recorded in FIXTURES.md (sf0.001)."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from trackstream.operators import anomaly, clean, reports, trends, windows
from trackstream.plans import compose as P


def _counts(df, col):
    return {r[0]: r[1] for r in df.groupBy(col).count().collect()}


def test_day_windows_behaviour_trends(spark):
    w = P.windowed(spark, SF_SMALL, window="1 day").cache()
    assert w.count() == 393
    assert w.filter("flight_events = 1").count() == 110
    assert _counts(w, "flight_behavior") == {
        "landing": 43, "maneuvering": 288, "stable_cruise": 24, "stationary": 10, "takeoff": 28}
    t = trends.calculate_trends(w)
    assert _counts(t, "trend_summary") == {
        "ascending": 293, "descending": 75, "initial_observation": 15, "maneuvering": 8,
        "stable_flight": 2}


def test_compass_and_zscore(spark):
    v = P.valid_features(spark, SF_SMALL)
    h = {r.bin_no: r.events for r in reports.heading_distribution(v).collect()}
    assert [h[i] for i in range(8)] == [127, 129, 124, 129, 121, 93, 96, 94]
    z = anomaly.zscore_anomalies(v, window_duration="1 day")
    assert z.filter(F.abs("velocity_zscore") > 3).count() == 14


def test_validator_counts(spark):
    v = clean.validate_records(P.flights(spark, SF_SMALL))
    got = _counts(v.withColumn("rule", F.coalesce(
        F.regexp_extract("validation_error", r"^(?:Missing |Invalid )(\w+)", 1), F.lit("ok"))),
        "rule")
    assert got == {"ok": 1031, "icao24": 6, "longitude": 6, "baro_altitude": 3,
                   "velocity": 2, "heading": 2}


def test_sf001_stage_counts(spark):
    from conftest import SF_MID
    f = P.flights(spark, SF_MID)
    assert f.count() == 10500
    present = clean.drop_missing_critical(clean.parse_event_time(f))
    assert present.count() == 10428
    d = clean.dedup_events(present)
    assert d.count() == 9904
    c = clean.clean_events(f)
    assert _counts(c, "data_quality") == {"valid": 9091, "invalid": 667}
    win10 = windows.window_stats(P.valid_features(spark, SF_MID), duration="10 minutes")
    assert win10.count() == 9027
