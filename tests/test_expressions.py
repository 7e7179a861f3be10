"""Branch-by-branch checks of the expression builders on hand-written rows
(cases the adapter never reaches: extreme speed/altitude, NaN, heading 360)."""

import math

from pyspark.sql import functions as F

from trackstream.functions import expressions as X
from trackstream.operators import clean, reports


def _eval(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_flight_phase(spark):
    rows = [(True, 5000.0, 10.0), (False, 500.0, 10.0), (False, 5000.0, 6.0),
            (False, 5000.0, -6.0), (False, 5000.0, 0.0), (None, 500.0, 0.0),
            (None, 5000.0, 5.0)]
    got = _eval(spark, rows, "g boolean, a double, vr double", X.flight_phase("g", "a", "vr"))
    assert got == ["ground", "takeoff_landing", "climbing", "descending", "cruise",
                   "takeoff_landing", "cruise"]


def test_flight_behavior(spark):
    rows = [(True, True, 5.0), (True, False, 5.0), (False, True, 5.0), (False, False, 50.0),
            (False, False, 500.0), (False, False, None), (None, None, 50.0)]
    got = _eval(spark, rows, "s boolean, e boolean, sd double", X.flight_behavior("s", "e", "sd"))
    assert got == ["stationary", "takeoff", "landing", "stable_cruise", "maneuvering",
                   "maneuvering", "stable_cruise"]


def test_trend_labels(spark):
    rows = [(None, None, None, None), (100.0, 20.0, 1000.0, 600.0),
            (100.0, -20.0, 1000.0, -600.0), (100.0, 5.0, 1000.0, 100.0),
            (100.0, 20.0, 1000.0, 100.0), (100.0, 5.0, 1000.0, 600.0)]
    df = spark.createDataFrame(rows, "pv double, dv double, pa double, da double")
    out = df.select(X.velocity_trend("pv", "dv").alias("v"),
                    X.altitude_trend("pa", "da").alias("a"))
    out = out.select("v", "a", X.trend_summary("v", "a").alias("s")).collect()
    assert [tuple(r) for r in out] == [
        ("no_history", "no_history", "initial_observation"),
        ("accelerating", "climbing", "ascending"),
        ("decelerating", "descending", "descending"),
        ("stable_speed", "stable_altitude", "stable_flight"),
        ("accelerating", "stable_altitude", "maneuvering"),
        ("stable_speed", "climbing", "ascending")]


def test_anomaly_reason(spark):
    rows = [(900.0, 15000.0, 25.0, 0.9), (40.0, 2000.0, 0.0, 0.5), (250.0, 400.0, 0.0, 0.5),
            (250.0, 10000.0, -21.0, 0.5), (250.0, 10000.0, 0.0, 0.5), (900.0, 15000.0, 25.0, 0.1)]
    got = _eval(spark, rows, "v double, a double, vr double, s double",
                X.anomaly_reason("v", "a", "vr", "s"))
    assert got == ["extreme_speed,extreme_altitude,extreme_climb_descent", "suspiciously_slow",
                   "dangerously_low", "extreme_climb_descent", "statistical_anomaly", "normal"]


def test_compass(spark):
    rows = [(0.0,), (44.99,), (45.0,), (359.9,), (360.0,), (337.5,), (400.0,)]
    got = _eval(spark, rows, "h double", X.compass_bin("h"))
    assert got == [0, 0, 1, 7, None, 7, None]
    got_c = _eval(spark, rows, "h double", X.compass_bin("h", centered=True))
    assert got_c == [0, 1, 1, 0, 0, 0, None]


def test_nan_imputed_before_range(spark):
    rows = [(float("nan"), 10.0, 100.0, 50.0, 90.0, 1.0), (None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "latitude double, longitude double, baro_altitude double, "
                                     "velocity double, heading double, vertical_rate double")
    out = clean.range_filter(clean.impute_defaults(df)).collect()
    assert len(out) == 2 and out[0].latitude == 0.0 and out[1].velocity == 0.0


def test_strip_and_time_text(spark):
    rows = [("  DLH123 \t",), (None,)]
    assert _eval(spark, rows, "s string", X.strip_text("s")) == ["DLH123", None]
    got = _eval(spark, [("2025-02-16T10:00:00Z",), ("not-a-time",)], "s string",
                X.parse_iso_time("s"))
    assert got[1] is None and got[0].hour == 10


def test_cyclic_and_units(spark):
    df = spark.createDataFrame([(6, 90.0, 100.0, 3047.0)], "h int, hd double, v double, a double")
    r = df.select(*X.cyclic("h", 24.0), *X.cyclic("hd", 360.0)).first()
    assert math.isclose(r[0], 1.0) and abs(r[1]) < 1e-12 and math.isclose(r[2], 1.0)
    from trackstream.operators.features import add_unit_conversions
    u = add_unit_conversions(df.withColumnRenamed("v", "velocity")
                               .withColumnRenamed("a", "baro_altitude")
                               .withColumn("vertical_rate", F.lit(-2.0)), extended=True).first()
    assert math.isclose(u.velocity_kmh, 360.0) and u.flight_level == 99
    assert math.isclose(u.vertical_rate_mpm, -120.0)


def test_histogram_top_edge(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (5.0,)], "velocity double")
    h = {r.bin_no: r.events for r in reports.histogram(df, "velocity", bins=4).collect()}
    assert h == {0: 1, 2: 1, 3: 1}


def test_classification_report(spark):
    rows = [(True, True)] * 3 + [(True, False)] + [(False, False)] * 5 + [(False, True)]
    df = spark.createDataFrame(rows, "l boolean, p boolean")
    r = {x["class"]: x for x in reports.classification_report(df, label_col="l",
                                                               pred_col="p").collect()}
    assert math.isclose(r["true"].precision, 0.75) and math.isclose(r["true"].recall, 0.75)
    assert r["true"].support == 4 and r["false"].support == 6
    only = spark.createDataFrame([(False, False)], "l boolean, p boolean")
    r = {x["class"]: x for x in reports.classification_report(only, label_col="l",
                                                               pred_col="p").collect()}
    assert r["false"].f1 == 1.0


def test_dedup_survivor_and_null_keys(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    rows = [(2, "a", 10, t0 + dt.timedelta(seconds=5)), (1, "a", 10, t0 + dt.timedelta(seconds=5)),
            (3, "a", None, t0), (4, "a", None, t0 + dt.timedelta(days=3))]
    df = spark.createDataFrame(rows, "event_id long, icao24 string, time_position long, "
                                     "event_time timestamp")
    assert sorted(r.event_id for r in clean.dedup_events(df).collect()) == [1, 3]
    assert sorted(r.event_id for r in clean.dedup_events(df, null_keys="distinct").collect()) \
        == [1, 3, 4]


def test_require_data_valid(spark):
    from trackstream.plans import compose as P
    from conftest import SF_SMALL
    f = P.flights(spark, SF_SMALL).withColumn(
        "data_valid", F.col("event_id") % 2 == 0)
    kept = clean.clean_events(f, require_data_valid=True)
    assert kept.filter("event_id % 2 = 1").count() == 0
    assert kept.count() > 0
    assert clean.clean_events(f).filter("event_id % 2 = 1").count() > 0
