"""Exact cases of the producer-side validator, decoder and router."""

import pytest
from pyspark.sql import functions as F

from trackstream.operators import clean, routing
from trackstream.schema import FLIGHT_SCHEMA
from trackstream.sources import snapshots as SN

COMPLETE = dict(icao24="3c675a", callsign="DLH123", origin_country="Germany",
                time_position=1739700000, longitude=13.405, latitude=52.52,
                baro_altitude=11200.0, on_ground=False, velocity=245.3, heading=270.0,
                vertical_rate=-2.5, geo_altitude=11100.0, position_source=0,
                ingestion_timestamp="2025-02-16T10:00:00Z", data_valid=True)


def _row(**kw):
    base = {f.name: None for f in FLIGHT_SCHEMA.fields}
    base.update(ingestion_timestamp="2025-02-16T10:00:00Z", data_valid=True)
    base.update(kw)
    return base


def _validate(spark, rows):
    schema = FLIGHT_SCHEMA
    nullable = type(schema)([type(f)(f.name, f.dataType, True) for f in schema.fields])
    df = spark.createDataFrame([tuple(r[f.name] for f in schema.fields) for r in rows], nullable)
    return clean.validate_records(df).select("data_valid", "validation_error").collect()


CASES = [
    (COMPLETE, True, None),
    (dict(COMPLETE, icao24=None), False, "icao24"),
    (dict(COMPLETE, icao24=""), False, "icao24"),
    (dict(COMPLETE, latitude=95.0), False, "latitude"),
    (dict(COMPLETE, latitude=-100.0), False, "latitude"),
    (dict(COMPLETE, longitude=200.0), False, "longitude"),
    (dict(COMPLETE, longitude=-200.0), False, "longitude"),
    (dict(COMPLETE, baro_altitude=100000.0), False, "altitude"),
    (dict(COMPLETE, velocity=-10.0), False, "velocity"),
    (dict(COMPLETE, heading=400.0), False, "heading"),
    (_row(icao24="abc123"), True, None),
    (_row(icao24="abc123", on_ground=True, baro_altitude=0.0), True, None),
    (_row(icao24="a", latitude=90.0), True, None),
    (_row(icao24="a", latitude=-90.0), True, None),
    (_row(icao24="a", longitude=180.0), True, None),
    (_row(icao24="a", longitude=-180.0), True, None),
    (_row(icao24="a", heading=0.0), True, None),
    (_row(icao24="a", heading=360.0), True, None),
    (_row(icao24="a", velocity=0.0), True, None),
]


@pytest.mark.parametrize("row,valid,mentions", CASES)
def test_validator_cases(spark, row, valid, mentions):
    (r,) = _validate(spark, [dict(_row(), **row)])
    assert r.data_valid is valid
    if mentions:
        assert mentions in r.validation_error
    else:
        assert r.validation_error is None


def test_error_message_text(spark):
    (r,) = _validate(spark, [dict(COMPLETE, latitude=95.0)])
    assert r.validation_error == "Invalid latitude: 95.0"
    (r,) = _validate(spark, [dict(COMPLETE, icao24=None)])
    assert r.validation_error == "Missing icao24"


def test_first_failing_rule_wins(spark):
    (r,) = _validate(spark, [dict(COMPLETE, latitude=95.0, heading=400.0)])
    assert r.validation_error.startswith("Invalid latitude")


SAMPLE_DOC = ('{"time": 1739700000, "states": ['
              '["3c675a", "DLH123 ", "Germany", 1739700000, 1739700000, 13.405, 52.52, 11200.0, '
              'false, 245.3, 270.0, -2.5, null, 11100.0, "1000", false, 0],'
              '["406287", "BAW456 ", "United Kingdom", 1739700000, 1739700000, -0.461, 51.477, '
              '9800.0, false, 210.5, 90.0, 0.0, null, 9700.0, "2000", false, 0],'
              '["4ca87d", null, "Ireland", 1739700000, 1739700000, 2.349, 48.864, 10500.0, '
              'false, 230.0, 180.0, 1.5, null, 10400.0, "3000", false, 0]]}')


def test_decode_sample_snapshot(spark):
    docs = spark.createDataFrame([(SAMPLE_DOC,), ('{"time": 5}',)], "doc string")
    st = SN.explode_states(docs)
    dec = SN.decode_states(st, ingest_time=F.timestamp_seconds("snapshot_time"))
    rows = {r.icao24: r for r in dec.collect()}
    assert set(rows) == {"3c675a", "406287", "4ca87d"}
    r = rows["3c675a"]
    assert r.callsign == "DLH123" and r.origin_country == "Germany"
    assert r.longitude == 13.405 and r.latitude == 52.52 and r.baro_altitude == 11200.0
    assert r.on_ground is False and r.velocity == 245.3 and r.heading == 270.0
    assert r.vertical_rate == -2.5 and r.geo_altitude == 11100.0 and r.position_source == 0
    assert r.time_position == 1739700000 and r.data_valid is True
    assert r.ingestion_timestamp == "2025-02-16T10:00:00Z"
    assert rows["4ca87d"].callsign is None


def test_bbox(spark):
    docs = spark.createDataFrame([(SAMPLE_DOC,)], "doc string")
    dec = SN.decode_states(SN.explode_states(docs))
    assert SN.bbox_filter(dec).count() == 3
    assert SN.bbox_filter(dec, lat_min=50.0).count() == 2


def test_routing(spark):
    schema = FLIGHT_SCHEMA
    nullable = type(schema)([type(f)(f.name, f.dataType, True) for f in schema.fields])
    good = tuple(COMPLETE[f.name] for f in schema.fields)
    bad = tuple(dict(COMPLETE, icao24=None, latitude=95.0)[f.name] for f in schema.fields)
    df = spark.createDataFrame([good, bad], nullable)
    r = {x.message_key: x for x in routing.route_records(df).collect()}
    assert r["3c675a"].topic == "flight-raw-data" and r["3c675a"].data_valid
    assert r["unknown"].topic == "flight-invalid-data"
    assert r["unknown"].validation_error == "Missing icao24"
    s = routing.route_stats(routing.route_records(df)).first()
    assert (s.total_fetched, s.valid_sent, s.invalid_sent, s.errors) == (2, 1, 1, 0)
