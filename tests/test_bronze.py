"""Bronze parsing: permissive JSON semantics (T1, T2) and quarantine."""

import json

from pyspark.sql import functions as F

from airlake.operators.bronze import decode_value, parse_events, parse_events_with_quarantine
from airlake.sinks.writers import to_kafka_value

GOOD = {
    "source": "openmeteo",
    "latitude": -33.25,
    "longitude": 151.5,
    "city_id": 77,
    "city": "Harbour",
    "country": "Elsewhere",
    "measurement_timestamp": "2021-02-28T17:00",
    "european_aqi": 63,
    "pm10": 8.25,
    "pm2_5": 4.5,
    "nitrogen_dioxide": 0.125,
    "ingestion_timestamp_utc": "2021-02-28T18:05:09+00:00",
}


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "json_string string")


def test_malformed_inputs_are_dropped(spark):
    df = texts(spark, json.dumps(GOOD), "not json {", json.dumps(GOOD)[:-5], "[1, 2]", "", None)
    out = parse_events(df).collect()
    assert len(out) == 1
    assert out[0].city == "Harbour" and out[0].european_aqi == 63


def test_other_source_dropped_and_source_none_keeps_all(spark):
    other = dict(GOOD, source="other")
    df = texts(spark, json.dumps(GOOD), json.dumps(other))
    assert parse_events(df).count() == 1
    assert parse_events(df, source=None).count() == 2


def test_wrong_json_type_is_null_but_row_survives(spark):
    a = dict(GOOD, european_aqi=63.5)
    b = dict(GOOD, european_aqi="63")
    out = parse_events(texts(spark, json.dumps(a), json.dumps(b))).collect()
    assert len(out) == 2
    assert [r.european_aqi for r in out] == [None, None]
    assert all(r.city == "Harbour" for r in out)


def test_decode_and_kafka_value_roundtrip(spark):
    df = spark.createDataFrame([GOOD])
    records = to_kafka_value(df)
    assert dict(records.dtypes)["value"] == "binary"
    back = parse_events(decode_value(records)).collect()
    assert back[0].asDict() == GOOD


def test_quarantine_keeps_failed_text(spark):
    a = dict(GOOD, european_aqi="63")
    df = texts(spark, json.dumps(GOOD), "not json {", json.dumps(a))
    out = parse_events_with_quarantine(df).orderBy(F.col("_corrupt_record").asc_nulls_first()).collect()
    corrupt = [r._corrupt_record for r in out]
    assert corrupt[0] is None
    assert "not json {" in corrupt
    assert sum(c is not None for c in corrupt) == 2
