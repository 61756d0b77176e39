"""Response validation and flattening, written from the rule list of the operator."""

import json

import pytest

from airlake.operators.ingest import flatten_hourly, validate_responses
from airlake.schemas import REQUIRED_HOURLY_FIELDS
from airlake.sources.tables import city_dimension

HOURS = ["2023-11-04T21:00", "2023-11-04T22:00", "2023-11-04T23:00"]
SCHEMA = "city_id int, n int, response_json string, ingestion_timestamp_utc string"
STAMP = "2023-11-05T00:10:00.000000+00:00"


def body(**changes) -> str:
    """A valid response of three evening hours; ``changes`` replace fields, a
    field changed to ``...`` is left out."""
    hourly = {"time": HOURS}
    for i, name in enumerate(REQUIRED_HOURLY_FIELDS[1:]):
        hourly[name] = [5 * i + h for h in range(3)]
    hourly |= changes
    return json.dumps({"hourly": {k: v for k, v in hourly.items() if v is not ...}})


def frame(spark, *texts, city=4):
    return spark.createDataFrame([(city, n, t, STAMP) for n, t in enumerate(texts)], SCHEMA)


def verdicts(spark, *texts):
    rows = validate_responses(frame(spark, *texts)).orderBy("n").collect()
    return [(r.reject_reason, r.reject_fields) for r in rows]


def events(spark, *texts, city=4):
    flat = flatten_hourly(frame(spark, *texts, city=city), city_dimension(spark))
    return flat.orderBy("measurement_timestamp").collect()


def test_every_hour_becomes_an_event_of_its_city(spark):
    got = events(spark, body())
    assert [e.measurement_timestamp for e in got] == HOURS
    assert {(e.source, e.city_id, e.city, e.ingestion_timestamp_utc) for e in got} == {("openmeteo", 4, "Paris", STAMP)}
    for field, first in zip(REQUIRED_HOURLY_FIELDS[1:], (0, 5, 10, 15), strict=True):
        assert [e[field] for e in got] == [first, first + 1, first + 2]


@pytest.mark.parametrize(
    "text, verdict",
    [
        (body(), (None, None)),
        ("{", ("malformed_json", None)),
        (body().replace("[0, 1, 2]", "[NaN, 1, 2]"), (None, None)),
        (body().replace("[0, 1, 2]", "[NaN, 1"), ("malformed_json", None)),
        (body().replace('"pm10"', '"pm10": null, "pm10"'), (None, None)),
        (body()[:-2] + ', "pm10": null}}', ("non_array_fields", "pm10")),
        (body(pm10=...).replace("[0, 1, 2]", "[-Infinity, 1, 2]"), ("missing_fields", "pm10")),
        ('{"hourly": 3, "x": NaN}', ("missing_hourly", None)),
        ('{"x": NaN}', ("missing_hourly", None)),
        ('{"hourly": {}, "hourly": ' + body()[11:-1] + "}", (None, None)),
        ("NaN", ("malformed_json", None)),
        (None, ("missing_hourly", None)),
        ("[]", ("missing_hourly", None)),
        ('{"hourly": 3}', ("missing_hourly", None)),
        ('{"daily": {}}', ("missing_hourly", None)),
        (body(pm2_5=...), ("missing_fields", "pm2_5")),
        (body(pm2_5=..., time=...), ("missing_fields", "time,pm2_5")),
        (body(pm10=None), ("non_array_fields", "pm10")),
        (body(nitrogen_dioxide="[7, 8, 9]"), ("non_array_fields", "nitrogen_dioxide")),
        (body(**{f: [] for f in REQUIRED_HOURLY_FIELDS}), ("empty_time", None)),
        (body(european_aqi=[1, 2]), ("inconsistent_lengths", None)),
        (body(european_aqi=[1, None, 2]), (None, None)),
    ],
)
def test_first_broken_rule_is_the_reason(spark, text, verdict):
    assert verdicts(spark, text) == [verdict]


def test_only_valid_responses_are_flattened(spark):
    assert len(events(spark, body(), body(pm10=[1.5]), "{")) == 3


@pytest.mark.parametrize(
    "field, values, read",
    [
        ("european_aqi", [33.5, 34, 35], [None, 34, 35]),
        ("european_aqi", ["33", 34, 35], [None, 34, 35]),
        ("european_aqi", [None, 34, 10**12], [None, 34, None]),
        ("pm10", ["n/a", 2, 2.25], [None, 2.0, 2.25]),
        ("pm2_5", [{"v": 1}, [2], True], [None, None, None]),
    ],
)
def test_a_mistyped_element_is_null_for_its_hour_only(spark, field, values, read):
    got = events(spark, body(**{field: values}))
    assert [e[field] for e in got] == read
    assert [e.measurement_timestamp for e in got] == HOURS


def test_bare_numbers_and_repeated_keys_are_read_as_lenient_parsers_do(spark):
    pm10, aqi = json.dumps(json.loads(body())["hourly"]["pm10"]), "[0, 1, 2]"
    assert pm10 in body() and aqi in body()
    text = body().replace(pm10, "[NaN, Infinity, 2.5]").replace('"pm2_5"', '"pm2_5": [], "pm2_5"')
    got = events(spark, text)
    plain = json.loads(text)["hourly"]
    for e, a, b, c in zip(got, plain["pm10"], plain["pm2_5"], plain["european_aqi"], strict=True):
        assert (str(e.pm10), e.pm2_5, e.european_aqi) == (str(float(a)), b, c)
    got = events(spark, body().replace(aqi, "[NaN, 1, 2]"))
    assert [e[REQUIRED_HOURLY_FIELDS[1]] for e in got][1:] == [1, 2]


def test_only_refused_texts_are_parsed_again(spark):
    plan = validate_responses(frame(spark, body()))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_parse_json") + plan.count("parseJson") == 1
    again = [line for line in plan.splitlines() if "from_json" in line]
    assert again and all("CASE WHEN" in line for line in again)


def test_unknown_city_has_a_reason_and_no_events(spark):
    df = frame(spark, body(), "{", city=99)
    rows = validate_responses(df, cities=city_dimension(spark)).orderBy("n").collect()
    assert [r.reject_reason for r in rows] == ["unknown_city", "malformed_json"]
    assert events(spark, body(), city=99) == []


def test_ingestion_time_is_stamped_in_utc_where_absent(spark):
    df = frame(spark, body()).drop("ingestion_timestamp_utc")
    got = flatten_hourly(df, city_dimension(spark)).collect()
    assert len({e.ingestion_timestamp_utc for e in got}) == 1
    assert all(e.ingestion_timestamp_utc.endswith("+00:00") for e in got)


def test_utc_wall_clock_tells_the_repeated_hour_apart(spark):
    """Clocks going back: two instants with one session wall clock."""
    from pyspark.sql import functions as F

    from airlake.functions.timestamps import iso_utc_text, to_utc_wallclock

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Athens")
    try:
        fold = spark.createDataFrame([(1698540600,), (1698544200,), (-1,)], "s long")  # both 03:50 in Athens
        instants = fold.select(F.timestamp_seconds("s").alias("t"))
        got = [r[0] for r in instants.select(iso_utc_text(to_utc_wallclock("t"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [
        "2023-10-29T00:50:00.000000+00:00",
        "2023-10-29T01:50:00.000000+00:00",
        "1969-12-31T23:59:59.000000+00:00",
    ]
