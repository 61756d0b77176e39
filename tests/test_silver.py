"""Silver semantics: one test per trap and idempotence.

T3 malformed timestamps -> NULL under ANSI; T4/T5 wall clock read in the session
zone; T6 ``as_of`` fixes "now" (future flag); T7 null-safe flags, zero valid;
T8 NaN passes; T9 tie-break; T10 dedup on city_id, Gold groups on the name;
T11 newer invalid does not displace older valid; T12 NULL AQI dropped by the
key filter, negative by the flag; T13 persisted flags all true.
"""

import datetime as dt
import math

from pyspark.sql import Row
from pyspark.sql import functions as F

from airlake.operators.silver import (
    flag_readings,
    key_filtered,
    latest_readings,
    silver,
    stage_counts,
    typed_readings,
    valid_readings,
)
from airlake.schemas import EVENT_COLUMNS, EVENT_SCHEMA

AS_OF = "2026-07-11 00:00:00"


def ev(**kw):
    base = dict(
        source="openmeteo",
        latitude=37.9838,
        longitude=23.7275,
        city_id=1,
        city="Athens",
        country="Greece",
        measurement_timestamp="2026-07-10T00:00",
        european_aqi=40,
        pm10=30.0,
        pm2_5=15.0,
        nitrogen_dioxide=20.0,
        ingestion_timestamp_utc="2026-07-10T10:00:00+00:00",
    )
    base.update(kw)
    return Row(**{c: base[c] for c in EVENT_COLUMNS})


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), EVENT_SCHEMA)


def test_malformed_timestamps_become_null_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = frame(spark, ev(measurement_timestamp="bad"), ev(measurement_timestamp=""), ev())
    typed = typed_readings(df)
    assert typed.where(F.col("measurement_timestamp").isNull()).count() == 2
    assert key_filtered(typed).count() == 1


def test_flags_are_null_safe_and_zero_is_valid(spark):
    df = frame(spark, ev(pm10=None), ev(pm10=0.0), ev(pm10=-1.0))
    flags = [r.is_valid_pm10 for r in flag_readings(typed_readings(df), AS_OF).collect()]
    assert flags == [False, True, False]


def test_nan_passes_validity(spark):
    df = frame(spark, ev(pm10=float("nan")))
    out = valid_readings(flag_readings(typed_readings(df), AS_OF)).collect()
    assert len(out) == 1 and math.isnan(out[0].pm10)


def test_future_measurement_flagged(spark):
    df = frame(spark, ev(measurement_timestamp="2099-01-01T00:00"), ev())
    flags = [r.is_not_future_measurement for r in flag_readings(typed_readings(df), AS_OF).collect()]
    assert flags == [False, True]


def test_null_aqi_dropped_by_key_filter_negative_by_flag(spark):
    df = frame(spark, ev(european_aqi=None), ev(european_aqi=-1), ev(european_aqi=0))
    keyed = key_filtered(typed_readings(df))
    assert keyed.count() == 2
    assert valid_readings(flag_readings(keyed, AS_OF)).count() == 1


def test_latest_ingestion_wins(spark):
    df = frame(
        spark,
        ev(european_aqi=10, ingestion_timestamp_utc="2026-07-10T10:00:00+00:00"),
        ev(european_aqi=20, ingestion_timestamp_utc="2026-07-10T11:00:00+00:00"),
        ev(european_aqi=30, city_id=2, city="Thessaloniki"),
    )
    out = {r.city_id: r.european_aqi for r in silver(df, AS_OF).collect()}
    assert out == {1: 20, 2: 30}


def test_newer_invalid_does_not_displace_older_valid(spark):
    df = frame(
        spark,
        ev(european_aqi=10, ingestion_timestamp_utc="2026-07-10T10:00:00+00:00"),
        ev(european_aqi=-5, ingestion_timestamp_utc="2026-07-10T11:00:00+00:00"),
    )
    out = silver(df, AS_OF).collect()
    assert [r.european_aqi for r in out] == [10]


def test_tie_break_makes_equal_ingestion_deterministic(spark):
    df = frame(spark, ev(european_aqi=10), ev(european_aqi=30), ev(european_aqi=20))
    out = silver(df, AS_OF, tie_break=("european_aqi",)).collect()
    assert [r.european_aqi for r in out] == [30]


def test_persisted_flags_all_true(spark):
    df = frame(spark, ev(), ev(city_id=2), ev(pm2_5=-1.0, city_id=3))
    out = silver(df, AS_OF).collect()
    assert len(out) == 2
    assert all(all(r[f] for f in ("is_valid_aqi", "is_valid_pm10", "is_valid_pm2_5",
                                  "is_valid_nitrogen_dioxide", "is_not_future_measurement")) for r in out)


def test_wall_clock_read_in_session_zone(spark):
    """Offset-less measurement text is read in the session zone; UTC text is not."""
    df = frame(spark, ev(measurement_timestamp="2026-07-10T12:00", ingestion_timestamp_utc="2026-07-10T12:00:00+00:00"))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Athens")
        r = typed_readings(df).select(
            (F.col("ingestion_timestamp_utc").cast("long") - F.col("measurement_timestamp").cast("long")).alias("d")
        ).first()
        assert r.d == 3 * 3600
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_stage_counts_one_job(spark):
    df = frame(
        spark,
        ev(),
        ev(ingestion_timestamp_utc="2026-07-10T11:00:00+00:00"),
        ev(european_aqi=None),
        ev(pm10=-1.0, city_id=2),
    )
    r = stage_counts(df, AS_OF).first()
    assert (r.structured_rows, r.filtered_rows, r.valid_rows, r.silver_rows) == (4, 3, 2, 1)


def test_dedup_plan_limits_rows_before_shuffle(spark):
    df = frame(spark, ev())
    plan = latest_readings(flag_readings(typed_readings(df), AS_OF))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_silver_is_idempotent(spark):
    from airlake.sources import fixtures
    from airlake.operators.bronze import parse_events

    events = fixtures.load(spark, "/root/testdata/sf0.001", "events")
    s1 = silver(parse_events(fixtures.aqi_json(events)), fixtures.FIXTURE_AS_OF)
    # back to the Bronze shape: timestamps as text again
    back = s1.select(
        *[
            F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias(c)
            if c in ("measurement_timestamp", "ingestion_timestamp_utc")
            else F.col(c)
            for c in EVENT_COLUMNS
        ]
    )
    s2 = silver(back, fixtures.FIXTURE_AS_OF)
    assert s1.count() == s2.count()
    assert s1.exceptAll(s2).count() == 0 and s2.exceptAll(s1).count() == 0


def test_dedup_keys_on_city_id_gold_groups_on_name(spark):
    """Two ids with one name are two Silver keys and one Gold group."""
    from airlake.operators.gold import daily_city_aqi

    df = frame(
        spark,
        ev(european_aqi=10, city_id=1, city="Athens"),
        ev(european_aqi=30, city_id=9, city="Athens"),
    )
    s = silver(df, AS_OF)
    assert s.count() == 2
    daily = daily_city_aqi(s, with_count=True).collect()
    assert [(r.city, r.record_count, r.avg_european_aqi) for r in daily] == [("Athens", 2, 20.0)]
