"""Hot keys: one (city, hour) key holds a third of all rows. Results must stay
whole and equal a brute-force pandas computation (the plans that keep such a
key cheap are asserted in test_plans.py)."""

import datetime as dt
import random

import pandas as pd
from pyspark.sql import functions as F

from airlake.operators.gold import VARIANTS, daily_city_aqi, rank_daily
from airlake.operators.silver import latest_readings, stage_counts
from airlake.schemas import EVENT_COLUMNS

AS_OF = "2026-08-01 00:00:00"
N = 3000


def _rows():
    rnd = random.Random(7)
    out = []
    for i in range(N):
        hot = i % 3 == 0
        city_id = 1 if hot else rnd.randint(1, 40)
        hour = dt.datetime(2026, 7, 10) if hot else dt.datetime(2026, 7, 1) + dt.timedelta(hours=rnd.randint(0, 240))
        ingest = dt.datetime(2026, 7, 20) + dt.timedelta(seconds=i)  # unique: no ties
        out.append(
            dict(
                source="openmeteo",
                latitude=0.0,
                longitude=0.0,
                city_id=city_id,
                city=f"c{city_id}",
                country="x",
                measurement_timestamp=hour.strftime("%Y-%m-%dT%H:%M"),
                european_aqi=rnd.randint(0, 200),
                pm10=rnd.randint(0, 400) / 4,
                pm2_5=rnd.randint(0, 400) / 4,
                nitrogen_dioxide=rnd.randint(0, 400) / 8,
                ingestion_timestamp_utc=ingest.strftime("%Y-%m-%dT%H:%M:%S+00:00"),
            )
        )
    return pd.DataFrame(out, columns=EVENT_COLUMNS)


def _frame(spark, pdf):
    # spread over several input partitions, as a scan would be
    return spark.createDataFrame(pdf).repartition(6)


def _brute_latest(pdf):
    s = pdf.sort_values("ingestion_timestamp_utc", ascending=False)
    return s.drop_duplicates(["city_id", "measurement_timestamp"], keep="first")


def test_hot_key_dedup_and_counts(spark):
    from airlake.operators.silver import silver

    pdf = _rows()
    df = _frame(spark, pdf)
    got = silver(df, AS_OF).select("city_id", "measurement_timestamp", "european_aqi").toPandas()
    want = _brute_latest(pdf)
    assert len(got) == len(want)
    hot = got[(got.city_id == 1) & (got.measurement_timestamp == dt.datetime(2026, 7, 10))]
    assert len(hot) == 1
    newest_hot = want[(want.city_id == 1) & (want.measurement_timestamp == "2026-07-10T00:00")]
    assert hot.european_aqi.iloc[0] == newest_hot.european_aqi.iloc[0]
    c = stage_counts(df, AS_OF).first()
    assert (c.structured_rows, c.filtered_rows, c.valid_rows, c.silver_rows) == (N, N, N, len(want))


def test_hot_city_daily_aggregates_and_rankings(spark):
    pdf = _rows()
    pdf["ts"] = pd.to_datetime(pdf.measurement_timestamp)
    pdf["measurement_date"] = pdf.ts.dt.date
    df = _frame(spark, pdf).select(
        "city",
        F.col("ts").alias("measurement_timestamp"),
        "european_aqi",
        "pm10",
        "pm2_5",
        "nitrogen_dioxide",
    )
    local = VARIANTS["local"]
    daily = daily_city_aqi(df, local["scales"])
    got = daily.toPandas().set_index(["city", "measurement_date"]).sort_index()
    g = pdf.groupby(["city", "measurement_date"])
    assert len(got) == g.ngroups
    assert (got["max_european_aqi"].values == g.european_aqi.max().sort_index().values).all()
    mean = g.european_aqi.mean().sort_index().values
    assert (abs(got["avg_european_aqi"].values - mean) <= 0.005 + 1e-9).all()
    # both ranking plans agree under a hot city (window vs distinct values)
    by_window = rank_daily(daily, strategy="window").select("city", "measurement_date", "aqi_rank")
    by_value = rank_daily(daily, strategy="values").select("city", "measurement_date", "aqi_rank")
    assert by_window.exceptAll(by_value).count() == 0 and by_value.exceptAll(by_window).count() == 0
    assert by_value.count() == g.ngroups
