"""DuckDB SQL restating each registered query (the correctness oracle).

The adapter rules of :mod:`airlake.sources.fixtures` are restated once as
common table expressions; every oracle query builds on them. Conventions that
make two engines agree:

- rounding: ``round(CAST(x AS DECIMAL(18,9)), n)::DOUBLE`` reproduces Spark's
  HALF_UP rounding of a double's decimal text;
- ranks are cast to INTEGER (Spark's rank type);
- timestamps are naive: measurement = wall clock, ingestion = UTC wall clock;
- ``NULLS LAST`` is spelled out wherever order matters;
- of readings with one key and ingestion time the greatest measures win.
"""

from __future__ import annotations

from airlake.schemas import CITIES

AS_OF_SQL = "TIMESTAMP '2025-01-01 00:00:00'"

_CITY_VALUES = ", ".join(
    f"({cid}, '{name}', '{country}', CAST({lat} AS DOUBLE), CAST({lon} AS DOUBLE))"
    for cid, name, country, lat, lon in CITIES
)


def _city_cte(mode: str) -> str:
    if mode == "reference":
        return f"""cities(city_id, city, country, latitude, longitude) AS (VALUES {_CITY_VALUES}),
city_of_event AS (
  SELECT e.event_id, c.city_id AS city_key, c.city, c.country, c.latitude, c.longitude
  FROM events e JOIN cities c ON c.city_id = CAST(e.user_id % 5 + 1 AS INTEGER)
)"""
    return """city_of_event AS (
  SELECT event_id, CAST(user_id + 1 AS INTEGER) AS city_key,
         'city_' || CAST(user_id + 1 AS VARCHAR) AS city,
         'country_' || CAST((user_id + 1) % 20 AS VARCHAR) AS country,
         CAST(((user_id + 1) * 7) % 180 - 90 AS DOUBLE) AS latitude,
         CAST(((user_id + 1) * 13) % 360 - 180 AS DOUBLE) AS longitude
  FROM events
)"""


def _rows_cte(mode: str) -> str:
    """CTEs ``rows`` (adapted relational rows) and ``parsed`` (what survives
    JSON parsing and the Bronze source filter)."""
    return f"""{_city_cte(mode)},
rows AS (
  SELECT e.event_id,
    CASE WHEN e.event_id % 23 = 0 THEN 'other' ELSE 'openmeteo' END AS source,
    c.latitude, c.longitude,
    CASE WHEN e.event_id % 41 = 0 THEN NULL ELSE c.city_key END AS city_id,
    c.city, c.country,
    CASE WHEN e.event_id % 43 = 0 THEN 'bad'
         WHEN e.event_id % 37 = 0 THEN '2099-01-01T00:00'
         ELSE strftime(e.ts, '%Y-%m-%dT%H:00') END AS measurement_timestamp,
    CAST(CASE WHEN e.event_id % 29 = 0 THEN NULL WHEN e.event_id % 31 = 0 THEN -1
              ELSE floor(e.value) END AS INTEGER) AS european_aqi,
    CAST(CASE WHEN e.event_id % 47 = 0 THEN NULL WHEN e.event_id % 53 = 0 THEN -1
              ELSE floor(e.value * 4) / 4 END AS DOUBLE) AS pm10,
    CAST(CASE WHEN e.event_id % 59 = 0 THEN NULL WHEN e.event_id % 61 = 0 THEN -1
              ELSE floor(e.value * 2) / 4 END AS DOUBLE) AS pm2_5,
    CAST(CASE WHEN e.event_id % 67 = 0 THEN NULL WHEN e.event_id % 71 = 0 THEN -1
              ELSE floor(e.value * 8) / 16 END AS DOUBLE) AS nitrogen_dioxide,
    strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS ingestion_timestamp_utc
  FROM events e JOIN city_of_event c ON c.event_id = e.event_id
),
parsed AS (
  SELECT * FROM rows
  WHERE source = 'openmeteo' AND (event_id % 73 = 0) IS NOT TRUE
),
typed AS (
  SELECT source, latitude, longitude, city_id, city, country,
    try_cast(measurement_timestamp AS TIMESTAMP) AS measurement_timestamp,
    european_aqi, pm10, pm2_5, nitrogen_dioxide,
    try_cast(ingestion_timestamp_utc AS TIMESTAMP) AS ingestion_timestamp_utc
  FROM parsed
),
keyed AS (
  SELECT * FROM typed
  WHERE source = 'openmeteo' AND city_id IS NOT NULL
    AND measurement_timestamp IS NOT NULL AND european_aqi IS NOT NULL
),
flagged AS (
  SELECT *,
    european_aqi IS NOT NULL AND european_aqi >= 0 AS is_valid_aqi,
    pm10 IS NOT NULL AND pm10 >= 0 AS is_valid_pm10,
    pm2_5 IS NOT NULL AND pm2_5 >= 0 AS is_valid_pm2_5,
    nitrogen_dioxide IS NOT NULL AND nitrogen_dioxide >= 0 AS is_valid_nitrogen_dioxide,
    measurement_timestamp <= {AS_OF_SQL} AS is_not_future_measurement
  FROM keyed
),
valid AS (
  SELECT * FROM flagged
  WHERE is_valid_aqi AND is_valid_pm10 AND is_valid_pm2_5
    AND is_valid_nitrogen_dioxide AND is_not_future_measurement
),
silver AS (
  SELECT * FROM valid
  QUALIFY row_number() OVER (PARTITION BY city_id, measurement_timestamp
                             ORDER BY ingestion_timestamp_utc DESC NULLS LAST,
                               european_aqi DESC NULLS LAST, pm10 DESC NULLS LAST,
                               pm2_5 DESC NULLS LAST, nitrogen_dioxide DESC NULLS LAST) = 1
),
dated AS (
  SELECT *, CAST(measurement_timestamp AS DATE) AS measurement_date FROM silver
)"""


EVENT_COLS = (
    "source, latitude, longitude, city_id, city, country, measurement_timestamp, "
    "european_aqi, pm10, pm2_5, nitrogen_dioxide, ingestion_timestamp_utc"
)
FLAG_COLS = (
    "is_valid_aqi, is_valid_pm10, is_valid_pm2_5, is_valid_nitrogen_dioxide, is_not_future_measurement"
)


def _r(expr: str, n: int) -> str:
    return f"round(CAST({expr} AS DECIMAL(18,9)), {n})::DOUBLE"


def _daily_select(scales: dict, with_count: bool) -> str:
    parts = ["city", "measurement_date"]
    for m in ["european_aqi", "pm10", "pm2_5", "nitrogen_dioxide"]:
        parts.append(f"{_r(f'avg({m})', scales[m])} AS avg_{m}")
        parts.append(f"max({m}) AS max_{m}")
    if with_count:
        parts.append("count(*) AS record_count")
    return "SELECT " + ", ".join(parts) + " FROM dated GROUP BY city, measurement_date"


LOCAL = {"european_aqi": 2, "pm10": 2, "pm2_5": 2, "nitrogen_dioxide": 2}
CLOUD = {"european_aqi": 2, "pm10": 2, "pm2_5": 0, "nitrogen_dioxide": 0}


def _with(mode: str, body: str, extra: str = "") -> str:
    return f"WITH {_rows_cte(mode)}{extra}\n{body}"


def _daily_ctes(mode: str = "reference") -> str:
    return (
        f",\ndaily_local AS ({_daily_select(LOCAL, False)}),\n"
        f"daily_cloud AS ({_daily_select(CLOUD, True)}),\n"
        "ranking_cloud AS (SELECT *, CAST(rank() OVER (PARTITION BY city ORDER BY avg_european_aqi DESC NULLS LAST)"
        " AS INTEGER) AS rank FROM daily_cloud),\n"
        "freshness_cloud AS (SELECT city, max(ingestion_timestamp_utc) AS latest_ingestion_timestamp_utc,"
        " max(measurement_timestamp) AS latest_measurement_timestamp FROM dated GROUP BY city),\n"
        "completeness AS (SELECT city, measurement_date, count(*) AS actual_records, 24 AS expected_records, "
        f"{_r('count(*) / 24 * 100', 2)} AS completeness_pct FROM dated GROUP BY city, measurement_date)"
    )


def _responses_cte(mode: str) -> str:
    if mode == "reference":
        city_key = "CAST(user_id % 5 + 1 AS INTEGER)"
        dim = f"cities(city_id, city, country, latitude, longitude) AS (VALUES {_CITY_VALUES})"
    else:
        city_key = "CAST(user_id + 1 AS INTEGER)"
        dim = """cities AS (SELECT DISTINCT CAST(user_id + 1 AS INTEGER) AS city_id,
  'city_' || CAST(user_id + 1 AS VARCHAR) AS city,
  'country_' || CAST((user_id + 1) % 20 AS VARCHAR) AS country,
  CAST(((user_id + 1) * 7) % 180 - 90 AS DOUBLE) AS latitude,
  CAST(((user_id + 1) * 13) % 360 - 180 AS DOUBLE) AS longitude FROM events WHERE user_id IS NOT NULL)"""
    return f"""{dim},
base AS (
  SELECT {city_key} AS city_id, date_trunc('hour', ts) AS hour, ts, value
  FROM events WHERE ts IS NOT NULL AND user_id IS NOT NULL
),
hourly AS (
  SELECT city_id, hour, arg_max_null(value, ts) AS value, max(ts) AS last_ts
  FROM base GROUP BY city_id, hour
),
resp AS (
  SELECT city_id, CAST(hour AS DATE) AS response_date, max(last_ts) AS ingest_ts, min(hour) AS first_hour,
         (CAST(hour AS DATE) - DATE '2024-01-01') * 31 + city_id AS k
  FROM hourly GROUP BY city_id, CAST(hour AS DATE)
)"""


def _present_cols() -> str:
    return EVENT_COLS


def oracle_sql() -> dict[str, str]:
    ref = "reference"
    q: dict[str, str] = {}
    q["decode_value"] = "SELECT event_id, props AS json_string FROM events"
    q["parse_events"] = _with(ref, f"SELECT {EVENT_COLS} FROM parsed")
    q["typed_readings"] = _with(ref, f"SELECT {EVENT_COLS} FROM typed")
    q["key_filtered"] = _with(ref, f"SELECT {EVENT_COLS} FROM keyed")
    q["flag_readings"] = _with(ref, f"SELECT {EVENT_COLS}, {FLAG_COLS} FROM flagged")
    q["valid_readings"] = _with(ref, f"SELECT {EVENT_COLS}, {FLAG_COLS} FROM valid")
    q["latest_readings"] = _with(ref, f"SELECT {EVENT_COLS}, {FLAG_COLS} FROM silver")
    # the incremental merge must give exactly the full recompute
    q["latest_readings_incremental"] = q["latest_readings"]
    q["latest_readings_incremental_advancing"] = q["latest_readings"]
    q["stage_counts"] = _with(
        ref,
        """SELECT (SELECT count(*) FROM parsed) AS structured_rows,
  (SELECT count(*) FROM keyed) AS filtered_rows,
  (SELECT count(*) FROM valid) AS valid_rows,
  (SELECT count(*) FROM silver) AS silver_rows""",
    )
    q["with_measurement_date"] = _with(ref, f"SELECT {EVENT_COLS}, {FLAG_COLS}, measurement_date FROM dated")
    d = _daily_ctes()
    q["daily_city_aqi"] = _with(ref, "SELECT * FROM daily_local ORDER BY city, measurement_date", d)
    q["daily_city_aqi_cloud"] = _with(ref, "SELECT * FROM daily_cloud ORDER BY city, measurement_date", d)
    q["daily_city_ranking"] = _with(
        ref,
        "SELECT *, CAST(dense_rank() OVER (PARTITION BY measurement_date ORDER BY avg_european_aqi DESC NULLS LAST)"
        " AS INTEGER) AS aqi_rank FROM daily_local",
        d,
    )
    q["daily_city_ranking_cloud"] = _with(ref, "SELECT * FROM ranking_cloud", d)
    q["data_freshness"] = _with(
        ref, "SELECT city, max(ingestion_timestamp_utc) AS latest_ingestion_timestamp_utc FROM dated GROUP BY city"
    )
    q["data_freshness_incremental"] = q["data_freshness"]
    q["gold_incremental_recovery"] = _with(
        ref,
        "SELECT c.*, r.avg_european_aqi, r.aqi_rank, f.latest_ingestion_timestamp_utc FROM completeness c"
        " JOIN (SELECT *, CAST(dense_rank() OVER (PARTITION BY measurement_date ORDER BY avg_european_aqi DESC NULLS LAST)"
        " AS INTEGER) AS aqi_rank FROM daily_local) r ON r.city = c.city AND r.measurement_date = c.measurement_date"
        " JOIN freshness_cloud f ON f.city = c.city",
        d,
    )
    q["daily_city_ranking_cloud_incremental"] = q["daily_city_ranking_cloud"]
    q["data_freshness_cloud"] = _with(ref, "SELECT * FROM freshness_cloud", d)
    q["data_completeness"] = _with(ref, "SELECT * FROM completeness", d)
    q["report_daily_aqi"] = _with(ref, "SELECT * FROM daily_cloud ORDER BY measurement_date, city", d)
    q["worst_day_per_city"] = _with(
        ref,
        "SELECT measurement_date, city, avg_european_aqi, rank FROM ranking_cloud WHERE rank = 1"
        " ORDER BY measurement_date",
        d,
    )
    q["report_freshness"] = _with(ref, "SELECT * FROM freshness_cloud ORDER BY city", d)
    q["report_completeness"] = _with(ref, "SELECT * FROM completeness ORDER BY measurement_date, city", d)
    q["event_json_roundtrip"] = _with(ref, f"SELECT {EVENT_COLS} FROM rows WHERE source = 'openmeteo'")
    q["bronze_preview"] = _with(
        ref, f"SELECT {EVENT_COLS} FROM parsed ORDER BY ingestion_timestamp_utc NULLS LAST LIMIT 20"
    )
    q["bronze_stream"] = q["parse_events"]
    q["bronze_stream_resume"] = q["parse_events"]
    q["bronze_stream_default_trigger"] = _with(ref, f"SELECT {EVENT_COLS}, 3::BIGINT AS n_batches FROM parsed")
    q["flag_readings_now"] = q["flag_readings"]
    # the JSON text that DuckDB would write differs in number format: compare what it says
    q["stream_preview"] = _with(
        ref,
        "SELECT event_id % 73 = 0 AS junk, "
        + ", ".join(
            f"CASE WHEN event_id % 73 = 0 THEN NULL ELSE {c} END AS {c}"
            for c in ("source", "city_id", "measurement_timestamp", "european_aqi", "pm10")
        )
        + " FROM rows",
    )
    q["record_count"] = _with(ref, "SELECT count(*) AS n_rows FROM parsed")
    q["catalog_reports"] = _with(
        ref,
        "SELECT measurement_date, city, avg_european_aqi, rank, 4::BIGINT AS n_tables FROM ranking_cloud WHERE rank = 1",
        d,
    )
    q["catalog_switch"] = _with(
        ref,
        "SELECT measurement_date, city, avg_european_aqi, rank, 'spark_catalog' AS catalog FROM ranking_cloud WHERE rank = 1",
        d,
    )
    names = EVENT_COLS.replace(" ", "")
    q["json_sample"] = _with(ref, f"SELECT '{names}' AS fields, count(*) AS n_rows FROM parsed")
    q["file_inventory"] = "SELECT 'events.parquet' AS file_name, count(*) AS n_rows FROM events"
    for mode, key in ((ref, "validate_responses"), ("per_user", "validate_responses_per_user")):
        q[key] = f"""WITH {_responses_cte(mode)}
SELECT city_id, response_date,
  CASE WHEN k % 23 = 0 THEN 'malformed_json' WHEN k % 19 = 0 THEN 'empty_time'
       WHEN k % 17 = 0 THEN 'missing_fields' WHEN k % 13 = 0 THEN 'non_array_fields'
       WHEN k % 11 = 0 THEN 'inconsistent_lengths' END AS reject_reason,
  CASE WHEN k % 23 = 0 OR k % 19 = 0 THEN NULL WHEN k % 17 = 0 THEN 'european_aqi'
       WHEN k % 13 = 0 THEN 'pm10' END AS reject_fields
FROM resp"""
    for mode, key in ((ref, "flatten_hourly"), ("per_user", "flatten_hourly_per_user")):
        q[key] = f"""WITH {_responses_cte(mode)}
SELECT 'openmeteo' AS source, c.latitude, c.longitude, h.city_id, c.city, c.country,
  strftime(h.hour, '%Y-%m-%dT%H:00') AS measurement_timestamp,
  CASE WHEN r.k % 7 = 0 AND h.hour = r.first_hour THEN NULL
       ELSE CAST(floor(h.value) AS INTEGER) END AS european_aqi,
  floor(h.value * 4) / 4 AS pm10, floor(h.value * 2) / 4 AS pm2_5,
  floor(h.value * 8) / 16 AS nitrogen_dioxide,
  strftime(r.ingest_ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS ingestion_timestamp_utc
FROM hourly h
JOIN resp r ON r.city_id = h.city_id AND r.response_date = CAST(h.hour AS DATE)
JOIN cities c ON c.city_id = h.city_id
WHERE NOT (r.k % 23 = 0 OR r.k % 19 = 0 OR r.k % 17 = 0 OR r.k % 13 = 0 OR r.k % 11 = 0)"""
    q["validate_responses_lenient"] = q["validate_responses"]
    first = "h.city_id % 2 = 1 AND h.hour = r.first_hour"
    q["flatten_hourly_lenient"] = q["flatten_hourly"].replace(
        "floor(h.value * 4) / 4 AS pm10,",
        f"CASE WHEN {first} THEN NULL ELSE floor(h.value * 4) / 4 END AS pm10, {first} AS pm10_is_nan,",
    )
    q["ingestion_stamp"] = (
        "SELECT city_id, count(*) AS n_rows, true AS in_bracket, 1::BIGINT AS n_stamps "
        f"FROM ({q['flatten_hourly']}) GROUP BY city_id"
    )
    pu = "per_user"
    exact = "OVER (PARTITION BY measurement_date ORDER BY avg_european_aqi DESC NULLS LAST) AS INTEGER)"
    q["daily_city_ranking_exact_values"] = _with(
        pu,
        f"SELECT *, CAST(dense_rank() {exact} AS aqi_rank, CAST(rank() {exact} AS row_rank FROM "
        "(SELECT city, measurement_date, avg(european_aqi) AS avg_european_aqi FROM dated GROUP BY city, measurement_date)",
    )
    q["latest_readings_per_user"] = _with(pu, f"SELECT {EVENT_COLS}, {FLAG_COLS} FROM silver")
    q["daily_city_ranking_per_user"] = _with(
        pu,
        "SELECT *, CAST(dense_rank() OVER (PARTITION BY measurement_date ORDER BY avg_european_aqi DESC NULLS LAST)"
        " AS INTEGER) AS aqi_rank FROM daily_local",
        _daily_ctes(pu),
    )
    q["data_completeness_per_user"] = _with(pu, "SELECT * FROM completeness", _daily_ctes(pu))
    return q
