"""Plan shape: the properties the scale design relies on, asserted on the
physical plans of registered queries (so a change cannot silently lose them)."""

import re

import pytest

import __spark_entry__ as entry
from airlake.session import partition_conf

SF = "/root/testdata/sf0.001"


def _plans(spark, key):
    qe = entry.queries()[key](spark, SF)._jdf.queryExecution()
    return qe.optimizedPlan().toString(), qe.executedPlan().toString()


def _read_schemas(phys):
    return re.findall(r"ReadSchema: (struct<[^>]*>)", phys)


@pytest.mark.parametrize("key", ["latest_readings", "daily_city_aqi", "stage_counts"])
def test_event_json_is_parsed_once(spark, key):
    opt, _ = _plans(spark, key)
    # the Generate barrier keeps Silver predicates from re-parsing the text
    assert opt.count("from_json(") == 1


def test_response_json_is_parsed_once(spark):
    opt, _ = _plans(spark, "flatten_hourly_per_user")
    assert opt.count("parseJson") == 1  # validation and arrays share the VARIANT
    # what VARIANT refuses, and only that, is parsed again
    again = [line for line in opt.splitlines() if "from_json(" in line]
    assert opt.count("from_json(") == 2 and len(again) == 2
    assert all("CASE WHEN" in line[: line.index("from_json(")] for line in again)


def test_no_query_spreads_its_input_round_robin(spark):
    for key in ("parse_events", "latest_readings", "flatten_hourly_per_user", "event_json_roundtrip"):
        _, phys = _plans(spark, key)
        assert "RoundRobinPartitioning" not in phys, key


def test_the_input_is_spread_where_the_caller_asks(spark):
    from airlake.sources import fixtures

    spark.conf.set(fixtures.SPREAD, "3")
    try:
        _, phys = _plans(spark, "parse_events")
    finally:
        spark.conf.unset(fixtures.SPREAD)
    assert "RoundRobinPartitioning(3)" in phys
    scan = phys[phys.index("RoundRobinPartitioning") :]
    assert "props" not in scan and "event_type" not in scan  # only the columns read are shuffled


def test_day_ranking_has_no_window_over_a_day_of_cities(spark):
    for key in ("daily_city_ranking", "daily_city_ranking_per_user"):
        opt, _ = _plans(spark, key)
        assert "Aggregate" in opt[opt.index("Window") :], key  # the window runs over distinct values


@pytest.mark.parametrize(
    "key, columns",
    [
        ("latest_readings", {"event_id", "ts", "user_id", "value"}),
        ("validate_responses", {"ts", "user_id", "value"}),
        ("file_inventory", set()),
    ],
)
def test_scans_read_only_referenced_columns(spark, key, columns):
    _, phys = _plans(spark, key)
    for schema in _read_schemas(phys):
        read = set(re.findall(r"(\w+):", schema))
        assert read <= columns, (key, read)


def test_dedup_limits_rows_per_key_before_the_shuffle(spark):
    _, phys = _plans(spark, "latest_readings")
    assert "WindowGroupLimit" in phys


@pytest.mark.parametrize("key", ["daily_city_aqi", "data_completeness_per_user", "flatten_hourly_per_user"])
def test_aggregates_combine_map_side(spark, key):
    _, phys = _plans(spark, key)
    assert re.search(r"partial_(avg|max|count|max_by)", phys)


def test_no_forced_broadcast_of_the_city_dimension(spark):
    from airlake.sources import fixtures
    from airlake.operators import ingest

    ev = fixtures.load(spark, SF, "events")
    plain = ingest.flatten_hourly(fixtures.hourly_responses(ev, "per_user"), fixtures.per_user_cities(ev))
    assert "strategy=broadcast" not in plain._jdf.queryExecution().analyzed().toString()


def test_partitioned_silver_prunes_dates(spark, tmp_dir):
    from pyspark.sql import functions as F

    from airlake.operators.bronze import parse_events
    from airlake.plans.medallion import run_silver
    from airlake.sinks.writers import write_table
    from airlake.sources import fixtures
    from airlake.sources.tables import read_table

    bronze = write_table(parse_events(fixtures.aqi_json(fixtures.load(spark, SF, "events"))), f"{tmp_dir}/bronze")
    path = run_silver(spark, bronze, f"{tmp_dir}/silver", as_of=fixtures.FIXTURE_AS_OF, partition_by=["measurement_date"])
    q = read_table(spark, path).where(F.col("measurement_date") == F.lit("2024-01-05").cast("date"))
    phys = q._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*measurement_date", phys)
    assert q.count() > 0


def test_partition_conf_scales_and_is_bounded():
    big = partition_conf(100 * 10**12, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 100_000  # capped
    assert int(big["spark.sql.files.maxPartitionBytes"]) == 512 << 20
    small = partition_conf(4 * 10**6, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16  # two per core
    mid = partition_conf(10**12, 800)
    assert int(mid["spark.sql.shuffle.partitions"]) == -(-(10**12 // 2) // (256 << 20))
    with pytest.raises(ValueError):
        partition_conf(1, 0)


def test_quarantine_parse_is_parsed_once_under_filters(spark):
    from pyspark.sql import functions as F

    from airlake.operators.bronze import parse_events_with_quarantine
    from airlake.operators.silver import silver
    from airlake.sources import fixtures

    raw = fixtures.aqi_json(fixtures.load(spark, SF, "events"))
    good = parse_events_with_quarantine(raw).where(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
    opt = silver(good, fixtures.FIXTURE_AS_OF)._jdf.queryExecution().optimizedPlan().toString()
    assert opt.count("from_json(") == 1


def test_incremental_merge_reads_only_touched_dates(spark, tmp_dir):
    from pyspark.sql import functions as F

    from airlake.operators.bronze import parse_events
    from airlake.plans.medallion import run_incremental
    from airlake.sources import fixtures
    from airlake.sources.tables import read_table

    b = parse_events(fixtures.aqi_json(fixtures.load(spark, SF, "events")))
    run_incremental(spark, b, tmp_dir, as_of=fixtures.FIXTURE_AS_OF)
    q = read_table(spark, f"{tmp_dir}/silver").where(F.col("measurement_date").isin(["2024-01-05", "2024-01-06"]))
    phys = q._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*measurement_date[^\]]* IN \(", phys)


def test_checkpoint_root_never_local_on_a_cluster(monkeypatch):
    from airlake import session

    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Ctx:
        def getCheckpointDir(self):
            return None

    class Fake:
        sparkContext = Ctx()

        def __init__(self, values):
            self.conf = Conf(values)

    assert session.ensure_checkpoint_dir(Fake({"spark.checkpoint.dir": "s3a://b/ckpt"})) == "s3a://b/ckpt"
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Fake({"spark.master": "yarn"}))
