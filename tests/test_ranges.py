"""Ranking by ranges, and the drained stream."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from airlake.operators.ranking import rank_within
from airlake.sinks.writers import drain, write_table
from airlake.streaming.bronze_stream import file_value_stream

VALUES = st.one_of(st.none(), st.floats(-3, 3), st.sampled_from([0.0, -0.0, 1.5, float("nan"), float("inf")]))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), VALUES), max_size=40), st.sampled_from(["rank", "dense_rank"]))
def test_ranges_equal_the_window(spark, rows, method):
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(rows)], "id int, g string, v double")
    a, b = (
        sorted((r.id, r.k) for r in rank_within(df, "g", "v", method, "k", s).collect()) for s in ("window", "ranges")
    )
    assert a == b


def test_no_task_holds_a_group(spark):
    """One group with 20,000 distinct values: the windows inside ranges see a part each."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        df = spark.range(20_000, numPartitions=4).select(F.lit("day").alias("g"), (F.col("id") * 7919 % 20_000 / 3.0).alias("v"))
        ranked = rank_within(df, "g", "v", "dense_rank", "k", "ranges")
        assert ranked.agg(F.max("k"), F.count_distinct("k")).first() == (20_000, 20_000)
        plan = ranked._jdf.queryExecution().executedPlan().toString()
        assert "_range" in plan
        from airlake.operators.ranking import _in_ranges

        values = df.groupBy("g", "v").agg(F.count("*").alias("_n"))
        sizes = [r["count"] for r in _in_ranges(values, ["g"], F.col("v").desc(), "rank").groupBy("_range").count().collect()]
        assert len(sizes) == 16 and max(sizes) < 2 * 20_000 / 16
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_unknown_strategy(spark):
    with pytest.raises(ValueError):
        rank_within(spark.range(1).selectExpr("id g", "id v"), "g", "v", strategy="guess")


def _query(spark, tmp_dir, stream):
    return stream.writeStream.format("parquet").option("path", f"{tmp_dir}/out").option("checkpointLocation", f"{tmp_dir}/ckpt").start()


def test_drain_takes_every_file_in_bounded_batches(spark, tmp_dir):
    src = write_table(spark.range(50).select(F.col("id").cast("string").cast("binary").alias("value")).repartition(5), f"{tmp_dir}/src")
    batches = drain(_query(spark, tmp_dir, file_value_stream(spark, src, max_files=2)))
    assert [b.batchId for b in batches] == [0, 1, 2] and sum(b.numInputRows for b in batches) == 50
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 50
    # a second run has nothing to do and says so
    assert drain(_query(spark, tmp_dir, file_value_stream(spark, src, max_files=2))) == []


def test_drain_raises_what_the_query_failed_with(spark, tmp_dir):
    src = write_table(spark.range(3).select(F.lit("x").cast("binary").alias("value")), f"{tmp_dir}/src")
    bad = file_value_stream(spark, src).select(F.raise_error(F.lit("no good")).cast("string").alias("x"))
    with pytest.raises(Exception, match="no good"):
        drain(_query(spark, tmp_dir, bad))


def test_drain_gives_up_after_its_timeout(spark, tmp_dir):
    src = write_table(spark.range(3).select(F.lit("x").cast("binary").alias("value")), f"{tmp_dir}/src")
    query = _query(spark, tmp_dir, file_value_stream(spark, src))
    with pytest.raises(TimeoutError):
        drain(query, timeout=-1)
    assert not query.isActive
