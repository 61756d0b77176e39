"""Incremental runs that stop anywhere and are repeated, and the state tables they rely on."""

import glob
import os
import shutil

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from airlake.operators.gold import gold_tables
from airlake.operators.silver import silver
from airlake.plans import medallion
from airlake.schemas import EVENT_SCHEMA

FIRST, SECOND = "2024-03-01 20:30:00", "2024-03-02 20:30:00"
#: A day east of UTC fetched at 20:30 UTC, its last hours still ahead; then another day
#: of another city. What becomes valid in between is not in the second batch.
DAY = [(8, "East", f"2024-03-01T{h:02d}:00", "2024-03-01T20:30:00.000000+00:00", h) for h in range(24)]
AFTER = [(9, "West", f"2024-03-02T{h:02d}:00", "2024-03-02T20:30:00.000000+00:00", 50 - h) for h in range(3)]


class Stopped(Exception):
    pass


def readings(spark, rows):
    full = [("openmeteo", 1.0, 2.0, i, c, "X", m, aqi, 1.0, 2.0, 3.0, t) for i, c, m, t, aqi in rows]
    return spark.createDataFrame(full, EVENT_SCHEMA)


def rows_of(df):
    columns = sorted(df.columns)
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def whole(spark, variant):
    """Silver and Gold of a full recompute, as sorted rows."""
    full = silver(readings(spark, DAY + AFTER), SECOND)
    return {"silver": rows_of(full)} | {k: rows_of(df) for k, df in gold_tables(full, variant).items()}


def stored(spark, paths):
    found = {"silver": rows_of(spark.read.parquet(paths["silver"]).drop("measurement_date"))}
    for name in ("daily_city_aqi", "daily_city_ranking", "data_freshness", "data_completeness"):
        found[name] = rows_of(spark.read.parquet(paths[name]).drop("city_bucket"))
    return found


def stop_at(monkeypatch, n, harm=None):
    """Let the n-th write of a run be its last; ``harm`` is done to the table then."""
    done = [0]
    write, name = medallion.write_table, medallion.SlotTable._name

    def counted(path):
        done[0] += 1
        if done[0] == n:
            if harm:
                harm(path)
            raise Stopped(path)

    def write_and_count(df, path, *args, **kwargs):
        write(df, path, *args, **kwargs)
        counted(path)

    def name_and_count(self, version):
        name(self, version)
        counted(f"{self.root}/versions")

    monkeypatch.setattr(medallion, "write_table", write_and_count)
    monkeypatch.setattr(medallion.SlotTable, "_name", name_and_count)
    return done


@pytest.mark.parametrize("variant, buckets, step", [("local", None, 1), ("cloud", 4, 4)])
def test_a_run_stopped_after_any_write_is_made_good_by_the_next(spark, tmp_dir, monkeypatch, variant, buckets, step):
    def run(root, rows, as_of):
        return medallion.run_incremental(spark, readings(spark, rows), root, variant, as_of=as_of, ranking_buckets=buckets)

    start = os.path.join(tmp_dir, "start")
    run(start, DAY, FIRST)
    want = whole(spark, variant)
    n, names = 1 - step, []
    while True:
        n += step
        root = os.path.join(tmp_dir, f"stop-{n}")
        shutil.copytree(start, root)
        with monkeypatch.context() as patch:
            done = stop_at(patch, n)
            try:
                run(root, AFTER, SECOND)
            except Stopped as e:
                names.append(os.path.relpath(str(e), root))
        if done[0] < n:  # the run had no n-th write
            break
        paths = run(root, AFTER, SECOND)
        assert stored(spark, paths) == want, names[-1]
        assert medallion.DateJournal(spark, paths["silver"]).unfinished() == ([], None)
    if step == 1:
        assert {"silver", "rollup", "gold/data_completeness", "gold/data_freshness"} <= set(names)
    assert len(names) > 12 / step


def test_a_stopped_run_is_made_good_by_a_later_one_too(spark, tmp_dir, monkeypatch):
    """Not repeated: the next batch holds nothing of the dates left open."""
    root = os.path.join(tmp_dir, "later")
    medallion.run_incremental(spark, readings(spark, DAY), root, as_of=FIRST)
    medallion.run_silver_incremental(spark, readings(spark, AFTER[:1]), f"{root}/silver", as_of=SECOND)
    paths = medallion.run_incremental(spark, readings(spark, AFTER[1:]), root, as_of=SECOND)
    assert stored(spark, paths) == whole(spark, "local")


def test_an_overwrite_of_silver_that_stopped_half_way_is_done_again(spark, tmp_dir, monkeypatch):
    root = os.path.join(tmp_dir, "half")
    medallion.run_incremental(spark, readings(spark, DAY), root, as_of=FIRST)

    def run():
        return medallion.run_incremental(spark, readings(spark, AFTER), root, as_of=SECOND)

    def lose(path):
        """The old partition is gone, the new one is not there yet."""
        for folder in glob.glob(f"{path}/measurement_date=2024-03-01"):
            shutil.rmtree(folder)

    probe = os.path.join(tmp_dir, "probe")
    shutil.copytree(root, probe)
    names = []
    with monkeypatch.context() as patch:
        write = medallion.write_table
        patch.setattr(medallion, "write_table", lambda df, path, *a, **k: (names.append(path), write(df, path, *a, **k))[1])
        name = medallion.SlotTable._name
        patch.setattr(medallion.SlotTable, "_name", lambda self, v: (names.append("name"), name(self, v))[1])
        medallion.run_incremental(spark, readings(spark, AFTER), probe, as_of=SECOND)
    at = names.index(f"{probe}/silver") + 1
    with monkeypatch.context() as patch:
        stop_at(patch, at, harm=lose)
        with pytest.raises(Stopped):
            run()
    assert spark.read.parquet(f"{root}/silver").where("measurement_date = '2024-03-01'").count() == 0
    assert stored(spark, run()) == whole(spark, "local")


def test_a_versions_folder_without_files_names_no_version(spark, tmp_dir):
    table = medallion.SlotTable(spark, os.path.join(tmp_dir, "slots"))
    os.makedirs(f"{table.root}/versions/_temporary")  # a first append that was cut off
    assert table.version() == 0 and table.read() is None
    table.write(spark.range(3))
    assert table.version() == 1 and table.read().count() == 3


def test_an_earlier_version_is_readable_until_its_slot_is_used_again(spark, tmp_dir):
    table = medallion.SlotTable(spark, os.path.join(tmp_dir, "slots"))
    first, second = table.write(spark.range(1)), table.write(spark.range(2))
    assert (first, second) == (1, 2)
    assert table.read(first).count() == 1 and table.read().count() == 2


def test_untouched_ranking_buckets_keep_their_files(spark, tmp_dir):
    root, n = os.path.join(tmp_dir, "buckets"), 8
    cities = [(i, f"c{i}", "2024-03-01T00:00", "2024-03-01T01:00:00.000000+00:00", i) for i in range(40)]
    late = [(3, "c3", "2024-03-02T00:00", "2024-03-02T01:00:00.000000+00:00", 99)]

    def run(rows):
        return medallion.run_incremental(
            spark, readings(spark, rows), root, "cloud", as_of="2024-03-05 00:00:00", ranking_buckets=n
        )

    def files():
        return {
            os.path.basename(d): sorted(os.listdir(d)) for d in glob.glob(f"{root}/gold/daily_city_ranking/city_bucket=*")
        }

    paths = run(cities)
    before = files()
    run(late)
    after = files()
    own = spark.range(1).select(F.pmod(F.xxhash64(F.lit("c3")), F.lit(n))).first()[0]
    assert len(before) > 4 and {k for k in after if after[k] != before[k]} == {f"city_bucket={own}"}
    full = gold_tables(silver(readings(spark, cities + late), "2024-03-05 00:00:00"), "cloud")["daily_city_ranking"]
    assert rows_of(spark.read.parquet(paths["daily_city_ranking"]).drop("city_bucket")) == rows_of(full)


def test_a_ranking_without_buckets_is_rebuilt_into_them_once(spark, tmp_dir):
    root = os.path.join(tmp_dir, "rebuilt")
    medallion.run_incremental(spark, readings(spark, DAY), root, "cloud", as_of=FIRST)
    paths = medallion.run_incremental(spark, readings(spark, AFTER), root, "cloud", as_of=SECOND, ranking_buckets=4)
    assert stored(spark, paths) == whole(spark, "cloud")
    assert "city_bucket" in spark.read.parquet(paths["daily_city_ranking"]).columns


def test_other_read_errors_are_still_raised(spark, tmp_dir):
    os.makedirs(os.path.join(tmp_dir, "empty"))
    with pytest.raises(AnalysisException):
        medallion._read_or_none(spark, os.path.join(tmp_dir, "empty"), "parquet")
