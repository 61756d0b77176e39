"""End-to-end batch runs: Bronze -> Silver -> Gold, local or cloud variant.

Hand-offs between layers are written tables (so every stage restarts from
storage after a failure). Gold scans Silver once: a single (city, date) rollup
carries every aggregate the four Gold tables need, is checkpointed to the
shared checkpoint folder, and the four tables are derived from it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airlake.operators.bronze import parse_events
from airlake.functions.checks import all_true
from airlake.operators.gold import VARIANTS, freshness_from_rollup, gold_from_rollup, gold_rollup
from airlake.operators.silver import flag_readings, key_filtered, latest_readings, typed_readings
from airlake.operators.silver import silver as silver_op
from airlake.plans.catalog import register_tables
from airlake.schemas import FLAG_COLUMNS
from airlake.session import ensure_checkpoint_dir
from airlake.sinks.writers import write_table
from airlake.sources.tables import read_table


def run_bronze_structured(spark: SparkSession, raw_path: str, out_path: str, fmt: str = "parquet") -> str:
    """Batch re-parse of the raw ``json_string`` Bronze table into the
    structured Bronze table (cloud form, D1)."""
    return write_table(parse_events(read_table(spark, raw_path, fmt)), out_path, fmt)


def run_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    fmt: str = "parquet",
    as_of=None,
    tie_break=(),
    partition_by=("measurement_date",),
) -> str:
    """Structured Bronze -> Silver, full recompute with overwrite. Partitioned
    by date, so that later runs for a date read that date only."""
    out = silver_op(read_table(spark, bronze_path, fmt), as_of=as_of, tie_break=tie_break)
    if partition_by and "measurement_date" in partition_by:
        out = out.withColumn("measurement_date", F.to_date("measurement_timestamp"))
    return write_table(out, silver_path, fmt, partition_by=partition_by)


def run_gold(
    spark: SparkSession, silver_path: str, gold_root: str, variant: str = "local", fmt: str = "parquet"
) -> dict[str, str]:
    """Silver -> the four Gold tables under ``gold_root``; returns name -> path."""
    ensure_checkpoint_dir(spark)
    rollup = gold_rollup(read_table(spark, silver_path, fmt), variant).checkpoint(eager=True)
    tables = gold_from_rollup(rollup, variant)
    paths = {}
    for name, df in tables.items():
        if name == "daily_city_aqi":
            df = df.orderBy("city", "measurement_date")
        paths[name] = write_table(df, f"{gold_root.rstrip('/')}/{name}", fmt)
    return paths


def run_batch(
    spark: SparkSession,
    bronze_path: str,
    root: str,
    variant: str = "local",
    fmt: str = "parquet",
    as_of=None,
    tie_break=(),
) -> dict[str, str]:
    """Structured Bronze at ``bronze_path`` -> ``root/silver`` -> ``root/gold/*``."""
    silver_path = run_silver(spark, bronze_path, f"{root.rstrip('/')}/silver", fmt, as_of, tie_break)
    paths = {"silver": silver_path}
    paths.update(run_gold(spark, silver_path, f"{root.rstrip('/')}/gold", variant, fmt))
    return paths


def run_all(
    spark: SparkSession,
    raw_path: str,
    root: str,
    variant: str = "cloud",
    fmt: str = "parquet",
    as_of=None,
    tie_break=(),
    schema: str | None = None,
) -> dict[str, str]:
    """The cloud run end to end, as its dependent steps: raw ``json_string``
    Bronze at ``raw_path`` -> structured Bronze -> Silver -> four Gold tables,
    then (``schema`` given) the Gold tables registered as external tables
    ``schema.<name>`` for the SQL reports. Each step reads the previous one's
    written output, so a failed step restarts from storage. Returns
    name -> path (plus ``bronze_structured``)."""
    base = root.rstrip("/")
    structured = run_bronze_structured(spark, raw_path, f"{base}/bronze_structured", fmt)
    paths = {"bronze_structured": structured}
    paths.update(run_batch(spark, structured, base, variant, fmt, as_of, tie_break))
    if schema:
        gold = {k: v for k, v in paths.items() if k not in ("bronze_structured", "silver")}
        register_tables(spark, schema, gold, fmt)
    return paths


# --- incremental runs ---------------------------------------------------------
# A full recompute reads all of Bronze every hour. Latest-wins is associative
# (the winner of old rows, merged with new rows, is the winner of all rows), and
# a key (city_id, measurement_timestamp) never changes its measurement date, so
# a batch of new Bronze rows only changes the Silver partitions of the dates it
# touches. Those partitions are merged and overwritten in place; so are the same
# dates of a (city, date) rollup and of the per-date Gold tables.
#
# Validity depends on the clock only through the "not in the future" flag: a
# reading that is otherwise valid but still in the future waits in a pending
# table and is judged again by every later run, so a run gives what a full
# recompute at its ``as_of`` would. The pending table is bounded by the readings
# ahead of the clock, not by history.

_DYNAMIC = {"partitionOverwriteMode": "dynamic"}


def _read_or_none(spark: SparkSession, path: str, fmt: str, schema=None) -> DataFrame | None:
    """The table, or None if the path does not exist. Any other failure to read
    it (an emptied folder, a broken file) is raised: taking it for a first run
    would replace what the table held."""
    try:
        return read_table(spark, path, fmt, schema)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "DELTA_PATH_DOES_NOT_EXIST"):
            return None
        raise


class SlotTable:
    """A small state table that survives an interrupted overwrite.

    A version is written to the slot that is not in use, then named by one
    appended row; until that row is there readers see the previous version.
    One writer at a time: an object reads the names once and then knows its own."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt
        self._known: int | None = None

    def version(self) -> int:
        if self._known is None:
            # with a schema: a folder that a first, cut-off append left empty names no version
            names = _read_or_none(self.spark, f"{self.root}/versions", "json", "version long")
            self._known = 0 if names is None else names.agg(F.max("version")).first()[0] or 0
        return self._known

    def read(self, version: int | None = None) -> DataFrame | None:
        """The current version, or an earlier one whose slot was not written since."""
        now = self.version() if version is None else version
        return read_table(self.spark, f"{self.root}/slot-{now % 2}", self.fmt) if now else None

    def write(self, df: DataFrame) -> int:
        new = self.version() + 1
        write_table(df, f"{self.root}/slot-{new % 2}", self.fmt)
        self._name(new)
        return new

    def _name(self, version: int) -> None:
        row = self.spark.range(1, numPartitions=1).select(F.lit(version).alias("version"))
        row.write.mode("append").json(f"{self.root}/versions")
        self._known = version


class DateJournal:
    """Dates on which Silver changes, from before it does until Gold has followed.

    An entry also names the staged version that holds the new Silver partitions,
    until they are known to be in place. At most one row per calendar day, so
    the entry is read on the driver."""

    SCHEMA = "measurement_date date, staged long"

    def __init__(self, spark: SparkSession, silver_path: str, fmt: str = "parquet"):
        base = silver_path.rstrip("/")
        self.spark = spark
        self.entries = SlotTable(spark, f"{base}_journal", fmt)
        self.staged = SlotTable(spark, f"{base}_staged", fmt)

    def unfinished(self) -> tuple[list, int | None]:
        """(dates, staged version) of the open entry; no dates if there is none."""
        table = self.entries.read()
        rows = [] if table is None else table.collect()
        return sorted(r.measurement_date for r in rows), rows[0].staged if rows else None

    def write(self, dates, staged: int | None = None) -> None:
        rows = self.spark.createDataFrame([(d, staged) for d in sorted(dates)], self.SCHEMA)
        self.entries.write(rows.coalesce(1))


def run_silver_incremental(
    spark: SparkSession,
    new_bronze,
    silver_path: str,
    fmt: str = "parquet",
    as_of=None,
    tie_break=(),
    pending_path: str | None = None,
) -> list:
    """Merge a batch of structured Bronze rows (path or DataFrame) into a
    Silver table partitioned by ``measurement_date``.

    Readings of the batch and of the pending table (``pending_path``, by default
    next to Silver) that are valid at ``as_of`` are merged; those that are only
    too early stay pending.

    A run may stop anywhere and be repeated. The merged partitions are staged,
    then the touched dates are entered in the :class:`DateJournal` next to Silver, then Silver
    and, after it, the pending table are written. The next run first puts the
    staged partitions of an open entry in place again (an overwrite may have
    stopped half way), and the dates stay in the journal until
    :func:`run_gold_incremental` has brought Gold up to date.

    Only the dates with merged readings are read, merged latest-wins and
    overwritten (dynamic partition overwrite). The touched dates are the one
    thing brought to the driver: none is later than ``as_of``, so a list bounded by
    calendar days, used as a static partition filter so the scan lists
    and reads only those date folders. The judged batch is checkpointed
    (read several times, computed once), and the merge is staged, so the overwrite
    never reads the files it replaces. Returns the dates this run touched."""
    ensure_checkpoint_dir(spark)
    journal = DateJournal(spark, silver_path, fmt)
    unfinished, staged = journal.unfinished()
    if staged is not None:
        _put_in_place(journal, staged, silver_path, fmt)
        journal.write(unfinished)  # the staged version may be replaced from here on
    new = read_table(spark, new_bronze, fmt) if isinstance(new_bronze, str) else new_bronze
    pending = SlotTable(spark, pending_path or f"{silver_path.rstrip('/')}_pending", fmt)
    waiting = pending.read()
    rows = key_filtered(typed_readings(new))
    if waiting is not None:
        rows = rows.unionByName(waiting)
    lasting = [c for c in FLAG_COLUMNS if c != "is_not_future_measurement"]
    judged = flag_readings(rows, as_of).where(all_true(lasting)).checkpoint(eager=True)
    fresh = judged.where("is_not_future_measurement").withColumn(
        "measurement_date", F.to_date("measurement_timestamp")
    )
    early = latest_readings(judged.where("not is_not_future_measurement"), tie_break=tie_break).drop(*FLAG_COLUMNS)
    dates = sorted(r[0] for r in fresh.select("measurement_date").distinct().collect())
    if dates:
        old = _read_or_none(spark, silver_path, fmt)
        if old is not None and "measurement_date" not in old.columns:
            raise ValueError(
                f"{silver_path} is not partitioned by measurement_date; build it with run_incremental "
                "or run_silver(partition_by=['measurement_date'])"
            )
        merging = fresh if old is None else old.where(F.col("measurement_date").isin(dates)).unionByName(fresh)
        staged = journal.staged.write(latest_readings(merging, tie_break=tie_break))
        journal.write({*dates, *unfinished}, staged)
        _put_in_place(journal, staged, silver_path, fmt)
    pending.write(early)
    return dates


def _put_in_place(journal: DateJournal, staged: int, silver_path: str, fmt: str) -> None:
    """Overwrite the date partitions of Silver that a staged version holds."""
    rows = journal.staged.read(staged)
    write_table(rows, silver_path, fmt, partition_by=["measurement_date"], options=_DYNAMIC)


def run_gold_incremental(
    spark: SparkSession,
    silver_path: str,
    dates: list,
    root: str,
    variant: str = "local",
    fmt: str = "parquet",
    ranking_buckets: int | None = None,
) -> dict[str, str]:
    """Bring ``root/rollup`` and the four Gold tables under ``root/gold`` up to
    date after Silver changed on ``dates``, and on those that the journal next to
    Silver still holds from runs that stopped before their Gold was written.
    The journal is closed at the end.

    - rollup: the (city, date) rows of ``dates`` are recomputed from those
      Silver partitions and overwritten (tables are partitioned by date);
    - per-date tables (daily table, completeness, and the local ranking, which
      ranks cities within a day): only the partitions of ``dates`` are
      recomputed from the rollup and overwritten;
    - freshness: a running max, merged from the previous state and the
      touched dates (a merge never lowers a city's latest timestamps). The state is a
      :class:`SlotTable` under ``root/state``; without one it is rebuilt from the whole
      rollup. The published table is an overwrite from the state, so an
      interrupted overwrite is repaired by the next run;
    - the cloud ranking ranks the days of a city. Without ``ranking_buckets`` it is rebuilt from the
      whole rollup (one row per city and day). With it the table is partitioned by
      ``city_bucket``, a hash of the city, and only buckets with a city of ``dates``
      are ranked again and overwritten; a table that is not partitioned so is rebuilt once.
    """
    base = root.rstrip("/")
    p = VARIANTS[variant]
    gold = f"{base}/gold"
    paths = {"rollup": f"{base}/rollup"}
    names = ("daily_city_aqi", "daily_city_ranking", "data_freshness", "data_completeness")
    paths.update({name: f"{gold}/{name}" for name in names})
    journal = DateJournal(spark, silver_path, fmt)
    dates = sorted({*dates, *journal.unfinished()[0]})
    if not dates:
        return paths  # nothing changed and nothing is open
    in_dates = F.col("measurement_date").isin(dates)
    silver = read_table(spark, silver_path, fmt).where(in_dates)
    write_table(gold_rollup(silver, variant), paths["rollup"], fmt, partition_by=["measurement_date"], options=_DYNAMIC)
    touched = gold_from_rollup(read_table(spark, paths["rollup"], fmt).where(in_dates), variant)
    per_date = ["daily_city_aqi", "data_completeness"]
    if p["rank_partition"] == "measurement_date":
        per_date.append("daily_city_ranking")
    elif ranking_buckets:
        _rank_touched_buckets(spark, paths, in_dates, variant, fmt, ranking_buckets)
    else:
        whole = gold_from_rollup(read_table(spark, paths["rollup"], fmt), variant)
        write_table(whole["daily_city_ranking"], paths["daily_city_ranking"], fmt)
    for name in per_date:
        order = ["measurement_date", "city"] if name == "daily_city_aqi" else None
        write_table(touched[name], paths[name], fmt, partition_by=["measurement_date"], sort_within=order, options=_DYNAMIC)
    state = SlotTable(spark, f"{base}/state/freshness_{variant}", fmt)
    known = state.read()
    if known is None:
        fresh = freshness_from_rollup(read_table(spark, paths["rollup"], fmt), variant)
    else:
        fresh = known.unionByName(touched["data_freshness"])
        fresh = fresh.groupBy("city").agg(*[F.max(c).alias(c) for c in fresh.columns if c != "city"])
    state.write(fresh)
    write_table(state.read(), paths["data_freshness"], fmt)
    journal.write([])
    return paths


def _rank_touched_buckets(
    spark: SparkSession, paths: dict[str, str], in_dates: Column, variant: str, fmt: str, buckets: int
) -> None:
    """Rank the days of all cities that share a bucket with a city of the touched
    dates, and overwrite those buckets of the ranking table. The touched buckets,
    at most ``buckets``, come to the driver and filter the rollup."""
    bucket = F.pmod(F.xxhash64("city"), F.lit(buckets)).cast("int")
    rollup = read_table(spark, paths["rollup"], fmt).withColumn("city_bucket", bucket)
    known = _read_or_none(spark, paths["daily_city_ranking"], fmt)
    options = _DYNAMIC
    if known is None or "city_bucket" not in known.columns:
        options = None
    else:
        touched = [r[0] for r in rollup.where(in_dates).select("city_bucket").distinct().collect()]
        rollup = rollup.where(F.col("city_bucket").isin(touched))
    ranked = gold_from_rollup(rollup.drop("city_bucket"), variant)["daily_city_ranking"]
    write_table(
        ranked.withColumn("city_bucket", bucket), paths["daily_city_ranking"], fmt, partition_by=["city_bucket"], options=options
    )


def run_incremental(
    spark: SparkSession,
    new_bronze,
    root: str,
    variant: str = "local",
    fmt: str = "parquet",
    as_of=None,
    tie_break=(),
    ranking_buckets: int | None = None,
) -> dict[str, str]:
    """One incremental run: a batch of structured Bronze -> ``root/silver``
    (date-partitioned, merged) -> ``root/rollup`` -> ``root/gold/*``. The
    first run on an empty ``root`` builds everything from the batch. Can be
    called from ``foreachBatch`` of the Bronze stream. A run that stopped
    anywhere is made good by the next one (tested after each write)."""
    base = root.rstrip("/")
    dates = run_silver_incremental(spark, new_bronze, f"{base}/silver", fmt, as_of, tie_break)
    paths = {"silver": f"{base}/silver"}
    paths.update(run_gold_incremental(spark, paths["silver"], dates, base, variant, fmt, ranking_buckets))
    return paths
