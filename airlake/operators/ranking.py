"""Ranking within groups (W2, W3) with a plan that scales.

``strategy="window"`` is the textbook plan: one window partition per group.
That is fine when groups are small (days of one city), but ranking cities
*within a day* puts every city of a day into one task — at scale a handful of
huge tasks.

``strategy="values"`` ranks the *distinct ordering values* of each group
instead and joins the ranks back. Ranks depend only on how many rows carry a
greater value, so::

    dense_rank(v) = position of v among the distinct values (descending)
    rank(v)       = 1 + number of rows with a greater value

The distinct-value table is grouped with a partial hash aggregate (skew-safe)
and is bounded by the value domain, not by the row count: a rounded average
has few distinct values per day. The join back is an equi-join; AQE turns it
into a broadcast join when the measured value table is small.

``strategy="ranges"`` is for values that are nearly all distinct (unrounded
averages), where even the distinct values of a group are too many for one task.
They are range-partitioned by (group, value); a group's ranges are numbered
in its order, the counts of the ranges before give each range its offset, and a window
inside the range adds the rest. No task holds a group, however large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airlake.session import ensure_checkpoint_dir

_METHODS = ("rank", "dense_rank")


def rank_within(
    df: DataFrame,
    partition_by,
    order_col: str,
    method: str = "dense_rank",
    alias: str = "rank",
    strategy: str = "window",
) -> DataFrame:
    """Add ``alias`` = rank of ``order_col`` (descending, NULLs last) within
    ``partition_by``. ``method`` is ``"rank"`` or ``"dense_rank"``."""
    if method not in _METHODS:
        raise ValueError(f"method must be one of {_METHODS}")
    parts = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    order = F.col(order_col).desc_nulls_last()
    if strategy == "window":
        fn = F.dense_rank() if method == "dense_rank" else F.rank()
        return df.withColumn(alias, fn.over(Window.partitionBy(*parts).orderBy(order)))
    if strategy not in ("values", "ranges"):
        raise ValueError("strategy must be 'window', 'values' or 'ranges'")

    values = df.groupBy(*parts, order_col).agg(F.count(F.lit(1)).alias("_n"))
    above = F.lit(0)
    if strategy == "ranges":
        values, above = _in_ranges(values, parts, order, method), F.col("_above")
        w = Window.partitionBy(*parts, "_range").orderBy(order)
    else:
        w = Window.partitionBy(*parts).orderBy(order)
    if method == "dense_rank":
        r = F.row_number().over(w) + above
    else:
        # rows strictly above this value; values are distinct, so a running sum
        # over the default frame (range up to the current value) is exact
        r = F.sum("_n").over(w) - F.col("_n") + 1 + above
    ranked = values.select(
        *[F.col(c).alias(f"_k_{i}") for i, c in enumerate(parts)],
        F.col(order_col).alias("_k_v"),
        r.cast("int").alias(alias),
    )
    cond = [df[c].eqNullSafe(ranked[f"_k_{i}"]) for i, c in enumerate(parts)]
    cond.append(df[order_col].eqNullSafe(ranked["_k_v"]))
    return df.join(ranked, cond, "inner").select(*df.columns, alias)


def _in_ranges(values: DataFrame, parts: list[str], order: Column, method: str) -> DataFrame:
    """``values`` (one row per group and value) with ``_range``, the number of the
    range the value lies in, and ``_above``: values of the group (rows, for
    ``rank``) in the ranges before.

    The ranges are cut by Spark's sampled range partitioning and checkpointed,
    so the numbers stay what they are if a task is repeated. The offsets are a
    window over one row per group and range."""
    ensure_checkpoint_dir(values.sparkSession)
    placed = (
        values.repartitionByRange(*parts, order).withColumn("_range", F.spark_partition_id()).checkpoint(eager=True)
    )
    each = F.count(F.lit(1)) if method == "dense_rank" else F.sum("_n")
    before = Window.partitionBy(*parts).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy(*parts, "_range").agg(each.alias("_size"))
    offsets = sums.select(
        *[F.col(c).alias(f"_o_{i}") for i, c in enumerate(parts)],
        F.col("_range").alias("_o_range"),
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_above"),
    )
    same = [placed[c].eqNullSafe(offsets[f"_o_{i}"]) for i, c in enumerate(parts)]
    return placed.join(offsets, [*same, placed["_range"] == offsets["_o_range"]]).select(*placed.columns, "_above")
