"""Mixing sources to target weights by weighted fair queueing.

Every document waits in its source's queue, in a shuffled order that is a hash
of its id, source and text; of rows equal in all three each is a document of its own,
with its number in the hash. Its virtual finish time is the number of words its source
has delivered up to and including it, divided by the source's target; a
further pass over the source goes on counting. Taking all queues' entries in
order of finish time serves each source in proportion to its target, so the
mix is the global range sort by finish time, cut where its words reach the
budget.

Everything is DataFrame code. Running sums are made in levels, so that
neither a source nor the global order is one task: sums of hash ranges (or of
ranges of finish time) give each range its offset, by way of at most ``TOP_RANGES``
coarse ranges, and a window inside the range adds the rest. The number of ranges
follows the number of documents. Equal rows are counted before they are
shuffled, and numbered ``COPY_CHUNK`` at a time.

Defined results: null text has size 0; null sources are one source, last in
order; documents of size 0 are never queued and take 0 words; equal rows are taken one by one,
so some of them may be taken once more than others; null ids are
ordinary ids; an empty table gives no rows. Other columns play no part.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airlake.llm.common import materialize

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: Times a document is used at most.
PASSES = 3
#: Documents in a range of the running sums, about: of a source, where one source may
#: hold a large share of every range, and of the global order.
CELL_ROWS, RANGE_ROWS = 1024, 8192
#: Coarse ranges of a source's cells and of the global order, at most.
TOP_RANGES = 4096
#: Equal rows numbered in one step.
COPY_CHUNK = 4096
SPOT_BITS = 60


def size_of(text: Column) -> Column:
    """Number of words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    totals: DataFrame, weights: tuple = WEIGHTS, share: float = 1.0, passes: int = PASSES
) -> DataFrame:
    """``totals`` (source, source_size) plus ``place`` and ``target`` in words.

    Targets are ``weight * level``, at most ``passes`` times the source's size.
    Going up by size per weight, the level with all sources before capped is
    (budget left) / (weight left); it is final at the first source that it
    does not fill. One row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_fill = Window.orderBy("fill", "place")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    after = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")
    )
    steps = (
        totals.withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * float(passes))
        .withColumn("fill", F.col("cap") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(everything) * float(share))
        .withColumn("left", F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("step", F.col("left") / F.sum("weight").over(after))
    )
    final = F.col("fill") >= F.col("step")
    level = F.min_by(F.when(final, F.col("step")), F.when(final, F.struct("fill", "place"))).over(everything)
    target = F.when(level.isNull(), F.col("cap")).otherwise(F.least("cap", F.col("weight") * level))
    return steps.withColumn("target", target).select("source", "source_size", "place", "target", "budget")


def item_of(id_col: str, source_col: str, text_col: str) -> Column:
    """128 bits that tell documents apart by id, source and text, as hex."""

    def marked(name: str, mark: str) -> Column:
        return F.coalesce(F.concat(F.lit(mark), F.col(name).cast("string")), F.lit("n"))

    return F.md5(
        F.concat(marked(id_col, "i"), F.lit(" "), marked(source_col, "s"), F.lit(" "), F.coalesce(F.col(text_col), F.lit("")))
    )


def _range_bits(rows: int, each: int) -> int:
    """Bits of a range number for ranges of so many rows."""
    return (rows // each).bit_length()


def in_chunks(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` that stand for ``n`` copies each, cut into rows of ``COPY_CHUNK`` copies
    at most, ``first`` being how many come before. What had more is spread over
    tasks, and no array on the way is longer than ``n / COPY_CHUNK ** 2`` or ``COPY_CHUNK``."""
    zero, rest = F.lit(0).cast("long"), [c for c in rows.columns if c != "n"]
    few = rows.where(F.col("n") <= COPY_CHUNK).withColumn("first", zero)
    many = rows.where(F.col("n") > COPY_CHUNK).withColumn("first", zero)
    for unit in (COPY_CHUNK**2, COPY_CHUNK):
        own = F.lit(unit).cast("long")
        part = F.explode(F.sequence(zero, F.ceil(F.col("n") / own) - 1)).alias("_part")
        many = many.select("*", part).repartition(*keys, "_part").select(
            *rest,
            F.least(own, F.col("n") - F.col("_part") * own).alias("n"),
            (F.col("first") + F.col("_part") * own).alias("first"),
        )
    return few.unionByName(many)


def queue_items(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """One row per row of ``docs``: item, copy (its number among equal rows), doc_id, source,
    size and ``spot``, its place in the shuffled order.

    Equal rows are counted, not gathered, and spread again by :func:`in_chunks`."""
    counted = materialize(
        docs.select(
            item_of(id_col, source_col, text_col).alias("item"),
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            size_of(F.col(text_col)).alias("size"),
        )
        .groupBy("item", "doc_id", "source", "size")
        .agg(F.count("*").alias("n")),
        "mix-counts",
    )
    copies = in_chunks(counted, ["item"]).withColumn(
        "copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))
    )
    copy = F.col("first") + F.col("copy")
    place = F.md5(F.concat(F.col("item"), F.lit(" "), copy.cast("string")))
    spot = F.conv(F.substring(place, 1, SPOT_BITS // 4), 16, 10).cast("long")
    return copies.select("item", copy.alias("copy"), "doc_id", "source", "size", spot.alias("spot"))


def offsets(sums: DataFrame, parts: list[str], at: str, value: str, bits: int) -> DataFrame:
    """``sums`` with ``offset``, the sum of ``value`` over the rows of the same
    ``parts`` with a lower ``at`` (an integer of about so many ``bits``).

    Coarse ranges come first, then the rows inside each: with ``TOP_RANGES``
    coarse ranges neither step sees more than a small part of the rows."""
    shift = max(bits - (TOP_RANGES.bit_length() - 1), bits // 2)
    sums = sums.withColumn("_coarse", F.shiftright(at, shift))
    tops = sums.groupBy(*parts, "_coarse").agg(F.sum(value).alias("_sum"))
    whole = Window.partitionBy(*parts) if parts else Window.partitionBy(F.lit(0))
    before = whole.orderBy("_coarse").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    inside = Window.partitionBy(*parts, "_coarse").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum(value).over(inside), F.lit(0))
    return _with(sums.withColumn("_own", own), tops, *parts, "_coarse").select(
        *[c for c in sums.columns if c != "_coarse"], (F.col("_before") + F.col("_own")).alias("offset")
    )


def mix(
    items: DataFrame, weights: tuple = WEIGHTS, share: float = 1.0, passes: int = PASSES
) -> tuple[DataFrame, DataFrame]:
    """(items with source_size and target, entries taken) for materialised ``items``.

    An entry is one pass over an item: item, copy, pass, ``finish`` (virtual
    finish time) and ``position`` (words of the mix up to and with it). Sorting
    by position gives the mix's order."""
    rows = items.count()
    cell_bits = _range_bits(rows, CELL_ROWS)
    items = items.withColumn("cell", F.shiftright("spot", SPOT_BITS - cell_bits))
    # cells and what is planned for them are small tables that the rest reads several times
    cells = items.groupBy("source", "cell").agg(F.sum("size").alias("cell_words"), F.max("size").alias("largest"))
    cells = materialize(cells, "mix-cells")
    totals = cells.groupBy("source").agg(F.sum("cell_words").alias("source_size"), F.max("largest").alias("largest"))
    targets = _with(source_targets(totals.drop("largest"), weights, share, passes), totals.drop("source_size"), "source")
    targets = targets.withColumn("limit", _last_finish())
    cells = offsets(cells.drop("largest"), ["source"], "cell", "cell_words", cell_bits)
    plan = materialize(_with(cells.drop("cell_words"), targets.drop("largest"), "source"), "mix-plan")
    planned = _with(items, plan, "source", "cell")

    # finish times
    inside = Window.partitionBy("source", "cell").orderBy("spot", "item", "copy")
    run = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    queued = planned.where("size > 0").withColumn("sent", F.col("offset") + F.sum("size").over(run))
    span_bits = _range_bits(rows, RANGE_ROWS)
    entries = (
        queued.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))))
        .withColumn("finish", (F.col("sent") + F.col("pass") * F.col("source_size")) / F.col("target"))
        .where("finish <= limit")
        .withColumn("span", F.floor(F.col("finish") * (1 << span_bits)))
        .select("item", "copy", "source", "spot", "size", "place", "pass", "finish", "span", "budget")
    )

    # the global order by finish time, in ranges of it, cut at the budget
    sums = entries.groupBy("span").agg(F.sum("size").alias("span_words"))
    sums = offsets(sums, [], "span", "span_words", span_bits).drop("span_words")
    order = (
        Window.partitionBy("span")
        .orderBy("finish", "place", "spot", "item", "copy", "pass")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    taken = (
        _with(entries, sums, "span")
        .withColumn("position", F.col("offset") + F.sum("size").over(order))
        .where(F.col("position") <= F.col("budget"))
        .select("item", "copy", "source", "size", "pass", "finish", "position")
    )
    return planned.drop("cell", "offset", "budget", "limit"), taken


def _last_finish() -> Column:
    """A finish time past which no entry is within the budget.

    Up to time f a source has delivered f * target words, less than its largest
    document short of it, or all its passes, which are no fewer words than its target. So by
    1 + the greatest (largest document) / target every source has delivered its
    target, and together the budget."""
    late = F.max(F.try_divide(F.col("largest"), F.col("target"))).over(Window.partitionBy())
    return 1.000001 + F.coalesce(late, F.lit(0.0))


def _with(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """Left join on keys that may be null."""
    renamed = right.select(*[F.col(c).alias(f"{c}__r" if c in keys else c) for c in right.columns])
    on = reduce(and_, [left[k].eqNullSafe(renamed[f"{k}__r"]) for k in keys])
    return left.join(renamed, on, "left").drop(*[f"{k}__r" for k in keys])


def _uses(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    items, taken = mix(materialize(queue_items(docs), "mix-items"))
    return items, taken.groupBy("item", "copy").agg(F.count("*").alias("uses"))


def taken_words(docs: DataFrame) -> DataFrame:
    """Per document of the mix of all of ``docs``: doc_id, size, source_size,
    target and taken (words the mix takes of it, repeats counted)."""
    items, uses = _uses(docs)
    return items.join(uses, ["item", "copy"], "left").select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.coalesce("uses", F.lit(0))).alias("taken"),
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it is taken.

    Rows with the same id, source and text share their uses as evenly as they
    go, those that differ in other columns in the order of a hash of these. Rows
    equal in all columns are one row until they are written."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])  # keeps all names apart from the mix's own
    rest = F.md5(F.to_json(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in docs.columns if c != "text"])))
    keyed = docs.select(item_of("doc_id", "source", "text").alias("item"), rest.alias("rest"), whole.alias("row"))
    uses = materialize(_uses(docs)[1].groupBy("item").agg(F.sum("uses").alias("uses")), "mix-uses")
    counts = materialize(keyed.groupBy("item", "rest").agg(F.count("*").alias("n")), "mix-rows")
    totals = counts.groupBy("item").agg(F.sum("n").alias("total"))
    at = F.conv(F.substring("rest", 1, SPOT_BITS // 4), 16, 10).cast("long")
    counts = counts.join(totals.join(uses, "item"), "item").withColumn("at", at)
    # hashes that agree in these bits are one place: order them by the rest
    places = offsets(counts.groupBy("item", "at").agg(F.sum("n").alias("here")), ["item"], "at", "here", SPOT_BITS)
    inside = Window.partitionBy("item", "at").orderBy("rest").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("offset") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    more = F.greatest(F.lit(0), F.least("n", F.col("uses") % F.col("total") - F.col("first")))
    shares = materialize(
        counts.join(places.drop("here"), ["item", "at"])
        .withColumn("first", first)
        .select("item", "rest", (F.floor(F.col("uses") / F.col("total")) * F.col("n") + more).alias("n"))
        .where("n > 0"),
        "mix-shares",
    )

    def written(some: DataFrame) -> DataFrame:
        """A row for each (item, rest) of ``some``, with its n."""
        return keyed.groupBy("item", "rest").agg(F.first("row").alias("row")).join(some, ["item", "rest"])

    def repeated(rows: DataFrame) -> DataFrame:
        return rows.withColumn("use", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).select("row.*")

    taken = repeated(written(shares.where(F.col("n") <= COPY_CHUNK)))
    many = shares.where(F.col("n") > COPY_CHUNK)
    if many.isEmpty():
        return taken
    return taken.union(repeated(in_chunks(written(many), ["item", "rest"])))


TAKEN_WORDS_SQL = r"""
WITH items AS (
  SELECT doc_id, source, size, item, count(*) AS n FROM (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           md5(coalesce('i' || doc_id, 'n') || ' ' || coalesce('s' || source, 'n') || ' ' || coalesce(text, '')) AS item
    FROM documents)
  GROUP BY ALL
), copies AS (
  SELECT doc_id, source, size, item, unnest(range(n)) AS copy FROM items
), rows AS (
  SELECT *, ('0x' || substr(md5(item || ' ' || copy), 1, 15))::BIGINT AS spot FROM copies
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place,
         sum(sum(size)) OVER ()::DOUBLE AS budget
  FROM rows GROUP BY source
), fills AS (
  SELECT *, [5.0, 2.0, 1.0][place % 3 + 1]::DOUBLE AS weight, source_size * 3.0::DOUBLE AS cap FROM totals
), steps AS (
  SELECT *, cap / weight AS fill,
         (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS step
  FROM fills
), targets AS (
  SELECT source, source_size, place, budget,
         least(cap, weight * (SELECT arg_min(step, (fill, place)) FROM steps WHERE fill >= step)) AS target
  FROM steps
), queued AS (
  SELECT i.*, t.source_size, t.place, t.budget, t.target,
         sum(size) OVER (PARTITION BY t.place ORDER BY spot, item, copy
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sent
  FROM rows i JOIN targets t ON i.source IS NOT DISTINCT FROM t.source
), mix AS (
  SELECT item, copy, budget,
         sum(size) OVER (ORDER BY (sent + pass * source_size)::DOUBLE / target, place, spot, item, copy, pass
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS position
  FROM queued, (VALUES (0), (1), (2)) p(pass) WHERE size > 0
), uses AS (
  SELECT item, copy, count(*) AS uses FROM mix WHERE position <= budget GROUP BY ALL
)
SELECT q.doc_id, q.size, q.source_size, q.target, (q.size * coalesce(u.uses, 0))::BIGINT AS taken
FROM queued q LEFT JOIN uses u ON q.item = u.item AND q.copy = u.copy
"""
