"""Exact top-k by inner product with a Voronoi join.

Vectors become integers, floor(64 x). Pivots are drawn from the queries, as
many as a cost estimate on a sample finds best, and every query and every row of the data
belongs to its nearest pivot's group. Groups of queries have one summary: the radius r,
the largest distance of a query from its pivot p. Groups of data have two: the
radius R, and the distances d of the (k + 1) rows (of different ids) nearest their pivot s. With
q = p + e and x = s + f the product q.x is p.s + p.f + e.s + e.f, so

    p.s - |p| d - r (|s| + d)  <=  q.x  <=  p.s + |p| R + r (|s| + R)

From the summaries alone, the (k + 1)-th largest lower bound over the groups' nearest rows
is a score theta that every query of a group reaches with at least k other rows, and a
group of data whose upper bound is less than theta is not needed. In the groups
that are, a row is replicated to a group of queries only if p.x + r |x| >= theta.

A group's queries and its rows are cut into chunks, and every pair of chunks is solved
by itself, so neither a group of equal queries nor one of equal rows is one task.
Chunks' best k are merged per query.

Defined results: null vectors, vectors with null or non-finite components
and null ids take no part; shorter vectors count as filled with zeros;
rows with the query's id are the query's own; equal query rows (id and vector)
are one query; repeated data rows count each. Scores beyond 64 bits are
held at the limits. Extra columns are ignored; no rows give no result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airlake.llm.common import materialize

TOP = 20
QUERY_EVERY = 20
SCALE = 64.0
#: The fewest and the most pivots (they are broadcast), and the sample that their number is chosen on.
MIN_PIVOTS, MAX_PIVOTS, SAMPLE_ROWS = 4, 1024, 2048
#: Estimated cost of sending a row to a group, in inner products.
ROW_COST = 500
#: Rows of a chunk of queries and of a chunk of data.
QUERY_CHUNK, DATA_CHUNK = 4096, 8192
#: Relative slack of bounds for rounding in floating point.
SLACK = 1e-9
LIMITS = (-(1 << 63), (1 << 63) - 1)


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v): integer vectors of the rows that take part."""
    return (
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("_v"))
        .where(F.col("vec_id").isNotNull() & F.col("_v").isNotNull())
        .where(_finite("_v"))
        .select("vec_id", F.transform("_v", lambda x: F.floor(x.cast("double") * SCALE)).alias("v"))
    )


def _finite(name: str) -> Column:
    return F.forall(
        name,
        lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))), F.lit(False)),
    )


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as int64, filled with zeros to ``dim``."""
    values, offsets = column.values.to_numpy(), column.offsets.to_numpy()
    lengths = np.diff(offsets)
    if (lengths == dim).all():
        return values[offsets[0] : offsets[-1]].reshape(-1, dim)
    out = np.zeros((len(lengths), dim), dtype=np.int64)
    for i, (a, n) in enumerate(zip(offsets[:-1], lengths, strict=True)):
        out[i, :n] = values[a : a + n]
    return out


def nearest(rows: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest pivot of every row, and an upper bound of the distance to it."""
    x = rows.astype(np.float64)
    squares = (x * x).sum(axis=1)[:, None] - 2 * x @ pivots.T + (pivots * pivots).sum(axis=1)
    group = squares.argmin(axis=1)
    return group, np.linalg.norm(x - pivots[group], axis=1) * (1 + SLACK)


def group_bounds(rows: np.ndarray, pivots: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) bounds of row x's score with any query of each group: rows x groups."""
    x = rows.astype(np.float64)
    norm = np.linalg.norm(x, axis=1)[:, None]
    middle, spread = x @ pivots.T, norm * radius[None, :]
    slack = SLACK * (norm * np.linalg.norm(pivots, axis=1)[None, :] + spread + 1)
    return middle - spread - slack, middle + spread + slack


def summary_bounds(
    distance: np.ndarray, own: np.ndarray, pivots: np.ndarray, radius: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) bounds of the score of any vector within ``distance`` of
    pivot ``own`` with any query of each group: one row per distance."""
    norms = np.linalg.norm(pivots, axis=1)
    middle, far = pivots[own] @ pivots.T, distance[:, None]
    spread = norms[None, :] * far + radius[None, :] * (norms[own][:, None] + far)
    slack = SLACK * (norms[own][:, None] * norms[None, :] + spread + 1)
    return middle - spread - slack, middle + spread + slack


def inner_products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact int64 inner products; by floating point where that is exact."""
    if not queries.size or not rows.size:
        return np.zeros((len(queries), len(rows)), dtype=np.int64)
    largest = max(abs(int(queries.min())), abs(int(queries.max()))) * max(abs(int(rows.min())), abs(int(rows.max())))
    if largest * rows.shape[1] < 1 << 53:
        return (queries.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    exact = queries.astype(object) @ rows.astype(object).T
    return np.clip(exact, *LIMITS).astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> np.ndarray:
    """Places of the k best rows of one query: highest score, then smallest id."""
    at = np.flatnonzero(ids != own)
    if len(at) > k:
        least = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= least]
    return at[np.lexsort((ids[at], ~scores[at]))][:k]


class LocalBest:
    """The k best rows so far of each query of a cell."""

    def __init__(self, k: int):
        self.k, self.queries, self.ids, self.keys = k, [], [], []
        self.found: list[tuple[np.ndarray, np.ndarray]] | None = None

    def ask(self, vectors: np.ndarray, ids: np.ndarray, keys: np.ndarray) -> None:
        self.queries.append(vectors)
        self.ids.append(ids)
        self.keys.append(keys)

    def tell(self, vectors: np.ndarray, ids: np.ndarray) -> None:
        if not self.queries:
            return
        if self.found is None:
            self.asked, self.own = np.concatenate(self.queries), np.concatenate(self.ids)
            none = np.empty(0, dtype=np.int64)
            self.found = [(none, none)] * len(self.own)
            self.least = np.full(len(self.own), LIMITS[0])
        for at in range(0, len(vectors), 1024):
            some = ids[at : at + 1024]
            scores = inner_products(self.asked, vectors[at : at + 1024])
            # only queries that the block can improve (or tie with) are looked at
            for q in np.flatnonzero(scores.max(axis=1) >= self.least):
                s, i = (np.concatenate(x) for x in zip(self.found[q], (scores[q], some), strict=True))
                top = best(s, i, self.own[q], self.k)
                self.found[q] = s[top], i[top]
                if len(top) == self.k:
                    self.least[q] = s[top[-1]]

    def result(self):
        if self.found is None:
            return
        n = [len(s) for s, _ in self.found]
        keys = np.concatenate(self.keys)
        scores, ids = (np.concatenate(x) for x in zip(*self.found, strict=True))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(self.own, n)), pa.array(np.repeat(keys, n)), pa.array(ids), pa.array(scores)],
            names=["query_id", "query", "vec_id", "score"],
        )


def pivot_count(queries: np.ndarray, rows: np.ndarray, asked: int, stored: int, k: int) -> int:
    """Number of pivots of least estimated cost, from samples of both sides.

    More pivots make smaller groups with tighter bounds, but each group costs a
    copy of every row that its bounds cannot exclude. The cost of a copy is
    ``ROW_COST`` inner products."""
    costs, many = {}, MIN_PIVOTS
    while many <= min(MAX_PIVOTS, asked, len(queries)):
        pivots = queries[:many].astype(np.float64)
        group, distance = nearest(queries, pivots)
        radius = np.array([distance[group == g].max(initial=0) for g in range(many)])
        own, away = nearest(rows, pivots)
        lower, _ = summary_bounds(away, own, pivots, radius)
        _, upper = group_bounds(rows, pivots, radius)
        rank = min(len(rows), max(1, round((k + 1) * len(rows) / stored)))
        theta = np.sort(lower, axis=0)[-rank]
        passed = (upper >= theta).mean(axis=0)
        members = np.bincount(group, minlength=many) / len(queries) * asked
        costs[many] = float((passed * (np.ceil(members / QUERY_CHUNK) * ROW_COST + members)).sum())
        many *= 4
    return min(costs, key=costs.get, default=min(MIN_PIVOTS, len(queries)))


def _assigned(rows: DataFrame, pivots: np.ndarray, dim: int, name: str) -> DataFrame:
    """``rows`` with their group, that of the nearest pivot, and the distance to it; written."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                group, distance = nearest(matrix(part.column("v"), dim), shared.value)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(group.astype(np.int32)), pa.array(distance)],
                    names=[*part.schema.names, "grp", "distance"],
                )

    fields = ", ".join(f"{c} {t}" for c, t in rows.dtypes)
    return materialize(rows.mapInArrow(run, f"{fields}, grp int, distance double"), name)


def _route(data: DataFrame, pivots, radius, theta, needed, dim: int) -> DataFrame:
    """(vec_id, v, grp) for each group of queries that may need the row;
    ``needed`` says which groups of data (rows) which groups of queries look into."""
    shared = data.sparkSession.sparkContext.broadcast((pivots, radius, theta, needed))

    def run(batches):
        pivots, radius, theta, needed = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024).select(["vec_id", "v"])
                own = needed[batch.column("grp").slice(at, 1024).to_numpy()]
                asking = np.flatnonzero(own.any(axis=0))
                _, upper = group_bounds(matrix(part.column("v"), dim), pivots[asking], radius[asking])
                row, group = np.nonzero((upper >= theta[None, asking]) & own[:, asking])
                sent = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [*sent.columns, pa.array(asking[group].astype(np.int32))], names=["vec_id", "v", "grp"]
                )

    return data.mapInArrow(run, "vec_id bigint, v array<bigint>, grp int")


class Highest:
    """The highest lower bounds of one group, at most one of each id: a query
    leaves out all rows with its id, so bounds of k + 1 ids leave k others."""

    def __init__(self, keep: int):
        self.keep, self.bounds, self.ids = keep, np.empty(0), np.empty(0, dtype=np.int64)

    def add(self, bounds: np.ndarray, ids: np.ndarray) -> None:
        if len(self.bounds) == self.keep:
            above = bounds > self.bounds[-1]
            bounds, ids = bounds[above], ids[above]
        if len(bounds):
            bounds, ids = np.concatenate((self.bounds, bounds)), np.concatenate((self.ids, ids))
            order = np.argsort(-bounds, kind="stable")
            _, first = np.unique(ids[order], return_index=True)
            order = order[np.sort(first)][: self.keep]
            self.bounds, self.ids = bounds[order], ids[order]

    def packed(self) -> bytes:
        return self.bounds.tobytes() + self.ids.tobytes()

    def add_packed(self, data: bytes) -> None:
        half = len(data) // 2
        self.add(np.frombuffer(data[:half]), np.frombuffer(data[half:], dtype=np.int64))


def _summaries(data: DataFrame, groups: int, k: int) -> tuple[np.ndarray, list[Highest]]:
    """Per group of data: the radius (-1 if it is empty), and the distances (as
    negative numbers) and ids of the ``k + 1`` rows nearest the pivot."""
    schema = "grp int, radius double, top binary"

    def rows(tops, radius):
        return pa.record_batch(
            {
                "grp": pa.array(list(tops), pa.int32()), "radius": pa.array([radius[g] for g in tops], pa.float64()),
                "top": pa.array([t.packed() for t in tops.values()], pa.binary()),
            }
        )

    def summarise(batches):
        tops, radius = {}, {}
        for batch in batches:
            group, distance, ids = (batch.column(c).to_numpy() for c in ("grp", "distance", "vec_id"))
            for g in np.unique(group).tolist():
                own = group == g
                tops.setdefault(g, Highest(k + 1)).add(-distance[own], ids[own])
                radius[g] = max(radius.get(g, 0.0), float(distance[own].max()))
        yield rows(tops, radius)

    def merge(batches):
        tops, radius = {}, {}
        for batch in batches:
            for g, r, top in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tops.setdefault(g, Highest(k + 1)).add_packed(top)
                radius[g] = max(radius.get(g, 0.0), r)
        yield rows(tops, radius)

    parts = data.select("vec_id", "grp", "distance").mapInArrow(summarise, schema)
    radius, tops = np.full(groups, -1.0), [Highest(k + 1) for _ in range(groups)]
    for g, r, top in parts.repartition("grp").mapInArrow(merge, schema).collect():  # a row per group
        radius[g] = r
        tops[g].add_packed(top)
    return radius, tops


def group_plan(
    pivots: np.ndarray, radius: np.ndarray, data_radius: np.ndarray, tops: list[Highest], k: int
) -> tuple[np.ndarray, np.ndarray]:
    """(theta of each group of queries, which groups of data x groups of queries
    are needed), from the summaries."""
    own = np.repeat(np.arange(len(tops)), [len(t.bounds) for t in tops])
    near = np.concatenate([t.bounds for t in tops])
    ids = np.concatenate([t.ids for t in tops])
    lower, _ = summary_bounds(-near, own, pivots, radius)
    theta = np.full(len(pivots), -np.inf)
    for g in range(len(pivots)):
        best_bounds = Highest(k + 1)
        best_bounds.add(lower[:, g], ids)
        if len(best_bounds.bounds) > k:
            theta[g] = best_bounds.bounds[k]
    _, upper = summary_bounds(np.maximum(data_radius, 0), np.arange(len(pivots)), pivots, radius)
    return theta, (upper >= theta[None, :]) & (data_radius >= 0)[:, None]


def _sample(rows: DataFrame, dim: int) -> np.ndarray:
    """SAMPLE_ROWS vectors at most, those with the lowest hashes."""
    drawn = rows.orderBy(F.xxhash64(F.lit(7), "vec_id", "v"), "vec_id").limit(SAMPLE_ROWS).select("v").collect()
    out = np.zeros((len(drawn), dim), dtype=np.int64)
    for i, r in enumerate(drawn):
        out[i, : len(r["v"])] = r["v"]
    return out


def top_k(queries: DataFrame, rows: DataFrame, k: int = TOP) -> DataFrame:
    """(query_id, rank, vec_id, score): of each query (vec_id, v) the ``k``
    rows (vec_id, v) of highest score. Both inputs are read several times, so
    pass materialised tables."""
    queries = materialize(queries.distinct().withColumn("query", F.xxhash64("vec_id", "v")), "knn-queries")
    asked = queries.count()
    dim = rows.agg(F.max(F.size("v"))).first()[0] or 0
    dim = max(dim, queries.agg(F.max(F.size("v"))).first()[0] or 0, 1)
    drawn, sampled = _sample(queries, dim), _sample(rows, dim)
    many = pivot_count(drawn, sampled, asked, rows.count(), k) if len(drawn) and len(sampled) else 1
    pivots = drawn[:many].astype(np.float64) if len(drawn) else np.zeros((1, dim))
    grouped = _assigned(queries, pivots, dim, "knn-groups")
    data = _assigned(rows.select("vec_id", "v"), pivots, dim, "knn-data")
    radius, members = np.zeros(len(pivots)), np.zeros(len(pivots), dtype=np.int64)
    for g, r, n in grouped.groupBy("grp").agg(F.max("distance"), F.count("*")).collect():
        radius[g], members[g] = r, n
    theta, needed = group_plan(pivots, radius, *_summaries(data, len(pivots), k), k)
    theta[members == 0] = np.inf  # an empty group needs nothing

    routed = _route(data, pivots, radius, theta, needed, dim)
    sent = np.zeros(len(pivots), dtype=np.int64)
    for g, n in routed.groupBy("grp").count().collect():
        sent[g] = n
    chunks = rows.sparkSession.createDataFrame(
        [
            (g, int(max(1, -(-members[g] // QUERY_CHUNK))), int(max(1, -(-sent[g] // DATA_CHUNK))))
            for g in range(len(pivots))
        ],
        "grp int, q_chunks int, d_chunks int",
    )
    chunks = F.broadcast(chunks)  # at most MAX_PIVOTS rows

    def spread(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    asking = grouped.join(chunks, "grp").select(
        "grp", F.pmod("query", "q_chunks").cast("int").alias("a"), spread("d_chunks").alias("b"),
        F.lit(0).alias("side"), "vec_id", "query", "v",
    )
    told = routed.join(chunks, "grp").select(
        "grp", spread("q_chunks").alias("a"), F.pmod(F.xxhash64("vec_id", "v"), "d_chunks").cast("int").alias("b"),
        F.lit(1).alias("side"), "vec_id", F.lit(0).cast("long").alias("query"), "v",
    )
    cells = asking.unionByName(told).repartition("grp", "a", "b").sortWithinPartitions("grp", "a", "b", "side")

    def solve(batches):
        cell, held = None, None
        for batch in batches:
            grp, a, b, side = (batch.column(n).to_numpy() for n in ("grp", "a", "b", "side"))
            new = np.zeros(batch.num_rows, dtype=bool)
            for c in (grp, a, b, side):
                new[1:] |= c[1:] != c[:-1]
            bounds = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
            for lo, hi in zip(bounds, bounds[1:], strict=False):
                if lo == hi:
                    continue
                part, here = batch.slice(lo, hi - lo), (grp[lo], a[lo], b[lo])
                if cell != here:
                    if held is not None:
                        yield from held.result()
                    cell, held = here, LocalBest(k)
                vectors, ids = matrix(part.column("v"), dim), part.column("vec_id").to_numpy()
                if side[lo] == 0:
                    held.ask(vectors, ids, part.column("query").to_numpy())
                else:
                    held.tell(vectors, ids)
        if held is not None:
            yield from held.result()

    local = cells.mapInArrow(solve, "query_id bigint, query bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return (
        local.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def nearest_embeddings(embeddings: DataFrame) -> DataFrame:
    """Top 20 of every row whose vec_id is divisible by 20, among all rows."""
    rows = materialize(quantised(embeddings), "knn-rows")
    return top_k(rows.where(F.col("vec_id") % QUERY_EVERY == 0), rows)


NEAREST_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::HUGEINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
"""
