"""SimHash near-duplicates by bit-sliced comparison.

Equal fingerprints are merged first. Two fingerprints that differ in at most
``radius`` of 64 bits agree on all but ``radius`` of ``blocks`` blocks of bits,
so they meet in a cell for each choice of blocks; more blocks make smaller
cells and more of them, and a cost estimate over the number of fingerprints
picks how many. Inside a cell the fingerprints are stored vertically: bit plane
p holds bit p of 64 fingerprints per word. Carry-save adders count a whole word's
64 distances at once, and (query, word) blocks are abandoned as soon as all
their distances exceed the radius. A cell gives the edges of a spanning forest
of its links, not all pairs; components need no more. Cells over ``CELL_ROWS``
fingerprints are split into parts, and every two parts are compared by
themselves, so no link is lost.

Defined results: null text has no words; documents without words share the
fingerprint zero, linked like any other; rows with one fingerprint are one
group whatever their ids; a null doc_id takes part but is never a component's
id unless all its ids are null. Extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlake.llm.common import add_columns, materialize, texts_of
from airlake.llm.components import connected_components

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
CELL_ROWS = 1024
#: Estimated cost of a row in a cell against that of comparing two fingerprints.
ROW_COST = 1000
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def simhash(text: str, words: int = SHINGLE_WORDS) -> int:
    """64-bit fingerprint: majority of the shingles' hashes in every bit."""
    found = text.encode().lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), dtype=np.int64) + 1) - 1
    starts = (np.concatenate(([0], ends[:-1] + 1))).tolist()
    ends, last, digest = ends.tolist(), min(words, len(found)) - 1, xxhash.xxh64_intdigest
    ones, n = np.zeros(64, dtype=np.int64), len(found) - last
    for at in range(0, n, 1 << 16):
        spans = zip(starts[at : min(at + (1 << 16), n)], ends[at + last : at + last + (1 << 16)], strict=False)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def add_fingerprint(docs: DataFrame, words: int = SHINGLE_WORDS, column: str = "fp") -> DataFrame:
    """``docs`` plus the fingerprint of ``text`` as a signed long."""

    def make():
        def compute(part):
            values = np.array([simhash(t, words) for t in texts_of(part, "text")], dtype=np.uint64)
            return [pa.array(values.view(np.int64))]

        return compute

    return add_columns(docs, f"{column} bigint", make)


def block_count(rows: int, radius: int) -> int:
    """Blocks of bits with the lowest estimated cost for so many fingerprints."""

    def cost(blocks: int) -> float:
        key_bits = 64 * (blocks - radius) // blocks
        return comb(blocks, radius) * (rows * ROW_COST + rows * rows / 2 / 2**key_bits)

    return min(range(radius + 1, radius + 5), key=cost)


def _cell_keys(blocks: int, radius: int) -> Column:
    """(choice of blocks that must agree, their bits) for every choice."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), blocks - radius):
        mask = 0
        for b in chosen:
            mask |= ((1 << edges[b + 1]) - 1) & ~((1 << edges[b]) - 1)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return F.array(
        *[
            F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key"))
            for i, m in enumerate(masks)
        ]
    )


def _full_add(a, b, c):
    """Carry-save adder: (sum, carry) of three words bit by bit."""
    u = a ^ b
    return u ^ c, (a & b) | (u & c)


def close_blocks(queries: np.ndarray, planes: np.ndarray, radius: int):
    """(query, word, bits): the fingerprints of ``planes`` (64 x words) within
    ``radius`` (up to 6) bits of each query, as bits of words."""
    query = np.repeat(np.arange(len(queries)), planes.shape[1])
    word = np.tile(np.arange(planes.shape[1]), len(queries))
    ones = np.zeros(len(query), dtype=np.uint64)
    twos, fours, over = ones.copy(), ones.copy(), ones.copy()
    for p in range(0, 64, 4):
        # a query's bit flips the whole word of the plane
        d = [
            planes[p + k][word] ^ (np.uint64(0) - ((queries[query] >> np.uint64(p + k)) & np.uint64(1)))
            for k in range(4)
        ]
        ones, a = _full_add(ones, d[0], d[1])
        ones, b = _full_add(ones, d[2], d[3])
        twos, c = _full_add(twos, a, b)
        over |= fours & c
        fours ^= c
        far = over | _above(ones, twos, fours, radius)
        alive = far != ONES
        if not alive.all():
            query, word, far = query[alive], word[alive], far[alive]
            ones, twos, fours, over = ones[alive], twos[alive], fours[alive], over[alive]
            if not len(query):
                break
    return query, word, ~far if len(query) else ones


def _above(ones, twos, fours, radius: int):
    """Words' bits whose 3-bit count is over the radius."""
    out = np.zeros_like(ones)
    for n in range(radius + 1, 8):
        out |= (fours if n & 4 else ~fours) & (twos if n & 2 else ~twos) & (ones if n & 1 else ~ones)
    return out


def bit_planes(values: np.ndarray) -> np.ndarray:
    """64 x words: bit j of word w of plane p is bit p of value 64 w + j."""
    padded = np.zeros(-(-len(values) // 64) * 64, dtype=np.uint64)
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(bits.T.copy(), axis=1, bitorder="little").view(np.uint64)


def forest(left: np.ndarray, right: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links inside ``left``, or between
    ``left`` and ``right`` if that is given."""
    values = left if right is None else np.concatenate((left, right))
    base = 0 if right is None else len(left)
    others = left if right is None else right
    planes = bit_planes(others)
    label = np.arange(len(values))
    edges = []
    for at in range(0, len(left), 256):
        query, word, bits = close_blocks(left[at : at + 256], planes, radius)
        hits = np.unpackbits(bits.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, bit = np.nonzero(hits)
        q, j = query[row] + at, word[row] * 64 + bit
        real = j < len(others)
        q, j = q[real], j[real] + base
        fresh = label[q] != label[j]
        for a, b in zip(q[fresh].tolist(), j[fresh].tolist(), strict=True):
            if label[a] != label[b]:
                edges.append((values[a], values[b]))
                label[label == label[b]] = label[a]
    return edges


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v): links between distinct fingerprints ``fp`` that connect all that
    are within ``radius`` bits of each other."""
    cells = prints.select("fp", F.inline(_cell_keys(block_count(prints.count(), radius), radius)))
    # written first, so that the join's inputs are plain shuffles, which Spark
    # can split where one cell has very many rows
    sizes = materialize(
        cells.groupBy("choice", "key").agg(F.count("*").alias("n")).where("n > 1"), "simhash-cells"
    )
    parts = F.ceil(F.col("n") / CELL_ROWS)
    split = (
        cells.join(sizes, ["choice", "key"])
        .withColumn("parts", parts)
        .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        .select(
            "choice", "key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "fp"
        )
    )
    together = split.repartition("choice", "key", "i", "j").sortWithinPartitions("choice", "key", "i", "j", "part")

    def compare(batches):
        rest: list[np.ndarray] | None = None
        for batch in batches:
            cols = [c.to_numpy() for c in batch.columns]
            if rest is not None:
                cols = [np.concatenate(x) for x in zip(rest, cols, strict=True)]
            new = np.zeros(len(cols[0]), dtype=bool)
            for c in cols[:4]:
                new[1:] |= c[1:] != c[:-1]
            bounds = [0, *np.flatnonzero(new).tolist()]
            yield from _cell_edges(cols, bounds)
            rest = [c[bounds[-1] :] for c in cols]
        if rest is not None:
            yield from _cell_edges(rest, [0, len(rest[0])])

    def _cell_edges(cols, bounds):
        edges = []
        _, _, i, j, part, fp = cols
        for a, b in zip(bounds, bounds[1:], strict=False):
            if b - a < 2:
                continue
            values, cut = fp[a:b].view(np.uint64), None
            if i[a] != j[a]:
                cut = int(np.searchsorted(part[a:b], j[a]))
            edges += forest(values, None, radius) if cut is None else forest(values[:cut], values[cut:], radius)
        if edges:
            u, v = (np.array(x, dtype=np.uint64).view(np.int64) for x in zip(*edges, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return together.mapInArrow(compare, "u bigint, v bigint")


def components(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, root, component_id) for materialised ``prints`` (doc_id, fp): the
    smallest fingerprint of the component and the smallest doc_id in it."""
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-nodes")
    roots = connected_components(links(nodes.select("fp"), radius))
    member = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "rep", F.coalesce("root", "fp").alias("root")
    )
    ids = member.groupBy("root").agg(F.min("rep").alias("component_id"))
    return member.join(ids, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row."""
    prints = materialize(add_fingerprint(docs.select("doc_id", "text"), words).drop("text"), "simhash")
    return prints.join(components(prints, radius), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_per_group(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row
    with its smallest doc_id (one of them if several have it)."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")  # keeps all names apart from the working ones
    keyed = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), whole)
    marked = add_fingerprint(docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text"), words).drop("text")
    prints = materialize(marked, "simhash")
    heads = (
        prints.join(components(prints, radius), "fp")
        .where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root", "doc_id", "key")
        .agg(F.count("*").alias("rows"))
        .groupBy("root", F.col("doc_id").alias("doc"))
        .agg(F.min_by(F.struct("key", "rows"), "key").alias("first"))
        .select("doc", F.col("first.key").alias("head"), "first.rows")
    )
    heads = materialize(heads, "simhash-heads")

    def rows(of: DataFrame) -> DataFrame:
        same = keyed["doc_id"].eqNullSafe(of["doc"]) & (keyed["key"] == of["head"])
        return keyed.join(of, same).select(*keyed.columns)

    # equal rows (id and text) are rare; only they need to be told apart
    again = rows(heads.where("rows > 1")).dropDuplicates(["doc_id", "key"])
    return rows(heads.where("rows = 1")).union(again).select("row.*")
