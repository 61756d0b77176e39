"""Line de-duplication with two Bloom filters.

Each task hashes its documents' line keys into a *once* and a *twice* filter: a
key that the once filter has already seen goes to the twice filter. Tasks'
filters are merged segment by segment: once = union, twice = union of the
twices and of the overlap of the onces. Keys that the merged twice filter does
not hold occur in one document only and are never shuffled. The others are
suspected repeats; they alone are shuffled, as text, to be confirmed exactly
and to find the smallest document holding each.

The filters have ``BITS_PER_LINE`` bits a line, at most ``MAX_BITS``: the one
that is broadcast has at most MAX_BITS / 8 bytes (32 MB). Beyond that many lines the
filter lets more single lines through to the exact step; results stay the same.

Defined results: null or empty text is one empty line; rows with the same
doc_id are one document (a key that only they hold is not repeated), but each
gathers the dropped keys of its own text only; rows with
a null doc_id take no part and keep their lines; a document that loses all its
lines stays, with empty text. Extra columns pass through whatever their names, except
n_lines and n_dropped, which are replaced.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlake.llm.common import add_columns, materialize, slices, texts_of

STRIPPED = b" \t\n\x0b\x0c\r"
MIN_CHARS = 10
BITS_PER_LINE = 16
MIN_BITS, MAX_BITS = 1 << 20, 1 << 28
HASHES = 4
#: Bits of a segment, the unit in which filters are merged.
SEGMENT_BITS = 1 << 16


def line_key(line: bytes) -> bytes:
    return line.strip(STRIPPED).lower()


def counted_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """The line's key, None if it is too short to be dropped."""
    key = line_key(line)
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode()) < min_chars:
        return None
    return key


def bit_positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """One row of ``HASHES`` positions for each 64-bit hash; bits is a power of two."""
    low, high = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    steps = np.arange(HASHES, dtype=np.uint64)
    return ((low[:, None] + steps * high[:, None]) & np.uint64(bits - 1)).astype(np.int64)


class TwoFilters:
    """Once-seen and twice-seen filters of one task, one byte per bit pair
    (bit 0: once, bit 1: twice)."""

    def __init__(self, bits: int):
        self.bits = bits
        self.cells = np.zeros(bits, dtype=np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        """Hashes of several documents, each document's own repeats left out."""
        values, counts = np.unique(hashes, return_counts=True)
        at = bit_positions(values, self.bits)
        again = (counts > 1) | (self.cells[at] & 1).all(axis=1)
        self.cells[at] |= 1
        self.cells[at[again]] |= 2

    def segments(self):
        """(segment, once bits, twice bits) of the segments in use; a bit list
        is 16-bit positions if that is shorter than the bits themselves."""
        for s, cells in enumerate(self.cells.reshape(-1, SEGMENT_BITS)):
            if cells.any():
                yield s, _packed(cells & 1), _packed(cells & 2)


def _packed(cells: np.ndarray) -> bytes:
    at = np.flatnonzero(cells)
    return at.astype(np.uint16).tobytes() if 2 * len(at) < SEGMENT_BITS // 8 else np.packbits(cells > 0).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    if len(data) == SEGMENT_BITS // 8:
        return np.unpackbits(np.frombuffer(data, dtype=np.uint8)).astype(bool)
    cells = np.zeros(SEGMENT_BITS, dtype=bool)
    cells[np.frombuffer(data, dtype=np.uint16)] = True
    return cells


def _document_keys(text: str) -> set[bytes]:
    keys = {counted_key(line) for line in text.encode().split(b"\n")}
    keys.discard(None)
    return keys


def twice_filter(docs: DataFrame, bits: int) -> bytes:
    """The merged twice-seen filter over all lines of ``docs`` (doc_id, text)."""

    def build(batches):
        filters = TwoFilters(bits)
        for part in slices(batches):
            hashes = [xxhash.xxh3_64_intdigest(k) for t in texts_of(part, "text") for k in _document_keys(t)]
            filters.add(np.array(hashes, dtype=np.uint64))
        rows = list(filters.segments())
        for at in range(0, len(rows), 64):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(zip(*rows[at : at + 64], strict=True), (pa.int32(), pa.binary(), pa.binary()), strict=True)],
                names=["segment", "once", "twice"],
            )

    def merge(batches):
        # rows arrive one by one: two bit sets per segment of this partition
        once: dict[int, np.ndarray] = {}
        twice: dict[int, np.ndarray] = defaultdict(lambda: np.zeros(SEGMENT_BITS, dtype=bool))
        for batch in batches:
            for s, o, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                o = _unpacked(o)
                twice[s] |= _unpacked(t)
                if s in once:
                    twice[s] |= once[s] & o
                    once[s] |= o
                else:
                    once[s] = o
        for s, cells in twice.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([s], pa.int32()), pa.array([_packed(cells)], pa.binary())], names=["segment", "twice"]
            )

    parts = docs.select("text").mapInArrow(build, "segment int, once binary, twice binary")
    merged = parts.repartition("segment").mapInArrow(merge, "segment int, twice binary")
    out = np.zeros((bits // SEGMENT_BITS, SEGMENT_BITS // 8), dtype=np.uint8)
    for s, data in merged.toLocalIterator():  # at most MAX_BITS / 8 bytes in all
        out[s] = np.packbits(_unpacked(data))
    return out.tobytes()


def suspected_repeats(docs: DataFrame, twice: bytes, bits: int) -> DataFrame:
    """(doc_id, row, key) of every distinct key of a row that the filter holds;
    ``docs`` has doc_id, row and text."""
    shared = docs.sparkSession.sparkContext.broadcast(twice)

    def run(batches):
        held = np.frombuffer(shared.value, dtype=np.uint8)
        for part in slices(batches):
            at_row, keys = [], []
            for i, t in enumerate(texts_of(part, "text")):
                own = _document_keys(t)
                at_row += [i] * len(own)
                keys += own
            at = bit_positions(np.array([xxhash.xxh3_64_intdigest(k) for k in keys], dtype=np.uint64), bits)
            hit = np.flatnonzero((held[at >> 3] >> (7 - (at & 7)) & 1).all(axis=1))
            own_rows = pa.array([at_row[h] for h in hit], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(own_rows), part.column("row").take(own_rows), pa.array([keys[h].decode() for h in hit], pa.string())],
                names=["doc_id", "row", "key"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "row", "text").mapInArrow(run, f"doc_id {kind}, row string, key string")


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """128 bits of a hash of id and text: rows share it only if they lose the same lines."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (doc_id, text)]
    return F.md5(F.concat(parts[0], F.lit(" "), parts[1]))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated lines dropped from ``text``, and n_lines (before)
    and n_dropped."""
    known = docs.where("doc_id is not null").select("doc_id", row_key().alias("row"), "text")
    lines = known.agg(F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1)).first()[0] or 0
    bits = min(MAX_BITS, max(MIN_BITS, 1 << (BITS_PER_LINE * lines).bit_length()))
    suspects = materialize(suspected_repeats(known, twice_filter(known, bits), bits), "line-suspects")
    repeated = (
        suspects.groupBy("key")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where("first < last")
        .select("key", "first")
    )
    # written first, so that the join's inputs are plain shuffles, which Spark
    # can split where one key has very many rows
    repeated = materialize(repeated, "lines-repeated")
    # by row, not by id: a set is never larger than the lines of one text
    drops = (
        suspects.join(repeated, "key")
        .where("doc_id > first")
        .groupBy("row")
        .agg(F.collect_set("key").alias("_drop"))
    )
    base = docs.drop("n_lines", "n_dropped")
    others = F.struct(F.lit(0), *[F.col(f"`{c}`") for c in base.columns if c != "text"])  # apart from the working names
    keyed = base.select(others.alias("others"), "text", F.when(F.col("doc_id").isNotNull(), row_key()).alias("row"))
    joined = keyed.join(drops, "row", "left").drop("row")

    def make():
        def compute(part):
            texts, total, dropped = [], [], []
            for text, drop in zip(texts_of(part, "text"), part.column("_drop").to_pylist(), strict=True):
                rows = text.encode().split(b"\n")
                kept = rows
                if drop:
                    gone = {k.encode() for k in drop}
                    kept = [r for r in rows if line_key(r) not in gone]
                texts.append(b"\n".join(kept).decode())
                total.append(len(rows))
                dropped.append(len(rows) - len(kept))
            return [pa.array(texts, pa.string()), pa.array(total, pa.int64()), pa.array(dropped, pa.int64())]

        return compute

    done = add_columns(joined, "kept string, n_lines bigint, n_dropped bigint", make)
    columns = [F.col("kept" if c == "text" else f"others.`{c}`").alias(c) for c in base.columns]
    return done.select(*columns, "n_lines", "n_dropped")


def line_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of :func:`dedup_lines`."""
    return dedup_lines(docs.select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


LINE_DIGEST_SQL = """
WITH cut AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), lines AS (
  SELECT doc_id, i, ls[i] AS line,
         translate(trim(ls[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM cut)
), repeated AS (
  SELECT key, min(doc_id) AS first FROM lines WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT l.doc_id, l.i, l.line, coalesce(l.doc_id > r.first, false) AS gone
  FROM lines l LEFT JOIN repeated r ON l.key = r.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
