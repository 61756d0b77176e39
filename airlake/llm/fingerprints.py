"""Document fingerprints: improbable byte windows in chained Bloom filters.

The entropy of every 64-byte window is kept up to date by the byte that leaves
and the one that enters; in integers, so that equal windows have equal entropy
wherever they are. A window is the rarer, the fewer windows of the whole corpus
have its entropy level. Among each 64 neighbouring windows the rarest (leftmost of
equals) gains a point; windows with at least ``MIN_POINTS`` points are the
document's features. Their hashes fill Bloom filters of 2048 bits, 160
features each, one filter after the other. Two fingerprints are compared by
the overlap of filter bits, normalised so that 0 is what chance gives and 1 is
all of the smaller filter: each filter of the shorter fingerprint counts with its
best partner.

Defined results: null text is empty; an empty text's fingerprint is the empty string, like
another empty one (1) and unlike all others (0). Texts under ``SHORT_BYTES``
have all their 8-byte windows as features (one of the whole text, if shorter), and so have
texts without a rare window. Documents follow each other by doc_id (null
first), rows with one id by the first ``HEAD`` code points of their text, then a hash
of it, equal rows in any order; after the last comes the first, which may be
the same row. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airlake.llm.common import add_columns, materialize, slices, texts_of

WINDOW = 64
LEVELS = 1000
#: Windows of lower levels (nearly one byte value) are never features.
MIN_LEVEL = 100
MIN_POINTS = 16
SHORT_BYTES, SHORT_WINDOW = 128, 8
FILTER_BITS, FILTER_FEATURES, FEATURE_BITS = 2048, 160, 5
#: Bytes handled at once; longer texts are cut with enough overlap.
CHUNK = 1 << 18
BEFORE, AFTER = 2 * WINDOW, 3 * WINDOW
UNIT = 1 << 10
#: Code points of a text by which rows with one id are ordered (range bounds reach the driver).
HEAD = 16
NEVER = np.int64(1) << np.int64(62)


def _steps() -> np.ndarray:
    """What the n-th equal byte adds to the sum of n log2 n, in units."""
    n = np.arange(WINDOW + 1, dtype=np.float64)
    total = np.zeros(WINDOW + 1)
    total[1:] = n[1:] * np.log2(n[1:])
    return np.diff(np.rint(total * UNIT).astype(np.int64), prepend=0).astype(np.int32)


STEPS = _steps()
FULL = int(STEPS.sum())  # of a window of one byte value


def entropy_levels(x: np.ndarray) -> np.ndarray:
    """Level (0 to 1000) of the window that starts at each byte; ``x`` begins
    with a window of equal bytes."""
    before = np.zeros(len(x), dtype=np.uint8)  # equal bytes among the 63 before
    behind = np.zeros(len(x), dtype=np.uint8)
    for lag in range(1, WINDOW):
        same = (x[lag:] == x[:-lag]).view(np.uint8)
        before[lag:] += same
        behind[:-lag] += same
    change = STEPS[before[WINDOW:] + 1] - STEPS[behind[:-WINDOW] + 1]
    total = np.empty(len(x) - WINDOW + 1, dtype=np.int64)
    total[0] = FULL
    np.cumsum(change, out=total[1:])
    total[1:] += FULL
    return (FULL - total) * LEVELS // FULL


def _pieces(data: bytes):
    """(bytes, first, last): pieces of a text whose windows that start in
    first..last are judged as they are in the whole text."""
    for at in range(0, max(1, len(data) - WINDOW + 1), CHUNK):
        a, b = max(0, at - BEFORE), min(len(data), at + CHUNK + AFTER)
        yield data[a:b], at - a, min(at + CHUNK, len(data) - WINDOW + 1) - a


def _batches(texts: list[bytes]):
    """Pieces of all texts, about CHUNK bytes at a time, as (text number, piece...)."""
    held, size = [], 0
    for i, data in enumerate(texts):
        for piece in _pieces(data):
            held.append((i, *piece))
            size += len(piece[0])
            if size >= CHUNK:
                yield held
                held, size = [], 0
    if held:
        yield held


def _laid_out(batch) -> tuple[np.ndarray, list[int]]:
    """One array with gaps that no window spans, and where the pieces begin."""
    gap = bytes(2 * WINDOW)
    starts, at = [], len(gap)
    for _, data, _, _ in batch:
        starts.append(at)
        at += len(data) + len(gap)
    return np.frombuffer(gap + gap.join([p[1] for p in batch]) + gap, dtype=np.uint8), starts


def level_counts(texts: list[bytes]) -> np.ndarray:
    counts = np.zeros(LEVELS + 1, dtype=np.int64)
    for batch in _batches([t for t in texts if len(t) >= SHORT_BYTES]):
        x, starts = _laid_out(batch)
        levels = entropy_levels(x)
        own = [levels[s + first : s + last] for s, (_, _, first, last) in zip(starts, batch, strict=True)]
        counts += np.bincount(np.concatenate(own), minlength=LEVELS + 1)
    return counts


def rarity(docs: DataFrame) -> np.ndarray:
    """Rank of each entropy level by how few windows of all texts have it."""

    def run(batches):
        counts = np.zeros(LEVELS + 1, dtype=np.int64)
        for part in slices(batches):
            counts += level_counts([t.encode() for t in texts_of(part, "text")])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(LEVELS + 1)), pa.array(counts)], names=["level", "n"])

    rows = docs.select("text").mapInArrow(run, "level bigint, n bigint").groupBy("level").agg(F.sum("n").alias("n"))
    counts = np.zeros(LEVELS + 1, dtype=np.int64)
    for level, n in rows.collect():  # LEVELS + 1 rows
        counts[level] = n
    ranks = np.empty(LEVELS + 1, dtype=np.int64)
    ranks[np.argsort(counts, kind="stable")] = np.arange(LEVELS + 1)
    return ranks


def _mixed(words: np.ndarray) -> np.ndarray:
    """64-bit hash of each row of 64-bit words."""
    h = np.full(len(words), 0x9E3779B97F4A7C15, dtype=np.uint64)
    for k in range(words.shape[1]):
        h = (h ^ words[:, k]) * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(32)
    return h


def _short_features(data: bytes) -> np.ndarray:
    if len(data) < SHORT_WINDOW:
        return np.array([xxhash.xxh64_intdigest(data)], dtype=np.uint64)
    rows = np.lib.stride_tricks.sliding_window_view(np.frombuffer(data, dtype=np.uint8), SHORT_WINDOW)
    return _mixed(np.ascontiguousarray(rows).view(np.uint64))


def features(texts: list[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    """Hashes of the features of each text, in text order."""
    found: list[list[np.ndarray]] = [[] for _ in texts]
    long = [t if len(t) >= SHORT_BYTES else b"" for t in texts]
    for batch in _batches(long):
        batch = [p for p in batch if p[1]]
        if not batch:
            continue
        x, starts = _laid_out(batch)
        levels = entropy_levels(x)
        # rank and place in one number: the least is the rarest, then leftmost
        order = (ranks[levels] << np.int64(32)) | np.arange(len(levels))
        order[levels < MIN_LEVEL] = NEVER
        keys = np.full(len(x) + WINDOW, NEVER)
        for start, (_, data, _, _) in zip(starts, batch, strict=True):
            n = len(data) - WINDOW + 1
            keys[start : start + n] = order[start : start + n]
        least, reach = keys, 1
        while reach < WINDOW:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        winners = least[least < NEVER] & np.int64(0xFFFFFFFF)
        picked = np.flatnonzero(np.bincount(winners, minlength=len(x)) >= MIN_POINTS)
        rows = x[picked[:, None] + np.arange(WINDOW)]
        hashes = _mixed(rows.view(np.uint64)) if len(picked) else np.empty(0, dtype=np.uint64)
        for start, (i, _, first, last) in zip(starts, batch, strict=True):
            a, b = np.searchsorted(picked, (start + first, start + last))
            found[i].append(hashes[a:b])
    out = []
    for data, parts in zip(texts, found, strict=True):
        own = np.concatenate(parts) if parts else np.empty(0, dtype=np.uint64)
        out.append(own if len(own) or not data else _short_features(data))
    return out


def filters(hashes: np.ndarray) -> np.ndarray:
    """Chained Bloom filters: one row of FILTER_BITS / 8 bytes each."""
    n = -(-len(hashes) // FILTER_FEATURES)
    bits = np.zeros((n, FILTER_BITS), dtype=bool)
    row = np.arange(len(hashes)) // FILTER_FEATURES
    for k in range(FEATURE_BITS):
        bits[row, (hashes >> np.uint64(11 * k)) & np.uint64(FILTER_BITS - 1)] = True
    return np.packbits(bits, axis=1)


def digests(texts: list[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    return [filters(h) for h in features(texts, ranks)]


def to_text(digest: np.ndarray) -> str:
    return base64.b64encode(digest.tobytes()).decode()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), dtype=np.uint8).reshape(-1, FILTER_BITS // 8)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Normalised bit overlap of two fingerprints, 0 to 1."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) > len(b):
        a, b = b, a
    a, b = np.ascontiguousarray(a).view(np.uint64), np.ascontiguousarray(b).view(np.uint64)
    size_a = np.bitwise_count(a).sum(axis=1, dtype=np.int64)
    size_b = np.bitwise_count(b).sum(axis=1, dtype=np.int64)
    best = np.zeros(len(a))
    for i, row in enumerate(a):
        shared = np.bitwise_count(b & row).sum(axis=1, dtype=np.int64)
        chance, most = size_a[i] * size_b / FILTER_BITS, np.minimum(size_a[i], size_b)
        best[i] = np.clip((shared - chance) / np.maximum(most - chance, 1e-9), 0, 1).max()
    return float(best @ size_a / size_a.sum())


def add_fingerprint(docs: DataFrame, ranks: np.ndarray, column: str = "fingerprint") -> DataFrame:
    """``docs`` plus the fingerprint of ``text``."""

    def make():
        def compute(part):
            found = digests([t.encode() for t in texts_of(part, "text")], ranks)
            return [pa.array([to_text(d) for d in found], pa.string())]

        return compute

    return add_columns(docs, f"{column} string", make)


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by the beginning of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)
#: kind 0: a result; 1: the first document of a range, 2: its last one, with its text.
ROW = RESULT + ", kind int, part int, text string"


def _results(rows: list[tuple[int, str, np.ndarray]], ranks: np.ndarray) -> list[tuple]:
    """Results of all rows (id, text, digest) but the last, which only follows."""
    changed = [edited(a[1], b[1]) for a, b in zip(rows, rows[1:], strict=False)]
    prints = digests([t.encode() for t in changed], ranks)
    out = []
    for (i, text, own), (_, _, after), new, own_new in zip(rows, rows[1:], changed, prints, strict=False):
        sha = hashlib.sha256(new.encode()).hexdigest()
        out.append((i, len(text), sha, to_text(own), to_text(own_new), likeness(own, own_new), likeness(own, after)))
    return out


KINDS = (pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2, pa.int32(), pa.int32(), pa.string())


def _batch(rows: list[tuple], width: int) -> pa.RecordBatch:
    names = [c.split()[0] for c in ROW.split(", ")][:width]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, KINDS[:width], strict=True)], names=names)


def by_id(docs: DataFrame) -> DataFrame:
    """(doc_id, text) range-sorted in the order in which documents follow each other."""
    order = ["doc_id", "_head", "_hash", "_place"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select(
        "*",
        F.substring("text", 1, HEAD).alias("_head"),
        F.xxhash64("text").alias("_hash"),
        F.monotonically_increasing_id().alias("_place"),
    )
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")


def edit_likeness(docs: DataFrame) -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and their
    likeness, and its likeness to the next document.

    Documents are range-sorted by id; rows with one id by head and hash of the text, and
    equal rows by where they are read, so ranges also cut within one id that holds a
    large share of the rows. Each task compares neighbours as they
    stream by. The last of a range meets the first of the next in a join of
    one row per range."""
    ranks = rarity(docs)
    sorted_docs = by_id(docs)

    def run(batches):
        part, last = TaskContext.get().partitionId(), None
        for batch in slices(batches):
            texts = texts_of(batch, "text")
            rows = list(zip(batch.column("doc_id").to_pylist(), texts, digests([t.encode() for t in texts], ranks), strict=True))
            if last is None and rows:
                yield _batch([_edge(rows[0], 1, part)], len(KINDS))
            rows = [last, *rows] if last is not None else rows
            if len(rows) > 1:
                yield _batch([(*r, 0, part, None) for r in _results(rows, ranks)], len(KINDS))
            last = rows[-1] if rows else last
        if last is not None:
            yield _batch([_edge(last, 2, part)], len(KINDS))

    def _edge(row, kind, part):
        return (row[0], len(row[1]), None, to_text(row[2]), None, None, None, kind, part, row[1])

    done = materialize(sorted_docs.mapInArrow(run, ROW), "fingerprints")
    edges = done.where("kind > 0")
    firsts = edges.where("kind = 1").select(F.col("part").alias("_to"), F.col("text").alias("_text"), F.col("fingerprint").alias("_print"))
    by_part = Window.orderBy("part")
    follows = edges.where("kind = 1").select(
        "part",
        F.coalesce(F.lead("part").over(by_part), F.min("part").over(Window.partitionBy())).alias("_to"),
    )
    meet = edges.where("kind = 2").join(follows, "part").join(firsts, "_to").select("doc_id", "text", "fingerprint", "_text", "_print")

    def across(batches):
        for batch in slices(batches):
            out = []
            for i, text, own, after, after_print in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out += _results([(i, text, from_text(own)), (None, after, from_text(after_print))], ranks)
            if out:
                yield _batch(out, 7)

    results = [c.split()[0] for c in RESULT.split(", ")]
    return done.where("kind = 0").select(*results).union(meet.mapInArrow(across, RESULT))
