"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, everything that is not a letter becomes one space, and
1- to 3-grams of code points are hashed into buckets. Counts by language are
added up over all training rows: a task adds its rows into one count vector per
language (at most ``TASK_LANGUAGES`` at a time), and the vectors are summed in segments, so
no task holds a language's whole counts. The matrix of log probabilities has ``BUCKETS x
languages`` values; it is broadcast in blocks of languages, each within
``MAX_MATRIX_BYTES``. The names of the languages come to the driver.

A batch of texts is a sparse matrix of (document, bucket, count); its product
with the matrix of log probabilities is summed by document, ``PRODUCT_BYTES``
at a time. Texts are read ``CHUNK_CHARS`` at a time, so memory does not grow with
a text's length.

Defined results: null text or text without letters is ``und`` with score 0, and
so is every text if no row can be learned from. Rows with null lang, null
doc_id or no letter are not learned from; a null doc_id is not held out. Rows
are mapped one to one; ties go to the language first in code-point order.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlake.llm.common import add_columns, materialize, slices, texts_of

BUCKETS = 1 << 16
MAX_MATRIX_BYTES = 64 << 20
TASK_LANGUAGES = 64
PRODUCT_BYTES = 8 << 20
NGRAMS = (1, 2, 3)
SMOOTHING = 0.5
UNDETERMINED = "und"
SEGMENT = 1024
#: Code points of text turned into n-grams at once.
CHUNK_CHARS = 1 << 20
SEEDS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


class Hasher:
    """n-gram buckets of a list of texts."""

    def __init__(self, buckets: int):
        self.shift = np.uint32(32 - (buckets.bit_length() - 1))
        self.letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)

    def stream(self, text: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(context, codes): lower-case letters with single spaces between and
        around words, a chunk of the text at a time, after the last codes before it.
        Nothing if there is no letter."""
        tail = lead = np.zeros(0, dtype=np.uint32)
        for at in range(0, len(text), CHUNK_CHARS):
            part = text[at : at + CHUNK_CHARS].lower()
            part = (" " if at == 0 else "") + part + (" " if at + CHUNK_CHARS >= len(text) else "")
            raw = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
            raw = np.concatenate((lead, np.where(self.letters[raw], raw, np.uint32(32))))
            space = raw == 32
            raw = raw[~(space & np.concatenate((tail[-1:] == 32 if len(tail) else [False], space[:-1])))]
            if not len(tail) and len(raw) == 1 and raw[0] == 32:
                lead = raw  # no letter so far: still to be counted
            elif len(raw):
                yield tail, raw
                tail, lead = np.concatenate((tail, raw))[1 - NGRAMS[-1] :], raw[:0]

    def codes(self, text: str) -> np.ndarray:
        """All codes of a text in one array."""
        return np.concatenate([np.zeros(0, dtype=np.uint32), *[raw for _, raw in self.stream(text)]])

    def buckets(self, tail: np.ndarray, raw: np.ndarray) -> Iterator[np.ndarray]:
        """Buckets of the n-grams that end in ``raw``, by n."""
        codes, mixed = np.concatenate((tail, raw)), np.zeros(len(tail) + len(raw), dtype=np.uint32)
        for n, seed in zip(NGRAMS, SEEDS, strict=True):
            size = len(codes) - n + 1
            if size <= 0:
                break
            mixed = (mixed[:size] ^ codes[n - 1 :]) * seed
            mixed ^= mixed >> np.uint32(15)
            yield (mixed[max(len(tail) - n + 1, 0) :] * np.uint32(0x27D4EB2F)) >> self.shift

    def all_buckets(self, codes: np.ndarray) -> Iterator[np.ndarray]:
        """Buckets of all codes, in bounded arrays."""
        for at in range(0, len(codes), CHUNK_CHARS):
            yield from self.buckets(codes[max(at - NGRAMS[-1] + 1, 0) : at], codes[at : at + CHUNK_CHARS])

    def counts(self, text: str, buckets: int) -> np.ndarray | None:
        """How often each bucket occurs in a text; None if it has no letter."""
        total = None
        for tail, raw in self.stream(text):
            for b in self.buckets(tail, raw):
                own = np.bincount(b, minlength=buckets)
                total = own if total is None else total + own
        return total


def held_out(id_col: str = "doc_id", parts: int = 4, part: int = 2) -> Column:
    """Whether crc32 of the id as text falls into the held-out part."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % parts == part, F.lit(False))


Model = tuple[list[str], np.ndarray, np.ndarray]


def train_blocks(rows: DataFrame) -> list[Model]:
    """(languages, log probabilities buckets x languages, log priors) from all
    ``rows`` (text, lang), in blocks of languages; none if nothing can be learned."""
    found = rows.where("lang is not null").select("lang").distinct().collect()
    languages = sorted(r[0] for r in found)
    place = {name: i for i, name in enumerate(languages)}

    def count(batches):
        hasher, counts, docs = Hasher(BUCKETS), {}, {}

        def sums():
            for lang, own in counts.items():
                yield _counts_batch([(place[lang], s, c.tobytes()) for s, c in enumerate(own.reshape(-1, SEGMENT))])
                yield _counts_batch([(place[lang], -1, np.array([docs[lang]]).tobytes())])
            counts.clear()
            docs.clear()

        for part in slices(batches):
            for text, lang in zip(texts_of(part, "text"), part.column("lang").to_pylist(), strict=True):
                for tail, raw in hasher.stream(text):
                    if not len(tail):
                        if lang not in counts and len(counts) >= TASK_LANGUAGES:
                            yield from sums()
                        docs[lang] = docs.get(lang, 0) + 1
                    own = counts.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                    for b in hasher.buckets(tail, raw):
                        own += np.bincount(b, minlength=BUCKETS)
        yield from sums()

    def add(batches):
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for lang, segment, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.frombuffer(data, dtype=np.int64)
                sums[lang, segment] = sums[lang, segment] + own if (lang, segment) in sums else own
        for (lang, segment), own in sums.items():
            yield _counts_batch([(lang, segment, own.tobytes())])

    schema = "lang int, segment int, counts binary"
    parts = rows.where("lang is not null").select("text", "lang").mapInArrow(count, schema)
    sums = materialize(parts.repartition("lang", "segment").mapInArrow(add, schema), "language-counts")
    docs = np.zeros(len(languages))
    for lang, _, data in sums.where("segment < 0").toLocalIterator():
        docs[lang] = np.frombuffer(data, dtype=np.int64)[0]
    learned, each = np.flatnonzero(docs), max(MAX_MATRIX_BYTES // (8 * BUCKETS), 1)
    blocks = []
    for at in range(0, len(learned), each):
        own = learned[at : at + each]
        table = np.zeros((len(own), BUCKETS))
        within = F.col("lang").isin([int(i) for i in own]) & (F.col("segment") >= 0)
        for lang, segment, data in sums.where(within).toLocalIterator():  # MAX_MATRIX_BYTES at most
            table[np.searchsorted(own, lang), segment * SEGMENT : (segment + 1) * SEGMENT] = np.frombuffer(data, dtype=np.int64)
        logs = np.log((table + SMOOTHING) / (table.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS))
        blocks.append(([languages[i] for i in own], np.ascontiguousarray(logs.T), np.log(docs[own] / docs.sum())))
    return blocks


def train(rows: DataFrame) -> Model:
    """All blocks in one, for a few languages."""
    blocks = train_blocks(rows)
    names = [name for block in blocks for name in block[0]]
    logs = np.concatenate([np.zeros((BUCKETS, 0)), *[b[1] for b in blocks]], axis=1)
    return names, logs, np.concatenate([np.zeros(0), *[b[2] for b in blocks]])


def _counts_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["lang", "segment", "counts"]
    )


def sparse_product(rows: list[tuple[np.ndarray, np.ndarray]], logs: np.ndarray) -> np.ndarray:
    """Documents x languages: the sparse matrix whose row for a document has
    ``counts`` at ``buckets``, times ``logs``."""
    out = np.zeros((len(rows), logs.shape[1]))
    bucket, count = (np.concatenate(c) for c in zip(*rows, strict=True))
    doc = np.repeat(np.arange(len(rows)), [len(b) for b, _ in rows])
    step = max(PRODUCT_BYTES // (8 * max(logs.shape[1], 1)), 1)
    for at in range(0, len(doc), step):
        own = doc[at : at + step]
        starts = np.flatnonzero(np.diff(own, prepend=-1))
        out[own[starts]] += np.add.reduceat(logs[bucket[at : at + step]] * count[at : at + step, None], starts)
    return out


def predict(docs: DataFrame, model: list[Model] | Model, text_col: str = "text") -> DataFrame:
    """``docs`` plus lang_pred and score, the prediction's posterior probability.
    With several blocks of languages, each adds its best language and its share
    of the posterior to what the blocks before have found."""
    blocks = model if isinstance(model, list) else [model] if model[0] else []
    base = docs.drop("lang_pred", "score")
    others = [c for c in base.columns if c != text_col]
    found = base.select(
        F.struct(F.lit(0), *[F.col(f"`{c}`") for c in others]).alias("row"), F.col(text_col).alias("text"),
        F.lit(None).cast("struct<name:string,top:double,sum:double>").alias("before"),
    )
    for block in blocks:
        found = add_columns(found, "name string, top double, sum double", _scorer(found, block))
        found = found.select("row", "text", F.struct("name", "top", "sum").alias("before"))
    return found.select(
        *[F.col("text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in base.columns],
        F.coalesce("before.name", F.lit(UNDETERMINED)).alias("lang_pred"),
        F.coalesce(1 / F.col("before.sum"), F.lit(0.0)).alias("score"),
    )


def _scorer(docs: DataFrame, block: Model):
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def make():
        languages, logs, priors = shared.value
        hasher = Hasher(len(logs))

        def compute(part):
            at, rows, held = [], [], 0
            texts = texts_of(part, "text")
            names, tops, sums = [None] * len(texts), [None] * len(texts), [None] * len(texts)

            def settle():
                if rows:
                    for i, own in zip(at, sparse_product(rows, logs) + priors, strict=True):
                        best = int(own.argmax())
                        names[i], tops[i] = languages[best], float(own[best])
                        sums[i] = float(np.exp(own - own[best]).sum())  # in units of the best
                at.clear()
                rows.clear()

            for i, text in enumerate(texts):
                counts = hasher.counts(text, len(logs))
                if counts is not None:
                    bucket = np.flatnonzero(counts)
                    at.append(i)
                    rows.append((bucket, counts[bucket]))
                    held += len(bucket)
                    if 16 * held >= PRODUCT_BYTES:
                        settle()
                        held = 0
            settle()
            for i, before in enumerate(part.column("before").to_pylist()):
                if before is None or before["name"] is None:
                    continue
                if names[i] is None or before["top"] >= tops[i]:  # blocks are in code-point order: ties stay with the first
                    more = 0.0 if names[i] is None else sums[i] * np.exp(tops[i] - before["top"])
                    names[i], tops[i], sums[i] = before["name"], before["top"], before["sum"] + more
                else:
                    sums[i] += before["sum"] * np.exp(before["top"] - tops[i])
            return [pa.array(names, pa.string()), pa.array(tops, pa.float64()), pa.array(sums, pa.float64())]

        return compute

    return make


def language_predictions(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score; learned from the rows not held out."""
    rows = docs.select("doc_id", "text", "lang").withColumn("held_out", held_out())
    model = train_blocks(rows.where("not held_out and doc_id is not null"))
    return predict(rows.select("doc_id", "held_out", "text"), model).drop("text")
