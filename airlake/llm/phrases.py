"""Phrase collocations by counting quotient filters.

Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends and
into words. Every word has a 64-bit id, a seeded hash that is checked to keep
all words of the corpus apart (another seed is taken if it does not). An n-gram
of ids, packed into n 64-bit lanes, is permuted invertibly: the first lane
becomes a mix of all lanes. Its top bits name a segment of the key space, the
next ones are the quotient and all the rest is the remainder, so a counting
quotient filter of a segment holds its n-grams without loss: one bit per
quotient says whether a run is there, one bit per entry ends a run, entries hold
remainders, and counters take a byte more only where they are above one.

Each task makes filters of its n-grams, in bounded memory, and only filters are
shuffled. Filters are sorted by permuted key, so the shards of a segment are
merged two at a time as they arrive. Phrases grow word by word: an n-gram is
counted only where both of its (n-1)-grams may be frequent, told by a Bloom
filter of the frequent ones. It has ``BITS_PER_KEY`` bits a key and at most
``MAX_BITS`` (32 MB broadcast); beyond that room more n-grams pass and are counted,
and results stay the same.

Defined results: null text is empty and has no words; null lang is ``und``; a
lang without words is absent, one without candidates has no rows; rows are
counted as they come, so repeated rows, repeated ids and null ids count once
each; an empty table gives no rows. Texts are read in blocks, a piece of any
length across them. Other columns play no part.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airlake.llm.common import materialize, slices

MIN_COUNT = 30
MAX_WORDS = 4
TOP = 2000
#: A phrase goes if a longer one has this share of its occurrences, in percent.
COVERED = 80
SCALE = 2_000_000
UNKNOWN_LANG = "und"

#: Bytes of text in a block, and the longest word hashed with its block.
BLOCK, SHORT_WORD = 1 << 18, 64
#: Entries a task holds before it hands its filters on.
TASK_ENTRIES = 1 << 20
#: Word occurrences of the corpus per segment, about.
SEGMENT_WORDS = 1 << 21
BITS_PER_KEY, MIN_BITS, MAX_BITS = 16, 1 << 20, 1 << 28
#: Bits of a Bloom filter that are merged as one row.
BLOOM_SEGMENT = 1 << 16
PROBES = 4
#: Parts that the counts of a single word, and a lang's best phrases, are dealt over.
SALTS = 32
#: Rows of a written table of frequent n-grams per file, at most about.
FILE_ROWS = 1 << 20
#: Seeds tried until the ids of all words differ.
SEEDS = tuple(range(1, 9))

SPACE, CUT = 1, 2
KINDS = np.zeros(256, dtype=np.uint8)
KINDS[[0x20, 0x09]] = SPACE
KINDS[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = CUT
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
BREAK = re.compile(rb"[\x20\x09.,;:!?\x0A-\x0D]")
LANES = [f"w{i}" for i in range(MAX_WORDS)]
U64 = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit integers."""
    x = (x ^ (x >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


_BACK = [U64(pow(m, -1, 1 << 64)) for m in (0xC4CEB9FE1A85EC53, 0xFF51AFD7ED558CCD)]


def unmixed(x: np.ndarray) -> np.ndarray:
    for m in _BACK:
        x = (x ^ (x >> U64(33))) * m
    return x ^ (x >> U64(33))


def _others(lanes: list[np.ndarray]) -> np.ndarray:
    total = U64(0)
    for i, lane in enumerate(lanes[1:], 1):
        total = total + mixed(lane + U64(i * 0x9E3779B97F4A7C15 % (1 << 64)))
    return total


def permuted(lanes: list[np.ndarray]) -> list[np.ndarray]:
    """The packed n-grams, first lane mixed with all the others."""
    return [mixed(lanes[0] + _others(lanes)), *lanes[1:]]


def unpermuted(lanes: list[np.ndarray]) -> list[np.ndarray]:
    return [unmixed(lanes[0]) - _others(lanes), *lanes[1:]]


class Words:
    """Word ids of texts. ``blocks`` gives, block by block, ids, the number of
    the piece each word is in, and where its bytes are."""

    def __init__(self, seed: int):
        self.seed = seed
        factor = xxhash.xxh3_64_intdigest(b"word", seed) | 1
        back = pow(factor, -1, 1 << 64)
        self.powers = self._powers(factor)
        self.backs = self._powers(back)

    @staticmethod
    def _powers(factor: int) -> np.ndarray:
        steps = np.full(BLOCK, factor, dtype=np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)

    def blocks(self, data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, bytes, np.ndarray, np.ndarray]]:
        at, piece = 0, 0
        while at < len(data):
            stop = at + BLOCK
            if stop < len(data):
                raw = np.frombuffer(data, dtype=np.uint8, count=BLOCK, offset=at)
                breaks = np.flatnonzero(KINDS[raw])
                if len(breaks):
                    stop = at + int(breaks[-1]) + 1
                else:  # one word longer than a block
                    found = BREAK.search(data, stop)
                    stop = found.start() if found else len(data)
                    word = data[at:stop].lower()
                    yield self._long(word), np.array([piece]), word, np.array([0]), np.array([len(word)])
                    at = stop
                    continue
            raw = LOWER[np.frombuffer(data, dtype=np.uint8, count=min(stop, len(data)) - at, offset=at)]
            kinds = KINDS[raw]
            edges = np.diff(np.concatenate(([0], (kinds == 0).astype(np.int8), [0])))
            starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
            cuts = np.cumsum(kinds == CUT)
            if len(starts):
                yield self._ids(raw, starts, ends), piece + cuts[starts], raw.tobytes(), starts, ends
            piece += int(cuts[-1])
            at = stop

    def _long(self, word: bytes) -> np.ndarray:
        return np.array([xxhash.xxh3_64_intdigest(word, self.seed)], dtype=np.uint64)

    def _ids(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        # a word's polynomial: difference of running sums, moved back to power 0
        sums = np.concatenate(([U64(0)], np.cumsum((raw.astype(np.uint64) + U64(1)) * self.powers[: len(raw)])))
        ids = mixed((sums[ends] - sums[starts]) * self.backs[starts])
        for i in np.flatnonzero(ends - starts > SHORT_WORD):
            ids[i] = self._long(raw[starts[i] : ends[i]].tobytes())[0]
        return ids


def grams(ids: np.ndarray, pieces: np.ndarray, n: int) -> tuple[list[np.ndarray], np.ndarray]:
    """(lanes of the n words from each place on, whether they are in one piece)."""
    size = max(len(ids) - n + 1, 0)
    return [ids[i : i + size] for i in range(n)], pieces[:size] == pieces[n - 1 : n - 1 + size]


def texts_by_lang(batch: pa.RecordBatch) -> dict[str, bytes]:
    """The batch's texts by lang, joined by line ends, which end every piece."""
    joined = defaultdict(list)
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
        if text:
            joined[lang].append(text.encode())
    return {lang: b"\n".join(texts) for lang, texts in joined.items()}


# --- counting quotient filters -------------------------------------------------


class Counts:
    """Sorted distinct permuted keys (a list of lanes) with their counts."""

    def __init__(self, lanes: list[np.ndarray], counts: np.ndarray):
        self.lanes, self.counts = lanes, counts

    def __len__(self) -> int:
        return len(self.counts)

    @staticmethod
    def of(lanes: list[np.ndarray], counts: np.ndarray | None = None) -> Counts:
        """Keys in any order, repeated or not."""
        order = np.argsort(lanes[0], kind="stable")
        ordered = [x[order] for x in lanes]
        same_first = ordered[0][1:] == ordered[0][:-1]
        same = same_first.copy()
        for x in ordered[1:]:
            same &= x[1:] == x[:-1]
        if (same != same_first).any():  # different keys that agree in the mixed lane
            order = np.lexsort(lanes[::-1])
            ordered = [x[order] for x in lanes]
            same = np.logical_and.reduce([x[1:] == x[:-1] for x in ordered])
        heads = np.flatnonzero(np.concatenate(([True], ~same))) if len(order) else order
        if counts is None:
            summed = np.diff(np.concatenate((heads, [len(order)])))
        else:
            summed = np.add.reduceat(counts[order], heads) if len(order) else counts
        return Counts([x[heads] for x in ordered], summed.astype(np.int64))

    def merged(self, other: Counts) -> Counts:
        return Counts.of(
            [np.concatenate(both) for both in zip(self.lanes, other.lanes, strict=True)],
            np.concatenate((self.counts, other.counts)),
        )

    def part(self, at: slice) -> Counts:
        return Counts([x[at] for x in self.lanes], self.counts[at])


def to_filter(counts: Counts, skip: int) -> bytes:
    """The counting quotient filter of keys that agree in the first ``skip`` bits.

    Bytes: entries, quotient bits; occupied bits; run ends; remainders, lane by
    lane, the first lane without quotient and skipped bits (whole bytes);
    counters: a bit for those above 1, then those in base 128."""
    n = len(counts)
    bits = min(max(n.bit_length(), 3), 64 - skip)
    first = counts.lanes[0]
    quotient = ((first << U64(skip)) >> U64(64 - bits)).astype(np.int64)
    occupied = np.zeros(1 << bits, dtype=bool)
    occupied[quotient] = True
    ends = np.append(quotient[1:] != quotient[:-1], True)
    kept = (64 - skip - bits + 7) // 8
    rest = first.astype("<u8").view(np.uint8).reshape(n, 8)[:, :kept]
    many = counts.counts > 1
    return b"".join(
        [
            np.array([n, bits], dtype="<u4").tobytes(),
            np.packbits(occupied).tobytes(),
            np.packbits(ends).tobytes(),
            rest.tobytes(),
            *[x.astype("<u8").tobytes() for x in counts.lanes[1:]],
            np.packbits(many).tobytes(),
            _numerals(counts.counts[many]),
        ]
    )


def from_filter(data: bytes, segment: int, skip: int, n_lanes: int) -> Counts:
    """Exactly what :func:`to_filter` was given."""
    n, bits = map(int, np.frombuffer(data, dtype="<u4", count=2))
    at = 8

    def take(size: int) -> np.ndarray:
        nonlocal at
        at += size
        return np.frombuffer(data, dtype=np.uint8, count=size, offset=at - size)

    occupied = np.flatnonzero(np.unpackbits(take(max((1 << bits) // 8, 1)), count=1 << bits))
    ends = np.unpackbits(take((n + 7) // 8), count=n)
    run = np.cumsum(ends) - ends  # entry -> number of its run -> quotient
    kept = (64 - skip - bits + 7) // 8
    first = np.zeros((n, 8), dtype=np.uint8)
    first[:, :kept] = take(n * kept).reshape(n, kept)
    low = 64 - skip - bits
    rest = first.reshape(-1).view("<u8").astype(np.uint64)
    rest = rest & U64((1 << low) - 1) if low else rest * U64(0)
    first = rest | (occupied[run].astype(np.uint64) << U64(low))
    if skip:
        first |= U64(segment << (64 - skip))
    others = [take(8 * n).view("<u8").astype(np.uint64) for _ in range(n_lanes - 1)]
    many = np.unpackbits(take((n + 7) // 8), count=n).astype(bool)
    counts = np.ones(n, dtype=np.int64)
    counts[many] = _from_numerals(np.frombuffer(data, dtype=np.uint8, offset=at))
    return Counts([first, *others], counts)


def _numerals(values: np.ndarray) -> bytes:
    """Numbers in base 128, lowest digit first, all but the last with the top bit."""
    values = values.astype(np.uint64)
    digits = []
    while len(values) and (not digits or values.any()):
        digits.append((values & U64(127)).astype(np.uint8))
        values = values >> U64(7)
    if not digits:
        return b""
    table = np.stack(digits, axis=1)
    last = table.shape[1] - 1 - np.argmax(table[:, ::-1] > 0, axis=1)
    place = np.arange(table.shape[1])
    table = table | ((place < last[:, None]) * np.uint8(128)).astype(np.uint8)
    return table[place <= last[:, None]].tobytes()


def _from_numerals(data: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(data < 128)
    starts = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
    place = np.arange(len(data)) - np.repeat(starts, ends - starts + 1)
    digits = (data & 127).astype(np.int64) << (7 * place)
    return np.add.reduceat(digits, starts) if len(ends) else digits


def segmented(counts: Counts, skip: int) -> Iterator[tuple[int, bytes]]:
    """(segment, filter) of the segments that hold a key."""
    if not skip:
        yield 0, to_filter(counts, 0)
        return
    segment = (counts.lanes[0] >> U64(64 - skip)).astype(np.int64)
    starts = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1])))
    for start, stop in zip(starts, np.append(starts[1:], len(segment)), strict=True):
        yield int(segment[start]), to_filter(counts.part(slice(start, stop)), skip)


class Merger:
    """Adds up filters of one segment as they come: counts of a size are merged
    with others of about that size, so an entry is moved a logarithmic number
    of times."""

    def __init__(self):
        self.stack: list[Counts] = []

    def add(self, counts: Counts) -> None:
        while self.stack and len(self.stack[-1]) <= 2 * len(counts):
            counts = self.stack.pop().merged(counts)
        self.stack.append(counts)

    def total(self) -> Counts:
        counts = self.stack.pop()
        while self.stack:
            counts = self.stack.pop().merged(counts)
        return counts


# --- Bloom filters of frequent keys ----------------------------------------------


def places(lang: str, lanes: list[np.ndarray], bits: int) -> np.ndarray:
    """Bits of a lang's keys, one row of ``PROBES`` each; bits is a power of two."""
    key = mixed(mixed(lanes[0] + _others(lanes)) + U64(xxhash.xxh3_64_intdigest(lang)))
    low, step = key & U64(0xFFFFFFFF), (key >> U64(32)) | U64(1)
    return ((low[:, None] + np.arange(PROBES, dtype=np.uint64) * step[:, None]) & U64(bits - 1)).astype(np.int64)


def bloom_of(frequent: DataFrame, n: int) -> bytes:
    """Bloom filter of the keys (lang, w0, ...) of ``frequent``, merged in
    segments by Spark; at most ``MAX_BITS`` / 8 bytes come to the driver."""
    rows = frequent.count()
    bits = min(max(1 << (rows * BITS_PER_KEY).bit_length(), MIN_BITS), MAX_BITS)

    def build(batches):
        cells = np.zeros(bits, dtype=bool)
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            lanes = [batch.column(c).to_numpy().view(np.uint64) for c in LANES[:n]]
            for lang in set(langs):
                mine = langs == lang
                cells[places(lang, [x[mine] for x in lanes], bits)] = True
        for s in range(bits // BLOOM_SEGMENT):
            own = cells[s * BLOOM_SEGMENT : (s + 1) * BLOOM_SEGMENT]
            if own.any():
                yield pa.record_batch({"segment": pa.array([s], pa.int32()), "bits": [np.packbits(own).tobytes()]})

    def merge(batches):
        merged = {}
        for batch in batches:
            for s, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.frombuffer(data, dtype=np.uint8)
                merged[s] = merged[s] | own if s in merged else own
        for s, own in merged.items():
            yield pa.record_batch({"segment": pa.array([s], pa.int32()), "bits": [own.tobytes()]})

    parts = frequent.select("lang", *LANES[:n]).mapInArrow(build, "segment int, bits binary")
    out = np.zeros((bits // BLOOM_SEGMENT, BLOOM_SEGMENT // 8), dtype=np.uint8)
    for s, data in parts.repartition("segment").mapInArrow(merge, "segment int, bits binary").toLocalIterator():
        out[s] = np.frombuffer(data, dtype=np.uint8)
    return out.tobytes()


def held(bloom: np.ndarray, lang: str, lanes: list[np.ndarray]) -> np.ndarray:
    if not len(lanes[0]):
        return np.zeros(0, dtype=bool)
    at = places(lang, lanes, 8 * len(bloom))
    return ((bloom[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=1)


# --- jobs ------------------------------------------------------------------------


def word_counts(docs: DataFrame, seed: int) -> DataFrame:
    """(lang, word, id, n) of every word of ``docs`` (lang, text), exactly: in a
    block, words of one id are compared byte by byte with the first of them."""

    def run(batches):
        words, counts = Words(seed), defaultdict(int)
        for part in slices(batches):
            for lang, data in texts_by_lang(part).items():
                for ids, _, raw, starts, ends in words.blocks(data):
                    _count_words(lang, ids, raw, starts, ends, counts)
                    if len(counts) >= TASK_ENTRIES // 4:
                        yield _word_rows(counts)
                        counts.clear()
        if counts:
            yield _word_rows(counts)

    found = docs.mapInArrow(run, "lang string, word string, id long, n long")
    return found.groupBy("lang", "word", "id").agg(F.sum("n").alias("n"))


def _count_words(lang, ids, raw, starts, ends, counts) -> None:
    values, first, inverse, n = np.unique(ids, return_index=True, return_inverse=True, return_counts=True)
    size = ends - starts
    model = first[inverse]
    equal = bool((size[model] == size).all())
    if equal:
        own = np.repeat(starts - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
        data = np.frombuffer(raw, dtype=np.uint8)
        equal = np.array_equal(data[own], data[own + np.repeat(starts[model] - starts, size)])
    if equal:
        for key, i, times in zip(values.tolist(), first.tolist(), n.tolist(), strict=True):
            counts[lang, raw[starts[i] : ends[i]], key] += times
    else:  # two words share an id: the check of ids will tell
        for key, a, b in zip(ids.tolist(), starts.tolist(), ends.tolist(), strict=True):
            counts[lang, raw[a:b], key] += 1


def _word_rows(counts: dict) -> pa.RecordBatch:
    langs, words, ids = zip(*counts, strict=True)
    return pa.record_batch(
        {
            "lang": pa.array(langs, pa.string()),
            "word": pa.array([w.decode() for w in words], pa.string()),
            "id": pa.array(np.array(ids, dtype=np.uint64).view(np.int64)),
            "n": pa.array(list(counts.values()), pa.int64()),
        }
    )


def vocabulary(docs: DataFrame) -> tuple[DataFrame, int]:
    """(word_counts, seed): the first seed under which no two words share an id."""
    for seed in SEEDS:
        words = materialize(word_counts(docs, seed), "phrase-words")
        apart = words.groupBy("id").agg(F.min("word").alias("a"), F.max("word").alias("b")).where("a <> b")
        if apart.isEmpty():
            return words, seed
    raise RuntimeError(f"words share ids under each of {len(SEEDS)} seeds")


def frequent_grams(
    docs: DataFrame, n: int, seed: int, bloom: bytes, skip: int, min_count: int = MIN_COUNT
) -> DataFrame:
    """(lang, w0, ..., a) of the n-grams that occur ``min_count`` times or more;
    ``bloom`` holds the frequent (n-1)-grams."""
    shared = docs.sparkSession.sparkContext.broadcast(bloom)

    def build(batches):
        words = Words(seed)
        frequent = np.frombuffer(shared.value, dtype=np.uint8)
        mergers: dict[str, Merger] = defaultdict(Merger)
        pending: dict[str, list] = defaultdict(list)

        def settle():
            for lang, found in pending.items():
                mergers[lang].add(Counts.of([np.concatenate(x) for x in zip(*found, strict=True)]))
            pending.clear()

        def rows():
            for lang, merger in mergers.items():
                for segment, data in segmented(merger.total(), skip):
                    yield pa.record_batch(
                        {"lang": [lang], "segment": pa.array([segment], pa.int64()), "filter": [data]}
                    )
            mergers.clear()

        waiting = 0
        for part in slices(batches):
            for lang, data in texts_by_lang(part).items():
                ids, pieces = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
                for new, new_pieces, *_ in words.blocks(data):
                    ids, pieces = np.append(ids[len(ids) - (n - 1) :] if len(ids) >= n else ids, new), np.append(
                        pieces[len(pieces) - (n - 1) :] if len(pieces) >= n else pieces, new_pieces
                    )
                    shorter, whole = grams(ids, pieces, n - 1)
                    hot = whole & held(frequent, lang, shorter)
                    lanes, one_piece = grams(ids, pieces, n)
                    at = np.flatnonzero(one_piece & hot[: len(one_piece)] & hot[1 : len(one_piece) + 1])
                    if len(at):
                        pending[lang].append(permuted([x[at] for x in lanes]))
                        waiting += len(at)
                    if waiting >= TASK_ENTRIES // 4:
                        settle()
                        waiting = 0
                        if sum(len(c) for m in mergers.values() for c in m.stack) >= TASK_ENTRIES:
                            yield from rows()
        settle()
        yield from rows()

    def merge(batches):
        key, merger = None, Merger()

        def rows():
            total = merger.total()
            frequent = total.counts >= min_count
            if frequent.any():
                lanes = unpermuted([x[frequent] for x in total.lanes])
                columns = {"lang": pa.array([key[0]] * len(lanes[0]), pa.string())}
                columns |= {c: pa.array(x.view(np.int64)) for c, x in zip(LANES[:n], lanes, strict=True)}
                yield pa.record_batch(columns | {"a": pa.array(total.counts[frequent])})

        for batch in batches:
            for lang, segment, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key is not None and key != (lang, segment):
                    yield from rows()
                key = (lang, segment)
                merger.add(from_filter(data, segment, skip, n))
        if key is not None:
            yield from rows()

    shards = docs.mapInArrow(build, "lang string, segment long, filter binary")
    lanes = ", ".join(f"{c} long" for c in LANES[:n])
    return (
        shards.repartition("lang", "segment")
        .sortWithinPartitions("lang", "segment")
        .mapInArrow(merge, f"lang string, {lanes}, a long")
    )


def _keyed(df: DataFrame, n: int) -> DataFrame:
    """n-grams of any length in one table: lang, words, w0..w3 (0 beyond), a."""
    lanes = [F.col(c) if i < n else F.lit(0).cast("long").alias(c) for i, c in enumerate(LANES)]
    return df.select("lang", F.lit(n).alias("words"), *lanes, "a")


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT) -> tuple[DataFrame, DataFrame]:
    """(phrases, words): every phrase of 1 to ``MAX_WORDS`` words that occurs
    ``min_count`` times or more in its lang, as lang, words, w0..w3 and a; and
    the corpus's words (lang, word, id, n). Both are written tables."""
    docs = docs.select(F.coalesce("lang", F.lit(UNKNOWN_LANG)).alias("lang"), "text")
    words, seed = vocabulary(docs)
    total = words.agg(F.sum("n")).first()[0] or 0
    skip = (total // SEGMENT_WORDS).bit_length()
    level = words.where(F.col("n") >= min_count).select("lang", F.col("id").alias("w0"), F.col("n").alias("a"))
    phrases = _keyed(level, 1)
    # as each of them occurs min_count times or more, frequent n-grams are no more than this
    most = total // max(min_count, 1)
    for n in range(2, MAX_WORDS + 1):
        found = frequent_grams(docs, n, seed, bloom_of(level, n - 1), skip, min_count)
        # few rows of many merges go into few files: on a local disk an executor starts processes for each
        level = materialize(found.repartition(1 + most // FILE_ROWS), f"phrases-{n}")
        phrases = phrases.union(_keyed(level, n))
    return phrases, words


def _parts(candidates: DataFrame, spans: list[tuple[int, int, int]]) -> Column:
    """Array of (words, w0..w3, cut) of the sub-phrases [start, start + size) of
    a candidate that lie in it; ``spans`` are (start, size, cut)."""
    zero = F.lit(0).cast("long")

    def part(start: int, size: int, cut: int) -> Column:
        lanes = [F.col(LANES[start + i]).alias(c) if i < size else zero.alias(c) for i, c in enumerate(LANES)]
        return F.struct(F.lit(size).alias("words"), *lanes, F.lit(cut).alias("cut"))

    return F.array(*[part(*s) for s in spans])


def scored(phrases: DataFrame) -> DataFrame:
    """Candidates (lang, words, w0..w3, a) with l, r and score of their
    lowest-scoring cut, without those that a longer candidate covers."""
    key = ["lang", "words", *LANES]
    candidates = phrases.where("words > 1")
    by_length = [candidates.where(F.col("words") == n) for n in range(2, MAX_WORDS + 1)]

    def cuts(n: int) -> list:
        return [s for k in range(1, n) for s in ((0, k, k), (k, n - k, -k))]

    def inner(n: int) -> list:
        return [(start, size, 0) for size in range(2, n) for start in range(n - size + 1)]

    def exploded(df: DataFrame, spans: list) -> DataFrame:
        whole = F.struct(*[F.col(c) for c in key]).alias("whole")
        parts = F.explode(_parts(df, spans)).alias("part")
        return df.select("lang", "a", whole, parts).select("lang", "a", "whole", "part.*")

    # both sides of every cut, with their counts; a frequent word is a side of very many
    # candidates, so its one count is dealt over SALTS keys
    sides = None
    for df, n in zip(by_length, range(2, MAX_WORDS + 1), strict=True):
        rows = exploded(df, cuts(n))
        sides = rows if sides is None else sides.union(rows)
    single = F.col("words") == 1
    salts = F.when(single, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    counts = phrases.select(*key, F.col("a").alias("f"), F.explode(salts).alias("salt"))
    salt = F.when(single, F.pmod(F.xxhash64("whole"), F.lit(SALTS)).cast("int")).otherwise(0)
    side = sides.withColumn("salt", salt).join(counts, [*key, "salt"]).withColumn("k", F.abs("cut"))
    per_cut = side.groupBy("whole", "a", "k").agg(
        F.max(F.when(F.col("cut") > 0, F.col("f"))).alias("l"), F.max(F.when(F.col("cut") < 0, F.col("f"))).alias("r")
    )
    # a * SCALE and l + r can pass 64 bits
    score = F.expr(f"(cast(a AS decimal(19,0)) * {SCALE}BD) div (cast(l AS decimal(19,0)) + cast(r AS decimal(19,0)))")
    best = (
        per_cut.withColumn("score", score)
        .groupBy("whole", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("whole.*", "a", "cut.l", "cut.r", "cut.score")
    )
    covers = None
    for df, n in list(zip(by_length, range(2, MAX_WORDS + 1), strict=True))[1:]:
        rows = exploded(df, inner(n)).groupBy(*key).agg(F.max("a").alias("longer"))
        covers = rows if covers is None else covers.union(rows)
    covers = covers.groupBy(*key).agg(F.max("longer").alias("longer"))
    covered = F.expr(f"coalesce(cast(longer AS decimal(19,0)) * 100BD >= cast(a AS decimal(19,0)) * {COVERED}BD, false)")
    return best.join(covers, key, "left").where(~covered).drop("longer")


def collocations(docs: DataFrame, top: int = TOP, min_count: int = MIN_COUNT) -> DataFrame:
    """Each lang's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    phrases, words = frequent_phrases(docs, min_count)
    # all that may be among the first, ties included; only these become text. A lang's
    # phrases are ranked in parts, so that the last step sees SALTS * top of them and ties
    best = scored(phrases).withColumn("salt", F.pmod(F.xxhash64(*LANES), F.lit(SALTS)))
    for part in (["lang", "salt"], ["lang"]):
        order = Window.partitionBy(*part).orderBy(F.col("score").desc(), F.col("a").desc())
        best = best.withColumn("place", F.rank().over(order)).where(F.col("place") <= top).drop("place")
    first = materialize(best.drop("salt"), "phrases-first")
    lanes = F.array(*LANES)
    spelled = (
        first.select("*", F.posexplode(F.slice(lanes, F.lit(1), F.col("words"))).alias("at", "id"))
        .join(words.select("lang", "id", "word"), ["lang", "id"])
        .groupBy("lang", "words", *LANES, "a", "l", "r", "score")
        .agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("spelling"))
        .withColumn("phrase", F.array_join(F.col("spelling.word"), " "))
    )
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    final = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    return (
        spelled.withColumn("rank", F.row_number().over(final).cast("long"))
        .where(F.col("rank") <= top)
        .join(totals, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )


COLLOCATIONS_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, s.n AS words, unnest(list_transform(range(1, len(w) - s.n + 2), lambda i: array_to_string(w[i:i + s.n - 1], ' '))) AS phrase
  FROM words, (VALUES (1), (2), (3), (4)) s(n) WHERE len(w) >= s.n
), f AS (
  SELECT lang, words, phrase, count(*)::HUGEINT AS a FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, sum(a)::BIGINT AS n FROM f WHERE words = 1 GROUP BY lang
), candidates AS (
  SELECT *, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND a >= 30
), cuts AS (
  SELECT c.lang, c.words, c.phrase, c.a, c.w, k, l.a AS l, r.a AS r, 2000000 * c.a // (l.a + r.a) AS score
  FROM candidates c, (VALUES (1), (2), (3)) t(k)
  JOIN f l ON l.lang = c.lang AND l.words = k AND l.phrase = array_to_string(c.w[1:k], ' ')
  JOIN f r ON r.lang = c.lang AND r.words = c.words - k AND r.phrase = array_to_string(c.w[k + 1:], ' ')
  WHERE k < c.words
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_phrases AS (
  SELECT c.lang, array_to_string(c.w[s:s + n - 1], ' ') AS phrase, max(c.a) AS longer
  FROM candidates c, (VALUES (1), (2), (3)) t(s), (VALUES (2), (3)) u(n)
  WHERE n < c.words AND s + n - 1 <= c.words GROUP BY ALL
), kept AS (
  SELECT x.* FROM lowest x LEFT JOIN inner_phrases i ON i.lang = x.lang AND i.phrase = x.phrase
  WHERE i.longer IS NULL OR 100 * i.longer < 80 * x.a
)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM kept k JOIN totals t ON t.lang = k.lang
QUALIFY rank <= 2000
"""
