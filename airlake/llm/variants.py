"""Spelling variants by permuterm rotations.

A word with a terminator behind it is rotated to every place: ``v | u`` for each
split u v, the terminator between. Words that differ in one code point meet in
these rotations. If the edited place is rotated to the end, a replacement leaves
all before it equal; a code point more or less leaves one rotation the prefix of
the other. So every word sends, sorted by prefix, its whole rotations (splits) and its
rotations without the last code point (edits, with that code point beside):
a group of equal prefixes holds at most one split and, as words differ, one edit
for each code point of the alphabet. Edits of a group are replacements of each
other, and each inserts its code point into the split's word. Where the code
point equals the one before it, the same insertion is found at the left end of that run
too; only there it counts, so each pair of near words is met once.

The rotations are range-sorted by Spark and groups are scanned in order. A scan
hands on one row per member (how many near words, and the most frequent), never
a group's pairs; these are added up by word.

Defined results: null or empty texts have no words; null ids count as an empty
id in the hash; repeated rows count again, with the same edits; among near words
of the same count the first in code-point order is the form; an empty table gives no
rows. Texts of any length are read whole, run by run. Other columns play no part.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlake.llm.common import materialize, slices

RUN = r"[A-Za-zÀ-ÿ]"
MIN_CHARS = 7
MIN_COUNT = 2
#: One run in so many loses a code point.
EDIT_EVERY = 31
#: A form has at least so many times the occurrences of its variant.
RATIO = 10
#: Stands behind a word; no letter, and first in the order.
TERMINATOR = "\x01"
#: Distinct words that a task counts before it hands them on.
TASK_WORDS = 1 << 19
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def edited_runs(doc_id: object, text: str, min_chars: int = MIN_CHARS) -> Iterator[tuple[str, int]]:
    """(word, times) of a text's lower-cased runs, with the code point deleted
    that the hash of the id and the run names. Shorter runs than ``min_chars``
    give no word, edited or not."""
    whole = re.compile(f"{RUN}{{{min_chars},}}")
    runs = Counter(m.group().translate(LOWER) for m in whole.finditer(text))
    head = f"{'' if doc_id is None else doc_id}:"
    for run, times in runs.items():
        h = zlib.crc32((head + run).encode())
        if h % EDIT_EVERY == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= min_chars:
            yield run, times


def word_counts(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words of ``docs`` (doc_id, text)."""

    def rows(counts):
        return pa.record_batch({"word": pa.array(counts.keys(), pa.string()), "n": pa.array(counts.values(), pa.int64())})

    def run(batches):
        counts: Counter = Counter()
        for part in slices(batches):
            for doc_id, text in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text")), strict=True):
                for word, times in edited_runs(doc_id, text or "", min_chars):
                    counts[word] += times
                if len(counts) >= TASK_WORDS:
                    yield rows(counts)
                    counts.clear()
        if counts:
            yield rows(counts)

    found = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, last, n): for words (word, n), every whole rotation with an empty
    ``last``, and every rotation without its last code point, which is ``last``."""
    size = F.char_length("word")
    word, end = F.col("word"), F.lit(TERMINATOR)

    def rotation(after, before, last):
        tail = word.substr(after, F.greatest(size - after + 1, F.lit(0)))
        return F.struct(F.concat(tail, end, word.substr(F.lit(1), before)).alias("prefix"), last.alias("last"))

    splits = F.transform(F.sequence(F.lit(0), size), lambda i: rotation(i + 1, i, F.lit("")))
    edits = F.transform(F.sequence(F.lit(1), size), lambda i: rotation(i + 1, i - 1, word.substr(i, F.lit(1))))
    return words.select(F.explode(F.concat(splits, edits)).alias("r"), "n").select("r.*", "n")


def word_of(prefix: str, last: str) -> str:
    tail, head = prefix.split(TERMINATOR)
    return head + last + tail


def scan_group(prefix: str, members: list[tuple[str, int]]) -> Iterator[tuple[str, int, int, str]]:
    """(word, near words met here, the largest n of them, its word) for each
    member (last, n) of a group that meets any."""
    before = prefix[-1]
    edits = sorted(((-n, word_of(prefix, last), last) for last, n in members if last))
    split = [(-n, word_of(prefix, ""), "") for last, n in members if not last]
    for own in edits:
        others = edits[:1] if edits[0] is not own else edits[1:2]
        count = len(edits) - 1
        if split and own[2] != before:
            others, count = others + split, count + 1
        if count:
            n, word, _ = min(others)
            yield own[1], count, -n, word
    for own in split:
        others = [e for e in edits if e[2] != before]
        if others:
            n, word, _ = others[0]
            yield own[1], len(others), -n, word


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, near_n, near): how many of ``words`` (word, n; no word twice)
    are one code point away, and the most frequent of these. Words without any are left out."""

    def scan(batches):
        prefix, members, out = None, [], []

        def batch_of(rows):
            word, count, n, near = zip(*rows, strict=True)
            return pa.record_batch(
                {"word": pa.array(word, pa.string()), "met": pa.array(count, pa.int64()),
                 "near_n": pa.array(n, pa.int64()), "near": pa.array(near, pa.string())}
            )

        for batch in batches:
            keys = batch.column("prefix")
            if not len(keys):
                continue
            equal = pc.equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False)
            heads = np.flatnonzero(np.concatenate(([True], ~equal)))
            stops = np.append(heads[1:], len(keys))
            # the first group may go on with the last one of the batch before;
            # of the others only those with two members or more are looked at
            wanted = np.flatnonzero((stops - heads > 1) | (heads == 0) | (stops == len(keys)))
            for start, stop in zip(heads[wanted].tolist(), stops[wanted].tolist(), strict=True):
                key = keys[start].as_py()
                rows = list(
                    zip(
                        batch.column("last").slice(start, stop - start).to_pylist(),
                        batch.column("n").slice(start, stop - start).to_pylist(),
                        strict=True,
                    )
                )
                if key != prefix:
                    if len(members) > 1:
                        out += scan_group(prefix, members)
                    prefix, members = key, rows
                else:
                    members = members + rows
                if len(out) >= 1 << 14:
                    yield batch_of(out)
                    out = []
        if len(members) > 1:
            out += scan_group(prefix, members)
        if out:
            yield batch_of(out)

    ordered = rotations(words).repartitionByRange("prefix").sortWithinPartitions("prefix")
    met = ordered.mapInArrow(scan, "word string, met long, near_n long, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("best")
    return (
        met.groupBy("word")
        .agg(F.sum("met").alias("n_near"), best)
        .select("word", "n_near", (-F.col("best.n")).alias("near_n"), F.col("best.word").alias("near"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for ``forms`` (word, form): forms are followed to the last.

    Each round doubles the steps taken. A form is more frequent than its word by
    a constant factor, so chains are as short as a count has digits."""
    steps = materialize(forms.select("word", F.col("form").alias("root")), "variant-steps")
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = steps.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        longer = materialize(longer, "variant-steps")
        steps = longer.drop("moved")
        if longer.where("moved").isEmpty():
            return steps


def variant_groups(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near and form_n of written ``words`` (word, n)."""
    near = near_words(words)
    own = words.join(near, "word", "left")
    is_form = F.col("near_n") >= ratio * F.col("n")
    known = materialize(
        own.select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(is_form, F.col("near")).alias("form"), F.when(is_form, F.col("near_n")).alias("form_n"),
        ),
        "variant-forms",
    )
    last = roots(known.where("form IS NOT NULL"))
    return known.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame) -> DataFrame:
    """Words of ``docs`` with their near words, forms and roots."""
    return variant_groups(materialize(word_counts(docs), "variant-words"))
