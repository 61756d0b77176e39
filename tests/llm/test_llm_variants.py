"""Spelling variants against all edits of every word."""

import random
import re
import zlib
from collections import Counter

import pytest

from airlake.llm import variants

SCHEMA = "doc_id long, text string, word string, n string, prefix string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", None, "clash") for i, t in rows], SCHEMA)


def plain_words(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def edits(word, letters):
    out = set()
    for i in range(len(word) + 1):
        out |= {word[:i] + c + word[i:] for c in letters} | {word[:i] + word[i + 1 :]}
        if i < len(word):
            out |= {word[:i] + c + word[i + 1 :] for c in letters}
    return out - {word}


def plain_groups(words):
    letters = set("".join(words))
    near = {w: [x for x in edits(w, letters) if x in words] for w in words}
    best = {w: min(ns, key=lambda x: (-words[x], x)) for w, ns in near.items() if ns}
    form = {w: b for w, b in best.items() if words[b] >= 10 * words[w]}
    out = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        f = form.get(w)
        out.add((w, f, root, n, len(near[w]), words[f] if f else None))
    return out


def groups(spark, words):
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    rows = variants.variant_groups(df).collect()
    assert len(rows) == len(words)
    return {tuple(r) for r in rows}


def test_equals_all_edits(spark):
    r = random.Random(3)
    rows = [
        (i % 70, " ".join("".join(r.choices("abÀé", weights=(5, 3, 1, 1), k=r.randrange(6, 10))).title() for _ in range(60)))
        for i in range(80)
    ] + [(None, "Abababab abababab"), (None, None), (7, ""), (8, "ab" * 3000 + " " + "ab" * 3000)]
    rows = rows + rows[:5]
    words = plain_words(rows)
    found = variants.spelling_variants(frame(spark, rows)).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len(found) == len(words) > 300
    assert set(map(tuple, found)) == plain_groups(words)


def test_repeated_letters_meet_once(spark):
    words = {"a" * n: 10 ** (9 - n % 9) for n in range(1, 9)} | {"aabaa": 7, "abaa": 9, "aaba": 100}
    assert groups(spark, words) == plain_groups(words)


def test_chains_of_forms_end_at_the_root(spark):
    words = {"abcdefg" + "x" * k: 2 * 10**k for k in range(14)}
    found = groups(spark, words)
    assert found == plain_groups(words)
    assert {root for _, _, root, *_ in found} == {"abcdefg" + "x" * 13}


def test_ties_take_the_first_word(spark):
    words = {"abcdefg": 2, "abcdefh": 50, "abcdefÿ": 50, "abcdef": 50, "bcdefg": 50}
    assert groups(spark, words) == plain_groups(words)


def test_a_group_as_large_as_the_alphabet_across_batches(spark):
    letters = [chr(c) for c in range(ord("a"), ord("z") + 1)] + [chr(c) for c in range(0xC0, 0x100)]
    words = {f"word{c}end": i + 2 for i, c in enumerate(letters)} | {"wordend": 1000}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = groups(spark, words)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == plain_groups(words)


def test_tasks_that_hand_words_on_early(spark, monkeypatch):
    monkeypatch.setattr(variants, "TASK_WORDS", 2)
    rows = [(i, f"wording wordings swording {'reading ' * 3}") for i in range(40)]
    words = {r.word: r.n for r in variants.word_counts(frame(spark, rows)).collect()}
    assert words == plain_words(rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "short words"), (2, "lonesome")]])
def test_tables_without_words(spark, rows):
    assert variants.spelling_variants(frame(spark, rows)).collect() == []
