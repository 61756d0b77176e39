"""Collocations against a plain count, and the filters against plain sets."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from airlake.llm import phrases

SCHEMA = "doc_id long, text string, lang string, word string, n string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "clash", None) for i, t, lang in rows], SCHEMA)


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, min_count, top):
    counts, total = {}, Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        f = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in range(1, 5):
                f.update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        rows_ = []
        for p, a in candidates.items():
            inside = [
                q for q in candidates
                if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            ]
            if any(100 * candidates[q] >= 80 * a for q in inside):
                continue
            cuts = [(2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, l, r = min(cuts)
            rows_.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows_)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def got(spark, rows, top=2000, min_count=3, parts=3):
    df = phrases.collocations(frame(spark, rows).repartition(parts), top, min_count)
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def corpus(seed=5, docs=60):
    r = random.Random(seed)
    vocabulary = ["New", "York", "city", "of", "the", "é", "ÀB", "x" * 80, "a\x0bb", "\x00", "the end", "data"]
    rows = []
    for i in range(docs):
        words = r.choices(vocabulary, k=r.randrange(0, 60))
        text = "".join(w + r.choice([" ", " ", "  ", "\t", ", ", ".", "\n", " "]) for w in words)
        rows.append((i % 40, text, r.choice(["en", "en", "de", None])))
    return rows + [(None, None, "en"), (1, "", "fr"), (2, " \t.,", "fr"), (3, "new york " * 30, "und")]


def test_equals_the_plain_count(spark):
    rows = corpus()
    assert got(spark, rows) == brute(rows, 3, 2000)


def test_top_cuts_ties_by_phrase(spark):
    rows = corpus(7)
    assert got(spark, rows, top=4) == brute(rows, 3, 4)


def test_bounded_memory_changes_nothing(spark, monkeypatch):
    # tiny blocks (pieces and words across them), tasks that hand on early, many segments, full Bloom filters
    rows = corpus(9, 30) + [(77, "the city of " * 200, "en"), (78, "z" * 500 + " of the city", "en")]
    for name, value in {
        "BLOCK": 100, "TASK_ENTRIES": 64, "SEGMENT_WORDS": 100, "MIN_BITS": 1 << 16, "MAX_BITS": 1 << 16, "PROBES": 1,
    }.items():
        monkeypatch.setattr(phrases, name, value)
    assert got(spark, rows) == brute(rows, 3, 2000)


def test_frequent_phrases_go_into_few_files(spark, monkeypatch):
    """By their number, however many segments and shuffle partitions they are merged in."""

    def files(rows):
        table, _ = phrases.frequent_phrases(frame(spark, rows).repartition(3), 3)
        return {n: sum(f"/phrases-{n}-" in f for f in table.inputFiles()) for n in (2, 3, 4)}

    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    monkeypatch.setattr(phrases, "SEGMENT_WORDS", 100)
    rows, before = corpus(13), spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")
    try:
        assert set(files(rows).values()) == {1}
        monkeypatch.setattr(phrases, "FILE_ROWS", 300)  # some 1,800 words, so at most 600 frequent n-grams
        assert all(1 < n <= 3 for n in files(rows).values())
        assert got(spark, rows) == brute(rows, 3, 2000)
    finally:
        spark.conf.set(coalesce, before)


def test_a_hot_lang_and_repeated_rows(spark):
    rows = [(1, "to be or not to be", "en")] * 50 + [(i, f"word{i} to be", "de") for i in range(20)]
    assert got(spark, rows) == brute(rows, 3, 2000)


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "one two three", "en")]])
def test_tables_without_candidates(spark, rows):
    assert got(spark, rows) == []


def test_covered_phrases_go_at_eighty_percent(spark):
    rows = [(1, "a b c. " * 8 + "a b. " * 2, "en"), (2, "d e f. " * 7 + "d e. " * 2, "en")]
    kept = {r[2] for r in got(spark, rows)}
    assert "a b" not in kept and "d e" in kept  # 8 of 10 and 7 of 9


def test_scores_past_64_bits(spark):
    big = 5 * 10**12
    rows = [("en", 1, 7, 0, 0, 0, 3 * big), ("en", 1, 8, 0, 0, 0, 2 * big), ("en", 2, 7, 8, 0, 0, 2 * big)]
    table = spark.createDataFrame(rows, "lang string, words int, w0 long, w1 long, w2 long, w3 long, a long")
    r = phrases.scored(table).first()
    assert (r.l, r.r, r.score) == (3 * big, 2 * big, 2_000_000 * 2 * big // (5 * big))


def test_the_permutation_is_inverted():
    r = np.random.default_rng(3)
    for n in (1, 2, 3, 4):
        lanes = [r.integers(0, 1 << 64, 500, dtype=np.uint64) for _ in range(n)]
        back = phrases.unpermuted(phrases.permuted(lanes))
        assert all((a == b).all() for a, b in zip(lanes, back, strict=True))


@pytest.mark.parametrize("skip", [0, 1, 5, 20])
@pytest.mark.parametrize("lanes", [1, 2, 4])
def test_filters_are_lossless_and_merge(skip, lanes):
    r = np.random.default_rng(skip + lanes)
    segment = (1 << skip) - 1

    def some(size):
        keys = [r.integers(0, 1 << 64, size, dtype=np.uint64) for _ in range(lanes)]
        if skip:
            keys[0] = (keys[0] >> np.uint64(skip)) | np.uint64(segment << (64 - skip))
        keys = [np.concatenate((k, k[: size // 2])) for k in keys]
        return keys, np.concatenate((r.integers(1, 5, size), r.integers(1, 1 << 40, size // 2)))

    plain, merger = Counter(), phrases.Merger()
    for size in (1, 300, 2, 77):
        keys, counts = some(size)
        for key, c in zip(zip(*[k.tolist() for k in keys], strict=True), counts.tolist(), strict=True):
            plain[key] += c
        data = phrases.to_filter(phrases.Counts.of(keys, counts), skip)
        merger.add(phrases.from_filter(data, segment, skip, lanes))
    total = merger.total()
    found = dict(zip(zip(*[k.tolist() for k in total.lanes], strict=True), total.counts.tolist(), strict=True))
    assert found == plain
    firsts = total.lanes[0]
    assert (firsts[1:] >= firsts[:-1]).all()


def test_keys_that_agree_in_the_mixed_lane_stay_apart():
    a = np.array([5, 5, 5, 5], dtype=np.uint64)
    b = np.array([2, 1, 2, 1], dtype=np.uint64)
    counts = phrases.Counts.of([a, b])
    assert counts.lanes[1].tolist() == [1, 2] and counts.counts.tolist() == [2, 2]


def test_word_ids_do_not_depend_on_blocks(monkeypatch):
    data = lowered("alpha beta," * 40 + "b" * 300 + " gamma.x").encode()
    whole = {raw[a:b]: i for ids, _, raw, s, e in phrases.Words(1).blocks(data) for i, a, b in zip(ids.tolist(), s, e, strict=True)}
    monkeypatch.setattr(phrases, "BLOCK", 70)
    cut = {raw[a:b]: i for ids, _, raw, s, e in phrases.Words(1).blocks(data) for i, a, b in zip(ids.tolist(), s, e, strict=True)}
    assert whole == cut and set(whole) == {b"alpha", b"beta", b"b" * 300, b"gamma", b"x"}


def test_colliding_ids_take_another_seed(spark, monkeypatch):
    real = phrases.Words

    class Weak(real):
        def _ids(self, raw, starts, ends):
            ids = super()._ids(raw, starts, ends)
            return ids & np.uint64(1) if self.seed == 1 else ids

    monkeypatch.setattr(phrases, "Words", Weak)
    rows = corpus(11, 20)
    words, seed = phrases.vocabulary(frame(spark, rows).select("lang", "text").fillna("und", "lang"))
    assert seed == 2
    plain = Counter()
    for _, text, lang in rows:
        plain.update((lang or "und", w) for w in re.findall(r"[^\x20\x09.,;:!?\x0A-\x0D]+", lowered(text or "")))
    assert {(r.lang, r.word): r.n for r in words.collect()} == dict(plain)
