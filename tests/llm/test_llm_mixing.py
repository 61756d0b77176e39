"""Weighted fair mixing against a plain restatement of its rules."""

import hashlib
import re
from fractions import Fraction

import pytest

from airlake.llm import mixing

SCHEMA = "doc_id long, source string, text string, target string, uses string"


def frame(spark, rows):
    return spark.createDataFrame([(i, s, t, "clash", None) for i, s, t in rows], SCHEMA)


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def fair_targets(sizes: list[int]) -> list[Fraction]:
    """Share by weight; while a target is above its cap, fix it there and
    share the rest again."""
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    fixed: dict[int, Fraction] = {}
    while True:
        rest = sum(sizes) - sum(fixed.values())
        open_ = [i for i in range(len(sizes)) if i not in fixed]
        level = Fraction(rest, sum(weights[i] for i in open_)) if open_ else 0
        over = [i for i in open_ if level * weights[i] > 3 * sizes[i]]
        if not over:
            return [fixed.get(i, level * weights[i]) for i in range(len(sizes))]
        fixed |= {i: Fraction(3 * sizes[i]) for i in over}


def item_of(i, s, t):
    key = f"{'n' if i is None else f'i{i}'} {'n' if s is None else f's{s}'} {t or ''}"
    return hashlib.md5(key.encode()).hexdigest()


def brute(rows):
    """doc rows -> (doc_id, size, source_size, target, taken), sorted; equal rows one by one."""
    by_source = sorted({s for _, s, _ in rows}, key=lambda s: (s is None, (s or "").encode()))
    total = {s: sum(words(t) for _, x, t in rows if x == s) for s in by_source}
    target = dict(zip(by_source, fair_targets([total[s] for s in by_source]), strict=True))
    copies, documents = {}, []
    for i, s, t in rows:
        item = item_of(i, s, t)
        copy = copies[item] = copies.get(item, -1) + 1
        spot = int(hashlib.md5(f"{item} {copy}".encode()).hexdigest()[:15], 16)
        documents.append((spot, item, copy, i, s, words(t)))
    entries = []
    for place, s in enumerate(by_source):
        sent = 0
        for spot, item, copy, _, _, size in sorted(d for d in documents if d[4] == s and d[5]):
            sent += size
            for p in range(3):
                finish = float(sent + p * total[s]) / float(target[s])
                entries.append((finish, place, spot, item, copy, p, size))
    taken, at = {}, 0
    for *_, item, copy, _, size in sorted(entries):
        at += size
        if at > sum(total.values()):
            break
        taken[item, copy] = taken.get((item, copy), 0) + 1
    out = [(i, n, total[s], float(target[s]), n * taken.get((item, copy), 0)) for _, item, copy, i, s, n in documents]
    return sorted(out, key=str)


def result(spark, rows):
    got = mixing.taken_words(frame(spark, rows)).select("doc_id", "size", "source_size", "target", "taken").collect()
    return sorted(map(tuple, got), key=str)


def same(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[:3] == w[:3] and g[4] == w[4], (g, w)
        assert g[3] == pytest.approx(w[3], rel=1e-12)


ROWS = [(i, f"s{i % 7}" if i % 11 else None, " ".join("w" * (1 + k % 3) for k in range(i * i % 37))) for i in range(200)]


@pytest.mark.parametrize("range_rows", [8192, 4])
def test_equals_the_plain_rules(spark, monkeypatch, range_rows):
    monkeypatch.setattr(mixing, "RANGE_ROWS", range_rows)
    monkeypatch.setattr(mixing, "CELL_ROWS", range_rows)
    rows = ROWS + [(500, "big", "x\ty\x0bz " * 4000), (501, "none", None), (502, "s1", ""), (503, "s1", "é é b")]
    same(result(spark, rows), brute(rows))


def test_sources_come_near_their_targets_and_nothing_is_taken_over_three_times(spark):
    got = mixing.taken_words(frame(spark, ROWS)).collect()
    by = {}
    for r in got:
        assert r.taken <= 3 * r.size
        by.setdefault((r.source_size, r.target), []).append(r.taken)
    for (_, target), taken in by.items():
        assert abs(sum(taken) - target) <= 2 * 37


def test_repeated_rows_are_taken_one_by_one_and_reruns_agree(spark):
    rows = ROWS + [(7, "s0", "one two three")] * 5 + [(None, None, "a b")] * 2
    first = result(spark, rows)
    same(first, brute(rows))
    again = mixing.taken_words(frame(spark, rows[::-1]).repartition(5))
    assert first == sorted(map(tuple, again.select("doc_id", "size", "source_size", "target", "taken").collect()), key=str)


@pytest.mark.parametrize("chunk", [4096, 3])
def test_a_hot_row_leaves_its_source_near_its_target(spark, monkeypatch, chunk):
    """A third of all rows equal; in their source 290 of 300."""
    monkeypatch.setattr(mixing, "COPY_CHUNK", chunk)
    monkeypatch.setattr(mixing, "CELL_ROWS", 16)
    monkeypatch.setattr(mixing, "RANGE_ROWS", 16)
    text = "w " * 10
    rows = [(i, s, text) for s in "abc" for i in range(300)]
    rows = [(0, "b", text) if s == "b" and i < 290 else (i, s, t) for i, s, t in rows]
    got = result(spark, rows)
    same(got, brute(rows))
    by = {}
    for _, _, _, target, taken in got:
        by[target] = by.get(target, 0) + taken
    assert len(by) == 3 and all(abs(taken - target) <= 20 for target, taken in by.items()), by
    mixed = mixing.mixed_documents(frame(spark, rows).repartition(7))
    counts = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert sorted(10 * n for n in counts.values()) == sorted(by.values())


def test_rows_that_differ_in_other_columns_share_their_uses(spark):
    rows = [(1, "a", "x y", str(k), None) for k in range(50)] + [(2, "b", "z " * 300, "", None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    taken = sum(r.taken // r.size for r in mixing.taken_words(docs).collect() if r.doc_id == 1)
    got = [r["count"] for r in mixing.mixed_documents(docs).where("doc_id = 1").groupBy("target").count().collect()]
    assert sum(got) == taken and max(got) - min([*got, *[0] * (50 - len(got))]) <= 1


def test_mixed_documents_repeat_rows_as_often_as_they_are_taken(spark):
    docs = frame(spark, ROWS)
    taken = {r.doc_id: r.taken // r.size for r in mixing.taken_words(docs).collect() if r.size}
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {i: n for i, n in taken.items() if n}


@pytest.mark.parametrize("rows", [[], [(1, "a", None)], [(1, None, ""), (2, "b", " \t")], [(1, "a", "one")]])
def test_tables_without_words(spark, rows):
    got = mixing.taken_words(frame(spark, rows)).collect()
    assert [r.taken for r in got] == [r.size for r in got] and len(got) == len(rows)
    assert mixing.mixed_documents(frame(spark, rows)).count() == sum(1 for _, _, t in rows if words(t))


def test_main_path_has_no_python(spark):
    plan = mixing.taken_words(frame(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
