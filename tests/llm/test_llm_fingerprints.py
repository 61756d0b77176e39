"""Fingerprints against a plain version of the same rules."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from airlake.llm import fingerprints as fp
from airlake.llm.common import table

RNG = np.random.default_rng(4)


def prose(n, seed):
    rng = np.random.default_rng(seed)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 9))) for _ in range(200)]
    return " ".join(words[i] for i in rng.integers(0, 200, n))


def level(window: bytes) -> int:
    total = sum(int(fp.STEPS[: c + 1].sum()) for c in Counter(window).values())
    return (fp.FULL - total) * fp.LEVELS // fp.FULL


def plain_places(data: bytes, ranks) -> list[int]:
    """Starts of the feature windows, straight from the rules."""
    n = len(data) - fp.WINDOW + 1
    keys = []
    for i in range(n):
        own = level(data[i : i + fp.WINDOW])
        keys.append(None if own < fp.MIN_LEVEL else (int(ranks[own]), i))
    points = Counter()
    for i in range(-fp.WINDOW + 1, n):
        near = [k for k in keys[max(0, i) : i + fp.WINDOW] if k is not None]
        if near:
            points[min(near)[1]] += 1
    return sorted(i for i, p in points.items() if p >= fp.MIN_POINTS)


@pytest.mark.parametrize("data", [prose(300, 1).encode(), b"a" * 500 + prose(60, 2).encode(), ("日本語 ö " * 100).encode() + prose(50, 3).encode()])
def test_features_are_those_of_the_rules(data):
    ranks = np.random.default_rng(0).permutation(fp.LEVELS + 1)
    places = plain_places(data, ranks)
    rows = np.array([list(data[i : i + fp.WINDOW]) for i in places], dtype=np.uint8)
    assert places and (fp.features([b"pre" * 99, data], ranks)[1] == fp._mixed(rows.view(np.uint64))).all()


def test_cutting_a_long_text_changes_nothing(monkeypatch):
    ranks = np.random.default_rng(0).permutation(fp.LEVELS + 1)
    data = [prose(9000, 5).encode(), b"z" * 3000, prose(400, 6).encode()]
    whole, counts = fp.features(data, ranks), fp.level_counts(data)
    monkeypatch.setattr(fp, "CHUNK", 700)
    for a, b in zip(whole, fp.features(data, ranks), strict=True):
        assert (a == b).all()
    assert (fp.level_counts(data) == counts).all()
    assert counts.sum() == sum(len(d) - fp.WINDOW + 1 for d in data)


def test_likeness():
    ranks = np.arange(fp.LEVELS + 1)
    a, b = prose(3000, 7), prose(3000, 8)
    da, db, dh = fp.digests([a.encode(), b.encode(), (a[: len(a) // 2] + b[: len(a) // 2]).encode()], ranks)
    assert fp.likeness(da, da) == 1 and fp.likeness(da, db) < 0.1
    assert 0.35 < fp.likeness(da, dh) < 0.75
    empty = fp.digests([b""], ranks)[0]
    assert fp.likeness(empty, empty) == 1 and fp.likeness(empty, da) == 0
    assert (fp.from_text(fp.to_text(da)) == da).all() and fp.to_text(empty) == ""


ROWS = [
    (5, None), (1, prose(500, 10)), (2, "short"), (3, ""), (4, prose(500, 10)), (None, "no id at all"),
    (7, "ö" * 301), (9, prose(40_000, 11)), (9, "again nine"), (12, prose(30, 12)), (13, "x"),
]


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_edits_follow_the_order_of_ids(spark, partitions):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in ROWS], "doc_id long, text string, fingerprint string, part int")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        got = fp.edit_likeness(docs.repartition(4)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    ranks = fp.rarity(docs)
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    want = []
    for k, (i, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        new = t[: len(t) - half] + after[:half]
        a, b, c = fp.digests([x.encode() for x in (t, new, after)], ranks)
        sha = hashlib.sha256(new.encode()).hexdigest()
        want.append((i, len(t), sha, fp.to_text(a), fp.to_text(b), fp.likeness(a, b), fp.likeness(a, c)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_one_row_follows_itself_and_no_rows_give_none(spark):
    one = spark.createDataFrame([(1, "abcdef" * 50)], "doc_id long, text string")
    (r,) = fp.edit_likeness(one).collect()
    assert r.near_next == 1 and r.n_chars == 300
    assert fp.edit_likeness(one.limit(0)).collect() == []


def test_on_documents_edits_stay_near_and_neighbours_do_not(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    got = [r for r in fp.edit_likeness(docs).collect() if r.n_chars >= 300]
    assert np.median([r.near_edited for r in got]) > 0.35
    assert np.median([r.near_next for r in got]) < 0.05
    prints = {r.doc_id: r.fingerprint for r in got}
    texts = {}
    for r in docs.collect():
        if r.doc_id in prints:
            assert texts.setdefault(r.text, prints[r.doc_id]) == prints[r.doc_id]


def plain_filters(hashes) -> list[set[int]]:
    """Chained filters as sets of bit numbers."""
    out = []
    for k, h in enumerate(int(x) for x in hashes):
        if k % fp.FILTER_FEATURES == 0:
            out.append(set())
        out[-1] |= {(h >> (11 * j)) % fp.FILTER_BITS for j in range(fp.FEATURE_BITS)}
    return out


def plain_likeness(a: list[set[int]], b: list[set[int]]) -> float:
    if not a or not b:
        return float(len(a) == len(b))
    if len(a) > len(b):
        a, b = b, a
    total = 0.0
    for x in a:
        best = 0.0
        for y in b:
            chance, most = len(x) * len(y) / fp.FILTER_BITS, min(len(x), len(y))
            best = max(best, min(max((len(x & y) - chance) / max(most - chance, 1e-9), 0), 1))
        total += best * len(x)
    return total / sum(len(x) for x in a)


def bits_of(digest: np.ndarray) -> list[set[int]]:
    return [set(np.flatnonzero(np.unpackbits(row)).tolist()) for row in digest]


@pytest.mark.parametrize("sizes", [(0, 0), (0, 5), (1, 1), (160, 161), (400, 90), (1000, 700)])
def test_filters_and_likeness_are_those_of_the_rules(sizes):
    rng = np.random.default_rng(sum(sizes))
    pool = rng.integers(0, 1 << 63, 1200, dtype=np.uint64)
    a, b = (rng.choice(pool, n, replace=False) for n in sizes)
    da, db = fp.filters(a), fp.filters(b)
    assert bits_of(da) == plain_filters(a) and bits_of(db) == plain_filters(b)
    assert fp.likeness(da, db) == pytest.approx(plain_likeness(plain_filters(a), plain_filters(b)), abs=1e-12)
    assert fp.likeness(db, da) == pytest.approx(plain_likeness(plain_filters(b), plain_filters(a)), abs=1e-12)


def test_the_query_gives_the_plain_likeness(spark):
    docs = spark.createDataFrame([(i, t) for i, t in ROWS if i is not None], "doc_id long, text string")
    ranks = fp.rarity(docs)
    prints = {}
    for r in fp.edit_likeness(docs).collect():
        own, new = (bits_of(fp.from_text(x)) for x in (r.fingerprint, r.edited_fingerprint))
        assert r.near_edited == pytest.approx(plain_likeness(own, new), abs=1e-12)
        prints.setdefault(r.doc_id, own)
    texts = dict(ROWS)
    (own,) = fp.features([texts[1].encode()], ranks)
    assert prints[1] == plain_filters(own)


def test_no_range_holds_an_id_with_a_third_of_the_rows(spark):
    """By text, and where the texts are equal too."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    rows = [(7 if i % 3 == 0 else i, "equal" if i % 6 == 0 else f"text {i}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 16)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        parts = fp.by_id(docs).rdd.glom().map(len).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(parts) == 3000 and max(parts) < 2 * 3000 / 16, parts
