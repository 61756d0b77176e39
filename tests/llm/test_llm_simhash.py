"""SimHash: fingerprints, bit-sliced comparison and components by brute force."""

import re

import numpy as np
import pytest
import xxhash

from airlake.llm import simhash
from airlake.llm.components import connected_components


def plain_print(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    n = max(1, len(words) - k + 1)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def plain_roots(values, radius):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def noisy(n, seed, flips=7):
    rng = np.random.default_rng(seed)
    out = set()
    for base in rng.integers(0, 2**63, n, dtype=np.uint64):
        for k in range(flips):
            out.add(int(base) ^ sum(1 << int(b) for b in rng.choice(64, k, replace=False)))
    return sorted(out, key=lambda v: hash((v, seed)))


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 6])
def test_bit_sliced_comparison_finds_every_close_pair(radius):
    values = np.array(noisy(30, radius), dtype=np.uint64)
    query, word, bits = simhash.close_blocks(values, simhash.bit_planes(values), radius)
    hits = np.unpackbits(bits.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    row, bit = np.nonzero(hits)
    got = {(int(q), int(j)) for q, j in zip(query[row], word[row] * 64 + bit, strict=True) if j < len(values)}
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= radius
    assert got == set(zip(*(x.tolist() for x in np.nonzero(near)), strict=True))


def test_forests_connect_what_is_linked():
    values = np.array(noisy(40, 9), dtype=np.uint64)
    at = {int(v): i for i, v in enumerate(values)}
    want = plain_roots([int(v) for v in values], 4)
    left, right = values[:100], values[100:]
    edges = simhash.forest(left, None, 4) + simhash.forest(right, None, 4) + simhash.forest(left, right, 4)
    parent = list(range(len(values)))
    for a, b in edges:
        a, b = parent[at[int(a)]], parent[at[int(b)]]
        parent = [min(a, b) if p in (a, b) else p for p in parent]
    assert parent == want


@pytest.mark.parametrize("cell_rows", [1024, 8])
@pytest.mark.parametrize("blocks", [5, 6, 8])
def test_components_equal_brute_force(spark, monkeypatch, cell_rows, blocks):
    monkeypatch.setattr(simhash, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(simhash, "block_count", lambda rows, radius: blocks)
    values = noisy(25, 11) + [0, 1, (1 << 64) - 1, 1 << 63] + [15 << (4 * i) for i in range(8)]
    values = list(dict.fromkeys(values))
    rows = [(1000 - i, v - (1 << 64) if v >> 63 else v) for i, v in enumerate(values)] + [(5, 0), (5, 0), (None, 0)]
    prints = spark.createDataFrame(rows, "doc_id long, fp long")
    got = {r.fp & ((1 << 64) - 1): r.component_id for r in simhash.components(prints, 4).collect()}
    roots = plain_roots(values, 4)
    ids = {}
    for (i, v) in rows:
        if i is not None:
            root = roots[values.index(v & ((1 << 64) - 1))]
            ids[root] = min(i, ids.get(root, i))
    assert got == {v: ids[roots[k]] for k, v in enumerate(values)}


BASE = "the quick brown fox jumps over the lazy dog while seven other foxes sleep in the warm sun today " * 30
ROWS = [
    (10, BASE), (11, BASE.upper()), (12, BASE + "and one more"), (13, None), (14, ""), (15, " \t\x0b\n"), (16, "One two"),
    (17, "one\ttwo"), (18, "one two"), (18, "one two"), (None, BASE), (20, "z " * 100_000), (21, "ÄÖÜ ß x y z"),
    (22, "something else entirely with words nobody repeats"),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, fp int, component_id string")


def test_near_duplicates_equal_brute_force(spark):
    out = simhash.near_duplicates(frame(spark, ROWS).repartition(3))
    assert out.columns == ["doc_id", "fingerprint", "component_id"]
    prints = [plain_print(t) for _, t in ROWS]
    roots = plain_roots(prints, 4)
    want = []
    for (i, _), p, r in zip(ROWS, prints, roots, strict=True):
        want.append((i, f"{p:016x}", min(x for (x, _), s in zip(ROWS, roots, strict=True) if s == r and x is not None)))
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)


def test_one_row_of_each_group_stays(spark):
    docs = frame(spark, ROWS)
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    groups = {r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(groups)


def test_repeated_ids_leave_one_row_of_each_group(spark):
    rows = [(1, BASE), (1, BASE), (1, BASE + "x"), (2, BASE), (3, "other words in here"), (3, "something very different again")]
    kept = sorted(r.doc_id for r in simhash.one_per_group(frame(spark, rows)).collect())
    assert kept == [1, 3, 3]


def test_extra_columns_keep_their_names_and_values(spark):
    names = ["key", "row", "rows", "doc", "head", "fp", "root", "_key", "_doc", "component_id", "fingerprint"]
    rows = [(1, BASE), (2, BASE), (3, "other words in here"), (3, "other words in here")]
    fields = ", ".join(f"{n} string" for n in names)
    docs = spark.createDataFrame([(i, t, *names) for i, t in rows], f"doc_id long, text string, {fields}")
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(tuple(r)[:2] + tuple(r)[2:] for r in kept.collect()) == [(i, t, *names) for i, t in (rows[0], rows[2])]


def test_components_end_only_when_no_edge_changes(spark):
    """Rounds that keep the number of edges go on: a long path in an awkward order."""
    path = [(i * 37 % 101, (i + 1) * 37 % 101) for i in range(100)]
    edges = spark.createDataFrame(path + [(500, 400), (400, 300)], "u long, v long")
    found = {r.node: r.root for r in simhash.connected_components(edges).collect()}
    assert found == {i: 0 for i in range(101)} | {300: 300, 400: 300, 500: 300}


def test_empty_table_and_only_null_ids(spark):
    assert simhash.near_duplicates(frame(spark, [])).collect() == []
    assert simhash.one_per_group(frame(spark, [])).collect() == []
    (row,) = simhash.near_duplicates(frame(spark, [(None, "a b")])).collect()
    assert row.component_id is None


def test_more_rows_take_more_blocks():
    picked = [simhash.block_count(n, 4) for n in (10, 10**5, 10**7, 10**9, 10**11)]
    assert picked[0] == 5 and picked == sorted(picked) and picked[-1] > 5


def test_connected_components_of_long_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(200)] + [(1000, j) for j in range(1001, 1100)] + [(5000, 5000), (7, 3)]
    links = spark.createDataFrame(pairs, "u long, v long")
    got = {r.node: r.root for r in connected_components(links).collect()}
    assert all(got[i] == 0 for i in range(201)) and all(got[j] == 1000 for j in range(1000, 1100))
    assert 5000 not in got
