"""Line dedup against its SQL and a brute-force version."""

import hashlib

import numpy as np
import pytest

from airlake.llm import line_dedup

STRIP = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(STRIP))


def brute(rows):
    holders = {}
    for i, t in rows:
        if i is not None:
            for line in (t or "").split("\n"):
                if len(key(line)) >= 10:
                    holders.setdefault(key(line), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


COMMON = "All rights reserved by nobody."
ROWS = [
    (1, f"alpha line number one\n  {COMMON}\t\nshort\nshort"),
    (2, f"{COMMON.upper()}\nown line of document two\nown line of document two\nshort"),
    (3, f"{COMMON}\n{COMMON}\n\n"),
    (4, None),
    (5, ""),
    (6, "ünïcödé lïne ÄÖ\r\n\x0b tab line here \x0c"),
    (7, "ÜNÏCÖDÉ LÏNE ÄÖ\nünïcödé lïne ÄÖ\ntab LINE here"),
    (8, "日本語日本語日本語日\n日本語日本語日本語日"),
    (9, "日本語日本語日本語日\nnine char"),
    (9, "日本語日本語日本語日\nnine char"),
    (None, f"{COMMON}\nnot counted anywhere"),
    (12, "not counted anywhere\n" + "very long line " * 20_000 + "\n" + COMMON),
    (13, "very long line " * 20_000),
]


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, t, 0, "x", 3) for i, t in rows], "doc_id long, text string, n_lines int, key string, _keep int"
    )


@pytest.mark.parametrize("bits", [line_dedup.MIN_BITS, line_dedup.SEGMENT_BITS])
def test_equals_brute_force(spark, monkeypatch, bits):
    monkeypatch.setattr(line_dedup, "MIN_BITS", line_dedup.SEGMENT_BITS)
    monkeypatch.setattr(line_dedup, "MAX_BITS", bits)
    rows = ROWS + [(100 + i, f"{COMMON}\nshared by pairs {i // 2}\nonly in {i}, nowhere else") for i in range(60)]
    done = line_dedup.dedup_lines(frame(spark, rows).repartition(5))
    assert sorted(done.columns) == sorted(["doc_id", "text", "key", "_keep", "n_lines", "n_dropped"])
    got = sorted(map(tuple, done.select("doc_id", "n_lines", "n_dropped", "text").collect()), key=str)
    assert got == sorted(brute(rows), key=str)


def test_digest_equals_brute_force_and_sql(spark):
    import duckdb
    import pyarrow as pa

    rows = [r for r in ROWS if r[0] not in (None, 9)]
    got = sorted(map(tuple, line_dedup.line_digest(frame(spark, rows)).collect()))
    want = sorted((i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute(rows))
    assert got == want
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]}))
    assert sorted(con.execute(line_dedup.LINE_DIGEST_SQL).fetchall()) == want


def test_extra_columns_keep_their_names_and_values(spark):
    names = ["_row_key", "_row", "_drop", "_kept", "row", "drop", "kept", "others", "key", "first", "a.b"]
    rows = [(1, f"{COMMON}\none"), (2, f"{COMMON}\ntwo"), (None, COMMON)]
    fields = ", ".join(f"`{n}` string" for n in names)
    docs = spark.createDataFrame([(*names, i, t) for i, t in rows], f"{fields}, doc_id long, text string")
    done = line_dedup.dedup_lines(docs)
    assert done.columns == [*docs.columns, "n_lines", "n_dropped"]
    got = {r.doc_id: tuple(r) for r in done.collect()}
    assert got == {
        1: (*names, 1, rows[0][1], 2, 0), 2: (*names, 2, "two", 2, 1), None: (*names, None, COMMON, 1, 0),
    }


def test_empty_table_and_tables_without_text(spark):
    assert line_dedup.line_digest(frame(spark, [])).collect() == []
    got = line_dedup.dedup_lines(frame(spark, [(1, None), (None, None), (2, "")])).collect()
    assert [(r.text, r.n_lines, r.n_dropped) for r in got] == [("", 1, 0)] * 3


def test_a_crowded_filter_still_holds_every_repeat():
    """Filters far too small for their lines only suspect more."""
    rng = np.random.default_rng(1)
    filters = line_dedup.TwoFilters(line_dedup.SEGMENT_BITS)
    hashes = rng.integers(0, 2**63, 50_000, dtype=np.uint64)
    filters.add(hashes)
    filters.add(hashes[:1000])
    at = line_dedup.bit_positions(hashes[:1000], line_dedup.SEGMENT_BITS)
    assert (filters.cells[at] & 2).all()


def test_sparse_and_dense_segments_come_back():
    for share in (0.001, 0.5):
        cells = (np.random.default_rng(2).random(line_dedup.SEGMENT_BITS) < share).astype(np.uint8)
        assert (line_dedup._unpacked(line_dedup._packed(cells)) == cells.astype(bool)).all()


def test_rows_of_one_id_gather_their_own_keys_only(spark, monkeypatch):
    """An id with many texts: no row is handed more keys than its text has."""
    most = spark.sparkContext.accumulator(0)
    add_columns = line_dedup.add_columns

    def watched(df, fields, make):
        sizes = [len(r[0]) for r in df.where("_drop is not null").select("_drop").collect()]
        most.add(max(sizes))
        return add_columns(df, fields, make)

    monkeypatch.setattr(line_dedup, "add_columns", watched)
    rows = [(1, "\n".join(f"a shared line, number {i}" for i in range(80)))]
    rows += [(7, f"a shared line, number {i}\nkept line of text {i}") for i in range(80)] + [(8, "a shared line, number 3")]
    done = line_dedup.dedup_lines(frame(spark, rows).repartition(5))
    got = sorted(map(tuple, done.select("doc_id", "n_lines", "n_dropped", "text").collect()), key=str)
    assert got == sorted(brute(rows), key=str) and most.value == 1
