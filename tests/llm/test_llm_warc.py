"""WARC bundles: exact round trips, revisits, and random access."""

import hashlib

import pytest
import zstandard

from airlake.llm import warc
from airlake.llm.common import shared_path

LONG = "<p>öäü</p>" * 200
ROWS = [
    (1, "http://a/1", LONG),
    (2, "http://a/2", LONG),
    (3, None, None),
    (4, "http://a/4\r\nWARC-Type: fake", ""),
    (5, "http://a/5", "short"),
    (6, "http://a/6", "short"),
    (7, "http://a/7", "x" * 999),
    (8, "http://a/8", "x" * 999),
    (9, "http://a/9", "x" * 1000),
    (10, "http://a/10", "x" * 1000),
    (10, "http://a/10b", "x" * 1000),
    (None, "http://a/none", "x" * 1000),
    (None, "http://a/none", "y" * 1000),
    (11, "http://a/11", "\r\n\r\nWARC/1.1\r\n\r\n" * 100),
    (12, "http://a/12", "long " * 300_000),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "extra", 1) for r in rows], "page_id long, url string, html string, payload string, keep int")


def expected(rows):
    groups = {}
    for i, _, h in rows:
        data = (h or "").encode()
        if len(data) >= 1000 and i is not None:
            groups[data] = max(i, groups.get(data, i))
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        keep = groups.get(data, i)
        revisit = keep is not None and keep != i
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", keep if revisit else None))
    return sorted(out, key=str)


def test_archives_give_back_what_was_written(spark):
    got = warc.archive_digest(frame(spark, ROWS).repartition(3))
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(ROWS)


def test_equals_the_sql(spark):
    import duckdb
    import pyarrow as pa

    rows = [r for r in ROWS if r[0] is not None and r[1] != "http://a/10b"]
    con = duckdb.connect()
    con.register("pages", pa.table({"page_id": [r[0] for r in rows], "html": [r[2] for r in rows]}))
    assert sorted(con.execute(warc.ARCHIVE_DIGEST_SQL).fetchall(), key=str) == expected(rows)


def test_payloads_and_random_access(spark):
    index = warc.write_archives(frame(spark, ROWS), shared_path(spark, "warc-test"))
    assert index.count() == len(ROWS)
    rows = {(r.page_id, r.record_type): r for r in warc.read_archives(index).collect()}
    assert rows[12, "response"].payload == (ROWS[-1][2]).encode()
    assert rows[9, "revisit"].payload is None
    (one,) = warc.read_record(spark, index, 11)
    assert one["payload"] == ROWS[-2][2].encode() and one["refers_to"] is None
    (two,) = warc.read_record(spark, index, 1)
    assert two["record_type"] == "revisit" and two["refers_to"] == 2 and two["payload_bytes"] == len(LONG.encode())
    assert warc.read_record(spark, index, 404) == []


def test_bundles_are_plain_zstandard_with_a_seek_table(spark, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 3000)  # several frames whatever the order of the rows
    index = warc.write_archives(frame(spark, ROWS).coalesce(1), shared_path(spark, "warc-test"))
    path = index.first().bundle.removeprefix("file:")
    with open(path, "rb") as f:
        data = f.read()
    reader = warc.BundleReader(path)
    assert sum(p for p, _ in reader.sizes) + 8 + 8 * len(reader.sizes) + 9 == len(data)
    # a reader that knows nothing of the seek table reads all frames
    plain = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert plain.count(b"WARC/1.1\r\nWARC-Type: ") == len(ROWS) and b"\r\nWARC-Type: fake" not in plain
    assert len(reader.sizes) > 2 and len(plain) == sum(n for _, n in reader.sizes)


def test_a_file_without_seek_table_is_refused(tmp_path):
    (tmp_path / "x.warc.zst").write_bytes(b"no archive at all")
    with pytest.raises(ValueError):
        warc.BundleReader(str(tmp_path / "x.warc.zst"))


def test_a_damaged_payload_is_found():
    record = warc.warc_record(1, "http://a", b"abc", hashlib.sha1(b"abc").hexdigest(), None, False)
    assert warc.parse_record(record)["payload"] == b"abc"
    with pytest.raises(ValueError):
        warc.parse_record(record.replace(b"abc\r\n\r\n", b"abd\r\n\r\n"))


def test_empty_table(spark):
    assert warc.archive_digest(frame(spark, [])).collect() == []
