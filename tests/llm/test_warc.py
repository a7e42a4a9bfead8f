"""WARC: plain-Python expectation, full payloads, broken archives, repeated and hot pages."""

import base64
import gzip
import hashlib
import io
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabforge.llm import warc

SCHEMA = "page_id long, url string, html string, payload binary, archive string"
ROWS = [
    (1, "http://a/1", "<p>one</p>", b"x", "y"), (2, None, None, None, None), (3, "http://a/3", "", None, None),
    (4, "http://a/4\r\nWARC-Type: evil", "<p>one</p>", None, None), (None, "u", "<p>one</p>", None, None),
    (5, "u", "été \U0001f600 \r\n\r\nWARC/1.1\r\n\r\n" * 50_000, None, None), (7, "u", "same", None, None),
    (7, "u", "same", None, None), (7, "u", "same", None, None), (None, None, "nobody", None, None), (None, "v", "nobody", None, None),
]


def b32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def expected(rows, least=0):
    groups = {}
    for r in rows:
        groups.setdefault((r[2] or "").encode(), []).append(r[0])
    out = Counter()
    for data, ids in groups.items():
        order = sorted(ids, key=lambda x: (x is not None, x))
        for k, page in enumerate(order):
            revisit = len(data) >= least and k < len(order) - 1
            out[(page, len(data), b32(data), "revisit" if revisit else "response", order[-1] if revisit else None)] += 1
    return out


@pytest.mark.parametrize("least,hot,small", [(0, 0.001, 100_000), (0, 0.3, 0), (5, 1.0, 0)])
def test_round_trip(spark, least, hot, small):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    manifest = warc.write_archives(warc.decide(df, least, hot, small), archive_bytes=300)
    rows = warc.read_warc(manifest, with_payload=True).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows) == expected(ROWS, least)
    kept = {r.record_id: r for r in rows}
    assert len(kept) == len(rows) and len({r.archive for r in rows}) > 3  # rolled over
    for r in rows:
        if r.record_type == "response":
            assert b32(r.payload) == r.payload_digest and len(r.payload) == r.payload_bytes
        else:
            there = kept[r.refers_to_id]
            assert there.record_type == "response" and there.payload_digest == r.payload_digest and r.payload is None
            assert there.page_id == r.refers_to
    urls = {(r.page_id, r.target_uri) for r in rows}
    assert (4, "http://a/4%0D%0AWARC-Type: evil") in urls and (2, None) in urls


def test_table_and_empty(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = Counter(tuple(r)[:5] for r in warc.round_trip(df.unionByName(df.limit(40))).collect())
    rows = [tuple(r) for r in df.collect()]
    assert sum(got.values()) == len(rows) + 40
    assert got == expected(rows + [tuple(r) for r in df.limit(40).collect()])
    assert warc.round_trip(df.where("false")).collect() == []


def test_any_gzip_reader_sees_the_records(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    for row in warc.write_archives(warc.decide(df)).collect():
        files, path = warc._files(row.archive)
        raw = files.open_input_stream(path, compression=None).read()
        assert len(raw) == row.bytes and gzip.decompress(raw).count(b"WARC/1.1\r\nWARC-Type: ") == row.n_records


def archive(n=3):
    parts = [warc.member(warc.build_record(i, i, "u", b"payload %d " % i * 400)) for i in range(n)]
    return parts, b"".join(parts)


def test_offsets_begin_members():
    parts, raw = archive()
    got = list(warc.read_archive(io.BytesIO(raw), "x"))
    assert [r["offset"] for r in got] == [0, len(parts[0]), len(parts[0]) + len(parts[1])]
    again = list(warc.read_archive(io.BytesIO(raw[got[1]["offset"]:]), "x"))
    assert [r["page_id"] for r in again] == [1, 2]


@pytest.mark.parametrize("change,says", [
    (lambda r: r[:-9], "ends within"),
    (lambda r: warc.member(warc.build_record(1, 1, "u", b"abc").replace(b"abc", b"abd")), "digest differs"),
    (lambda r: warc.member(warc.build_record(1, 1, "u", b"abc") + b"more"), "longer than"),
    (lambda r: warc.member(warc.build_record(1, 1, "u", b"abc")[:-6]), "shorter than|longer than"),
    (lambda r: warc.member(b"no record\r\n\r\n"), "version line"),
    (lambda r: r[:60] + bytes([r[60] ^ 255]) + r[61:], "at 0"),
    (lambda r: r + b"trailing text", "at "),
])
def test_broken_archives_are_refused(change, says):
    with pytest.raises(warc.BadArchive, match=says):
        list(warc.read_archive(io.BytesIO(change(archive(1)[1])), "x"))


def test_payload_digest_is_checked_apart_from_the_block():
    good = warc.build_record(1, 1, "u", b"abc")
    bad = good.replace(warc.sha1_base32(b"abc").encode(), warc.sha1_base32(b"abd").encode())
    with pytest.raises(warc.BadArchive, match="payload digest"):
        list(warc.read_archive(io.BytesIO(warc.member(bad)), "x"))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=3000), max_size=6), st.integers(1, 400))
def test_read_in_parts(payloads, chunk):
    raw = b"".join(warc.member(warc.build_record(i, None, None, p)) for i, p in enumerate(payloads))

    class Drip(io.BytesIO):
        def read(self, n=-1):
            return super().read(min(n, chunk))

    got = list(warc.read_archive(Drip(raw), "x", with_payload=True))
    assert [r["payload"] for r in got] == payloads
