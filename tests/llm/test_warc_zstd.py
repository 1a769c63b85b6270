"""Operator 9: round trip, revisits and the archive format."""

import hashlib
import struct
from collections import Counter

import pytest
import zstandard

from helpers import rows
from lotguard.llm import warc_zstd as W
from oracle_harness import compare, duck


def frame(spark, data):
    return spark.createDataFrame([(*r, "x", 2) for r in data], "page_id long, url string, html string, digest string, n int")


DATE = "2026-06-14T12:00:00Z"
BIG, OTHER = "<p>é " * 300, "y" * 1000
DATA = [(1, "http://a/1", BIG), (5, "http://a/5", BIG), (5, "http://a/5", BIG), (3, None, BIG), (7, "u\r\nX: 1", OTHER), (8, "v", "y" * 999),
        (9, "w", "y" * 999), (10, "", ""), (11, "n", None), (None, "q", BIG), (12, "http://z", "\r\n\r\nWARC/1.1\r\n" * 9), (None, "only", "z" * 2000),
        (None, "only", "z" * 2000)]


def test_round_trip(spark):
    out = rows(W.read_archives(W.write_archives(frame(spark, DATA))))
    assert len(out) == len(DATA)
    want = Counter()
    for i, u, h in DATA:
        raw = (h or "").encode()
        top = max((j for j, _, g in DATA if g == h and j is not None), default=None)
        revisit = len(raw) >= 1000 and sum(1 for d in DATA if d[2] == h) > 1 and i != top
        u = u.replace("\r", "%0D").replace("\n", "%0A") if u is not None else None
        want[i, u, "revisit" if revisit else "response", len(raw), hashlib.sha1(raw).hexdigest(), top if revisit else None, None if revisit else raw] += 1
    got = Counter((r["page_id"], r["url"], r["record_type"], r["payload_bytes"], r["payload_digest"], r["refers_to"], None if r["payload"] is None else bytes(r["payload"])) for r in out)
    assert got == want


def test_archive_format(monkeypatch):
    records = [W.record(i, f"http://h/{i}", (f"<html>{i} " + "same words " * 40).encode(), "d", False, None, W.record_id(i), None, DATE) for i in range(900)]
    data = W.compress(records)
    assert list(W.decompress(data)) == records
    magic, size = struct.unpack_from("<II", data)
    assert magic == 0x184D2A5D and data[8:12] == zstandard.ZstdCompressionDict(data[8 : 8 + size]).as_bytes()[:4]
    assert len(data) < sum(map(len, records)) / 4
    assert list(W.decompress(W.compress(records[:1]))) == records[:1]
    with pytest.raises(ValueError):
        list(W.decompress(b"\0" * 20))


def test_bounded_archives(spark, monkeypatch):
    monkeypatch.setattr(W, "ARCHIVE_BYTES", 2000)
    out = W.write_archives(frame(spark, [(i, "u", "z" * 700) for i in range(20)]).coalesce(1)).collect()
    assert len(out) >= 1 and sum(len(list(W.decompress(bytes(r["data"])))) for r in out) == 20 + len(out)


def test_empty(spark):
    assert rows(W.read_archives(W.write_archives(frame(spark, [])))) == []


def test_oracle(spark):
    d = "/root/testdata/sf0.01"
    r = compare(spark, d, "op9", W.op9_warc_zstd, W.SQL["op9_warc_zstd"], duck(d))
    assert r["schema"] and r["hash"] and r["rows"] == r["oracle_rows"], r


def test_records_are_valid(spark):
    """Mandatory fields, unique ids, references to the one response, HTTP blocks."""
    archives = W.write_archives(frame(spark, DATA), DATE).collect()
    found = []
    for a in archives:
        parsed = [W.parse(r) for r in W.decompress(bytes(a["data"]))]
        assert [f["warc-type"] for f in parsed].count("warcinfo") == 1 and parsed[0]["warc-type"] == "warcinfo"
        found += parsed
    ids = [f["warc-record-id"] for f in found]
    assert len(ids) == len(set(ids)) and {f["warc-date"] for f in found} == {DATE}
    pages = [f for f in found if f["warc-type"] != "warcinfo"]
    assert all(f["block"].startswith(b"HTTP/1.1 200 OK\r\n") and f["warc-target-uri"] for f in pages if f.get("warc-target-uri") != "")
    # the payload of two rows with the largest page_id: revisits name the page only
    assert all("warc-refers-to" not in f and f["x-refers-to-page"] == "5" for f in pages if f["warc-type"] == "revisit" and f["x-payload-length"] == str(len(BIG.encode())))
    one = [W.parse(r) for a in W.write_archives(frame(spark, [(1, "a", BIG), (4, "b", BIG), (None, "c", BIG)])).collect() for r in W.decompress(bytes(a["data"]))]
    response = [f for f in one if f["warc-type"] == "response"]
    assert [f["x-page-id"] for f in response] == ["4"] and {f["warc-refers-to"] for f in one if f["warc-type"] == "revisit"} == {response[0]["warc-record-id"]}


def test_parse_refuses_what_is_not_valid():
    good = W.record(1, "http://a", b"x", "d", False, None, W.record_id(1), None, DATE)
    assert W.parse(good)["payload"] == b"x"
    for bad in (good.replace(b"WARC-Date: " + DATE.encode() + b"\r\n", b""), good.replace(b"WARC/1.1", b"WARC/0.9"), good.replace(b"urn:uuid", b"urn:page"),
                good.replace(b"2026-06-14T", b"14.6.2026 "), good[:-4] + b"y\r\n\r\n", good.replace(b"\r\n\r\nx", b"\r\n\r\nz")):
        with pytest.raises(ValueError):
            W.parse(bad)


def test_export(spark, tmp_path):
    archives = W.write_archives(frame(spark, DATA), DATE)
    out = rows(W.export_archives(archives, str(tmp_path / "a")))
    assert out and sorted(p.name for p in (tmp_path / "a").iterdir()) == sorted(r["archive"] for r in out)
    records = []
    for r in out:
        with open(r["path"], "rb") as f:
            data = f.read()
        assert len(data) == r["bytes"]
        records += [W.parse(x) for x in W.decompress(data)]
    assert sum(f["warc-type"] != "warcinfo" for f in records) == len(DATA)
