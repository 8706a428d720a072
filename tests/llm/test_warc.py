"""Archives: round trip, record by record, with and without a dictionary."""

import hashlib
import io
import os
import struct

import pytest
import zstandard

from farelake.llm import warc
from farelake.session import scratch_path


def rows():
    page = "<html><head><title>t</title></head><body>" + "<p>Some words of a page, again and again.</p>" * 30
    out = [(i, f"https://a.example/{i}?q=%20", page + f"<p>{i}</p></body>") for i in range(60)]
    out += [(100, "u", "same " * 300), (101, None, "same " * 300), (102, "x\r\ny z%0A", "same " * 300), (None, "n", "same " * 300)]
    out += [(103, "s", "short"), (104, "s", "short"), (105, "e", ""), (106, None, None), (102, "x\r\ny z%0A", "same " * 300)]
    out += [(None, "m", "nobody " * 300), (None, "m", "nobody " * 300), (107, "é", "é\r\n\r\nWARC/1.1\r\n\r\n" * 100), (108, "long", "x<" * 2_000_000)]
    return out


def expected(table):
    heads = {}
    for p, _, h in table:
        if p is not None:
            heads[h or ""] = max(p, heads.get(h or "", p))
    out = []
    for p, u, h in table:
        raw = (h or "").encode()
        head = heads.get(h or "") if len(raw) >= 1000 else None
        to = head if head is not None and (p is None or p < head) else None
        out.append((p, u, "revisit" if to is not None else "response", len(raw), hashlib.sha1(raw).hexdigest(), to, None if to is not None else raw))
    return sorted(out, key=str)


@pytest.mark.parametrize("file_bytes", [64 << 20, 5000])
def test_round_trip(spark, monkeypatch, file_bytes):
    monkeypatch.setattr(warc, "FILE_BYTES", file_bytes)
    pages = spark.createDataFrame([(*r, "x") for r in rows()], "page_id long, url string, html string, digest string")
    folder = scratch_path(spark, "warc-test")
    manifest = warc.archive_pages(pages, folder)
    got = warc.read_archives(manifest, folder).drop("file").collect()
    assert sorted((tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in got), key=str) == expected(rows())
    files = [r["file"] for r in manifest.collect()]
    assert sorted(files) == sorted(f for f in os.listdir(folder) if f.endswith(".zst"))
    # Any frame can be decompressed by itself with the dictionary in front.
    raw = open(f"{folder}/{files[0]}", "rb").read()
    magic, size = struct.unpack("<II", raw[:8])
    assert magic == warc.SKIPPABLE
    unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw[8:8 + size])).decompressobj()
    assert unpacker.decompress(raw[8 + size:]).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    assert unpacker.unused_data


def test_small_and_empty(spark):
    pages = spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string")
    assert [tuple(r) for r in warc.archived_and_read(pages, payloads=True).drop("file").collect()] == [
        (1, "u", "response", 1, hashlib.sha1(b"x").hexdigest(), None, bytearray(b"x"))]
    assert warc.archived_and_read(pages.where("false")).count() == 0


def test_damage_is_found():
    packer = zstandard.ZstdCompressor()
    whole = packer.compress(warc.record(1, "u", b"abc", "d", None, "now"))
    assert [b for _, b in warc.read_records(io.BytesIO(whole))][0].endswith(b"abc")
    cut = packer.compress(warc.record(1, "u", b"abc", "d", None, "now")[:-6])
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(cut)))


def test_headers_are_what_other_readers_expect(spark):
    pages = spark.createDataFrame(
        [(1, "http://a.org/x%20y?q=%C3%A9", "same " * 300), (2, "http://a.org/z", "same " * 300), (3, "http://a.org/a b\n", "x")],
        "page_id long, url string, html string")
    found = []
    for _ in range(2):
        folder = scratch_path(spark, "warc-test")
        fields = []
        for r in warc.archive_pages(pages, folder).collect():
            with open(f"{folder}/{r['file']}", "rb") as raw:
                fields += [f for f, _ in warc.read_records(raw) if f["WARC-Type"] != "warcinfo"]
        found.append({f["X-Page-ID"]: f for f in fields})
    one, two, three = (found[0][k] for k in "123")
    assert one["WARC-Target-URI"] == "http://a.org/x%20y?q=%C3%A9" and "X-Page-URL" not in one
    assert three["WARC-Target-URI"] == "http://a.org/a%20b%0A"
    assert one["WARC-Type"] == "revisit" and one["WARC-Refers-To"] == two["WARC-Record-ID"]
    assert len({f["WARC-Record-ID"] for f in found[0].values()}) == 3
    assert {k: f["WARC-Record-ID"] for k, f in found[0].items()} == {k: f["WARC-Record-ID"] for k, f in found[1].items()}
    assert not any("WARC-Concurrent-To" in f for f in found[0].values())
