"""WARC archives, compressed record by record with a common Zstandard dictionary.

A file starts with a skippable frame that holds the dictionary (magic number 0x184D2A5D, as in the .warc.zst
convention), then one Zstandard frame per record, so that any record can be decompressed by itself. The
dictionary is built from a bounded sample of the records to be archived: at most `SAMPLE_RECORDS` records of at
most `SAMPLE_BYTES` each. It only affects the size of the files.

Of records with equal payloads of at least `REVISIT_BYTES`, the one with the largest page_id is written as a response
and the others as revisits that name it.

Tasks write their own files, named at random, into a folder that all machines share, through pyarrow's file systems;
the manifest, written by Spark's committer, lists the files of the tasks that succeeded. A task that is run again
leaves at most an unlisted file. A file is closed after `FILE_BYTES` of records.

Edge cases: a null html is an empty payload; a null url or page_id is left out of the header and read back as null.
Rows without page_id revisit the largest page_id of their payload, and are responses if it has none. Rows that repeat
the largest page_id are all responses. Too few or too small records for a dictionary: files without one. An empty
table gives no files. Other columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib
import re
import struct
import urllib.parse
import uuid
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.llm.common import few, prepare, stored
from farelake.session import scratch_path

REVISIT_BYTES = 1000
FILE_BYTES = 64 << 20
SAMPLE_RECORDS = 400
SAMPLE_BYTES = 32 << 10
DICTIONARY_BYTES = 112 << 10
LEVEL = 3
SKIPPABLE = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Header fields of our own.
PAGE_ID, PAGE_URL, REFERS_TO_PAGE = "X-Page-ID", "X-Page-URL", "X-Refers-To-Page-ID"
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def _header(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = [f"{name}: {value}" for name, value in fields if value is not None]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + f"\r\nContent-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"


def record_id(page_id: int | None, digest: str) -> str:
    """The same for the same page and payload, so that revisits can name it and a task that runs again repeats it."""
    return f"<urn:uuid:{uuid.uuid4() if page_id is None else uuid.uuid5(uuid.NAMESPACE_OID, f'page:{page_id}:sha1:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One response record, or a revisit record if refers_to is given.

    The URI stands as it is, but for bytes that a header can't hold; a URL that has such bytes is also given whole.
    """
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    uri = None if url is None else _CONTROL.sub(lambda m: urllib.parse.quote(m[0]), url)
    return _header([
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", record_id(refers_to, digest) if revisit else None),
        (PAGE_ID, None if page_id is None else str(page_id)),
        (PAGE_URL, urllib.parse.quote(url) if uri != url else None),
        (REFERS_TO_PAGE, str(refers_to) if revisit else None),
        ("Content-Type", "application/http;msgtype=response"),
    ], http if revisit else http + payload)


def build_dictionary(samples: list[bytes]) -> bytes | None:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if len(samples) >= 8 else None
    except zstandard.ZstdError:  # too little to learn from
        return None


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def _write(batches: Iterator[pa.RecordBatch], folder: str, dictionary: bytes | None, date: str) -> Iterator[pa.RecordBatch]:
    """Writes the rows as archives; gives (file, records, raw_bytes, file_bytes) of each file."""
    store, root = _opened(folder)
    data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=data)
    out, done, name, raw, count = None, [], "", 0, 0

    def close():
        nonlocal out
        if out:
            size = out.tell()
            out.close()
            done.append((name, count, raw, size))
            out = None

    for batch in batches:
        for page_id, url, payload, digest, refers_to in zip(*(batch[c].to_pylist() for c in (
                "page_id", "url", "payload", "digest", "refers_to"))):
            if out is None:
                store.create_dir(root, recursive=True)
                name, raw, count = f"{uuid.uuid4().hex}.warc.zst", 0, 0
                out = store.open_output_stream(f"{root}/{name}", compression=None)
                if dictionary:
                    out.write(struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary)
                out.write(packer.compress(_header([
                    ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date),
                    ("WARC-Filename", name), ("Content-Type", "application/warc-fields"),
                ], b"format: WARC File Format 1.1\r\n")))
            whole = record(page_id, url, payload, digest, refers_to, date)
            out.write(packer.compress(whole))
            raw, count = raw + len(whole), count + 1
            if raw >= FILE_BYTES:
                close()
    close()
    if done:
        yield pa.record_batch(
            [pa.array(x, kind) for x, kind in zip(zip(*done), (pa.string(), pa.int64(), pa.int64(), pa.int64()))],
            names=["file", "records", "raw_bytes", "file_bytes"])


def read_records(raw) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of the records of one archive, given as a binary file, one record in memory at a time."""
    start = raw.read(8)
    data = None
    if len(start) == 8 and struct.unpack("<II", start)[0] == SKIPPABLE:
        data = zstandard.ZstdCompressionDict(raw.read(struct.unpack("<II", start)[1]))
    else:
        raw.seek(0)
    stream = zstandard.ZstdDecompressor(dict_data=data).stream_reader(raw, read_across_frames=True)
    held = b""

    def take(size: int) -> bytes:
        nonlocal held
        parts, have = [held], len(held)
        while have < size:
            piece = stream.read(max(1 << 16, size - have))
            if not piece:
                raise ValueError("an archive ends inside a record")
            parts.append(piece)
            have += len(piece)
        whole = b"".join(parts)
        held = whole[size:]
        return whole[:size]

    while True:
        while b"\r\n\r\n" not in held:
            piece = stream.read(1 << 16)
            if not piece:
                if held:
                    raise ValueError("an archive ends inside a header")
                return
            held += piece
        head = take(held.index(b"\r\n\r\n") + 4).decode()
        version, *lines = head[:-4].split("\r\n")
        if version != "WARC/1.1":
            raise ValueError(f"not a WARC record: {version!r}")
        fields = dict(line.split(": ", 1) for line in lines)
        block = take(int(fields["Content-Length"]))
        if take(4) != b"\r\n\r\n":
            raise ValueError("a record has no end")
        yield fields, block


_READ = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, file string"


def _read(batches: Iterator[pa.RecordBatch], folder: str, payloads: bool) -> Iterator[pa.RecordBatch]:
    store, root = _opened(folder)
    number = lambda value: None if value is None else int(value)
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    names = [x.split()[0] for x in _READ.split(", ")] + ["payload"]
    if not payloads:
        kinds, names = kinds[:-1], names[:-1]

    def table(rows):
        return pa.record_batch([pa.array(x, kind) for x, kind in zip(zip(*rows), kinds)], names=names)

    for batch in batches:
        for file in batch["file"].to_pylist():
            rows, held = [], 0
            with store.open_input_file(f"{root}/{file}") as raw:
                for fields, block in read_records(raw):
                    if fields["WARC-Type"] == "warcinfo":
                        continue
                    http, _, payload = block.partition(b"\r\n\r\n")
                    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    response = fields["WARC-Type"] == "response"
                    if response and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
                        raise ValueError(f"{file}: a payload isn't what its header says")
                    whole = fields.get(PAGE_URL)
                    rows.append((
                        number(fields.get(PAGE_ID)), fields.get("WARC-Target-URI") if whole is None else urllib.parse.unquote(whole, errors="strict"),
                        fields["WARC-Type"], length, digest, number(fields.get(REFERS_TO_PAGE)), file,
                        payload if response else None)[: len(names)])
                    held += len(payload) if payloads else 200
                    if held >= 8 << 20:
                        yield table(rows)
                        rows, held = [], 0
            if rows:
                yield table(rows)


def archive_pages(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Writes `pages` (page_id, url, html) as archives into `folder`; the manifest (file, records, raw_bytes, file_bytes).

    `folder` must be one that all executors can write to.
    """
    spark = prepare(pages.sparkSession)
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumns({
        "digest": F.sha1("payload"), "size": F.octet_length("payload").cast("long"), "check": F.xxhash64("payload")})
    heads = rows.where(F.col("size") >= REVISIT_BYTES).groupBy("digest", "size", "check").agg(
        F.max("page_id").alias("head"), F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies")
    heads = stored(heads, "heads")
    # A payload may be a third of all rows. Only this join meets it, and large keys of it are split.
    rows = rows.join(heads, ["digest", "size", "check"], "left").select(
        "page_id", "url", "payload", "digest",
        F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("head")), F.col("head")).alias("refers_to"))
    sample = pages.select("page_id", "url", payload.alias("payload")).where(
        (F.octet_length("payload") > 0) & (F.octet_length("payload") <= SAMPLE_BYTES))
    # Copies teach nothing new.
    sample = {bytes(r["payload"]): r for r in few(sample, SAMPLE_RECORDS, "page_id", "url")}
    dictionary = build_dictionary([
        record(r["page_id"], r["url"], payload, hashlib.sha1(payload).hexdigest(), None, date)
        for payload, r in sorted(sample.items())[:SAMPLE_RECORDS]])
    return stored(rows.mapInArrow(
        partial(_write, folder=folder, dictionary=dictionary, date=date),
        "file string, records long, raw_bytes long, file_bytes long"), "manifest")


def read_archives(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the listed files, with each response's payload checked against its digest.

    (page_id, url, record_type, payload_bytes, payload_digest, refers_to, file, payload); payload is null for revisits
    and missing without `payloads`.
    """
    files = manifest.select("file").repartition(max(1, manifest.count()), "file")
    return files.mapInArrow(partial(_read, folder=folder, payloads=payloads), _READ + ", payload binary" * payloads)


def archived_and_read(pages: DataFrame, payloads: bool = False) -> DataFrame:
    """`pages` through archives in a fresh folder of the shared scratch area."""
    folder = scratch_path(pages.sparkSession, "warc")
    return read_archives(archive_pages(pages, folder), folder, payloads)
