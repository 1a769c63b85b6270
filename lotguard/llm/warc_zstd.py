"""Dictionary-compressed WARC archives (operator 9).

Pages become WARC/1.1 records: a `response` holds the payload; of payloads of
1000 bytes or more that several pages share, the page with the largest id holds
it and the others are `revisit` records that name it. A record has all fields
that the format demands (type, a record id of its own, date, content length),
target and content type; its block is an HTTP message, whose body is the payload
(a revisit's has none). Pages' ids are kept in fields of their own. Records are
dealt to archives of bounded size. An archive is one byte string, a valid
Zstandard file: a leading skippable frame with the dictionary (built from the
first records of that archive), then one frame for a warcinfo record and for
each record, compressed by itself with that dictionary, so that a record can
be read from its offset.

Archives are written as a table (archive, data) below the shared checkpoint
folder, since tasks have no common file system but Spark's; each ``data`` is
the file's content, and carries all that reading needs. ``export_archives``
writes them as files to a folder that the tasks can reach.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotguard.llm.common import small_batches, table, written

#: Payloads from this size on are stored once.
REVISIT_BYTES = 1000
#: An archive's uncompressed bytes, those its dictionary is built from at most,
#: and the dictionary's size.
ARCHIVE_BYTES, SAMPLE_BYTES, DICTIONARY_BYTES = 32 << 20, 4 << 20, 64 << 10
#: Fixed values of the .warc.zst format: the magic number of the skippable frame.
SKIPPABLE = 0x184D2A5D
_END = b"\r\n\r\n"
_BREAKS = re.compile(r"[\r\n]")


def record_id(*of: object) -> str:
    """A record id that follows from what it is for."""
    return f"<urn:uuid:{uuid.UUID(hashlib.md5(repr(of).encode()).hexdigest())}>"


def _joined(lines: list[str], block: bytes) -> bytes:
    digest = f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}"
    return "\r\n".join(["WARC/1.1", *lines, digest, f"Content-Length: {len(block)}"]).encode() + _END + block + _END


def info_record(date: str, of: str) -> bytes:
    """The warcinfo record of an archive."""
    block = b"software: archives with a leading dictionary frame\r\nformat: WARC File Format 1.1\r\n"
    return _joined(["WARC-Type: warcinfo", f"WARC-Record-ID: {record_id('info', of)}", f"WARC-Date: {date}", "Content-Type: application/warc-fields"], block)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, revisit: bool, refers_to: int | None, name: str, target: str | None, date: str) -> bytes:
    """A WARC record with the id ``name``; ``target`` is the record id of what
    a revisit refers to (None where several records could be meant). A null
    page id is left out, an unknown address named by the record; line breaks in
    an address are percent-encoded."""
    kind = "revisit" if revisit else "response"
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: {name}", f"WARC-Date: {date}", "Content-Type: application/http; msgtype=response"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}"]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if url is not None:
        lines.append("WARC-Target-URI: " + _BREAKS.sub(lambda m: f"%{ord(m[0]):02X}", url))
    else:
        lines += [f"WARC-Target-URI: {name[1:-1]}", "X-Target: unknown"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        if target is not None:
            lines.append(f"WARC-Refers-To: {target}")
        if refers_to is not None:
            lines.append(f"X-Refers-To-Page: {refers_to}")
    return _joined(lines, http if revisit else http + payload)


_NEEDED = ("warc-type", "warc-record-id", "warc-date", "content-length", "content-type", "warc-block-digest")
_DATE = re.compile(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ")
_NAME = re.compile(r"<urn:uuid:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}>")


def parse(data: bytes) -> dict:
    """Header fields (lower case) of a record, its block, and the payload of a
    response. What the format demands is checked."""
    head, _, rest = data.partition(_END)
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC/1.1 record")
    fields = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines[1:])}
    if lacking := [f for f in _NEEDED if f not in fields]:
        raise ValueError(f"no {', '.join(lacking)} in a record")
    size = int(fields["content-length"])
    block = rest[:size]
    if rest[size:] != _END or not _DATE.fullmatch(fields["warc-date"]) or not _NAME.fullmatch(fields["warc-record-id"]):
        raise ValueError("a record's length, date or id is wrong")
    if fields["warc-block-digest"] != f"sha1:{hashlib.sha1(block).hexdigest()}":
        raise ValueError("a block differs from its digest")
    payload = block.partition(_END)[2] if fields["warc-type"] == "response" else None
    return {**fields, "block": block, "payload": payload}


def compress(records: list[bytes]) -> bytes:
    """An archive of the records."""
    sample, size = [], 0
    for r in records:
        if size >= SAMPLE_BYTES:
            break
        sample.append(r[: SAMPLE_BYTES - size])
        size += len(sample[-1])
    try:
        dictionary = zstandard.train_dictionary(DICTIONARY_BYTES, sample).as_bytes()
    except zstandard.ZstdError:  # too few or too small records: their text itself
        dictionary = b"".join(sample)[-DICTIONARY_BYTES:]
    shared = zstandard.ZstdCompressionDict(dictionary)
    shared.precompute_compress(level=3)
    writer = zstandard.ZstdCompressor(dict_data=shared, write_content_size=True)
    return struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary + b"".join(writer.compress(r) for r in records)


def decompress(data: bytes) -> Iterator[bytes]:
    """The records of an archive, one at a time."""
    magic, size = struct.unpack_from("<II", data)
    if magic != SKIPPABLE:
        raise ValueError("no leading dictionary frame")
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size]))
    rest = memoryview(data)[8 + size :]
    while len(rest):
        frame = reader.decompressobj()
        out = frame.decompress(rest)
        left = len(frame.unused_data)
        yield out
        rest = rest[len(rest) - left :] if left else rest[:0]


def _archives(date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _archive_rows(batches, date)

    return run


def _archive_rows(batches: Iterator[pa.RecordBatch], date: str) -> Iterator[pa.RecordBatch]:
    held: list[bytes] = []
    size, place, task = 0, 0, TaskContext.get().partitionId()

    def close() -> pa.RecordBatch:
        nonlocal held, size
        data = compress([info_record(date, hashlib.sha1(b"".join(held)).hexdigest()), *held])
        out = pa.record_batch([pa.array([f"pages-{hashlib.sha1(data).hexdigest()}.warc.zst"]), pa.array([data], pa.binary())], names=["archive", "data"])
        held, size = [], 0
        return out

    for batch in small_batches(batches, "payload", 4 << 20):
        for r in batch.to_pylist():
            # the record that others refer to is named by what they know of it
            name = record_id("payload", r["digest"]) if r["named"] else record_id("record", task, place)
            place += 1
            target = record_id("payload", r["digest"]) if r["revisit"] and r["single"] else None
            one = record(r["page_id"], r["url"], r["payload"], r["digest"], r["revisit"], r["refers_to"], name, target, date)
            if held and size + len(one) > ARCHIVE_BYTES:
                yield close()
            held.append(one)
            size += len(one)
    if held:
        yield close()


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def page(field: str | None) -> int | None:
        return int(field) if field else None

    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    for batch in batches:
        for data in batch.column("data"):
            rows, size = [], 0
            for raw in decompress(data.as_py()):
                f = parse(raw)
                if f["warc-type"] == "warcinfo":
                    continue
                digest, block = f["warc-payload-digest"].removeprefix("sha1:"), f["payload"]
                if block is not None and (hashlib.sha1(block).hexdigest() != digest or len(block) != int(f["x-payload-length"])):
                    raise ValueError("a payload differs from its digest")
                url = None if "x-target" in f else f["warc-target-uri"]
                rows.append((page(f.get("x-page-id")), url, f["warc-type"], int(f["x-payload-length"]), digest, page(f.get("x-refers-to-page")), block))
                size += len(raw)
                if size > 4 << 20:
                    yield pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)
                    rows, size = [], 0
            if rows:
                yield pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def write_archives(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """The archives (archive, data) of pages (page_id, url, html), all captured
    at ``date``.

    Null html counts as empty, a null page_id as the smallest; rows that share
    the largest page_id of a payload are all responses. Further columns are
    left out. An empty table gives no archive.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.cast("binary").alias("payload"), F.octet_length(html).alias("n"), F.sha1(html.cast("binary")).alias("digest"))
    keep = rows.filter(F.col("n") >= REVISIT_BYTES).groupBy("digest", "n").agg(F.count("*").alias("rows"), F.max("page_id").alias("keeper")).filter("rows > 1")
    # rows that have the largest page_id: of several, none is the one that is meant
    top = rows.select("digest", "n", "page_id").join(keep, ["digest", "n"]).filter("page_id = keeper").groupBy("digest", "n").agg(F.count("*").alias("tops"))
    keep = keep.join(top, ["digest", "n"], "left").select("digest", "n", "keeper", (F.col("tops") == 1).alias("single"), F.lit(True).alias("shared"))
    both = rows.join(written(keep, "payloads"), ["digest", "n"], "left")
    shared, single = (F.coalesce(c, F.lit(False)) for c in ("shared", "single"))
    revisit = shared & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    both = both.select("page_id", "url", "payload", "digest", revisit.alias("revisit"), F.when(revisit, F.col("keeper")).alias("refers_to"),
                       single.alias("single"), (shared & ~revisit & single).alias("named"))
    return both.mapInArrow(_archives(date), "archive string, data binary")


def export_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Write each archive as a file of its own below ``folder``, an address that
    the tasks can reach (a mounted path, or what pyarrow's file systems know):
    (archive, path, bytes). A file appears whole, by a rename; its name follows
    from its content, so that a task that runs again writes the same file."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
        system.create_dir(root, recursive=True)
        for batch in batches:
            paths, sizes = [], []
            for name, data in zip(batch.column("archive").to_pylist(), batch.column("data"), strict=True):
                path, part = f"{root.rstrip('/')}/{name}", f"{root.rstrip('/')}/.{name}.{uuid.uuid4().hex}"
                with system.open_output_stream(part) as out:
                    out.write(data.as_buffer())
                system.move(part, path)
                paths.append(path)
                sizes.append(data.as_buffer().size)
            yield pa.record_batch([batch.column("archive"), pa.array(paths), pa.array(sizes, pa.int64())], names=["archive", "path", "bytes"])

    return archives.select("archive", "data").mapInArrow(write, "archive string, path string, bytes long")


def read_archives(archives: DataFrame) -> DataFrame:
    """The records of archives: page_id, url, record_type, payload_bytes,
    payload_digest, refers_to, payload (null for revisits)."""
    kind = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
    return archives.select("data").mapInArrow(_records, kind)


def op9_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = written(write_archives(table(spark, sf_dir, "pages")), "archives")
    return read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {"op9_warc_zstd": op9_warc_zstd}

SQL = {
    "op9_warc_zstd": f"""
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS digest FROM pages
        ), k AS (
            SELECT digest, max(page_id) AS keeper FROM p WHERE n >= {REVISIT_BYTES} GROUP BY digest
        )
        SELECT p.page_id, p.n::BIGINT AS payload_bytes, p.digest AS payload_digest,
               CASE WHEN k.digest IS NULL OR p.page_id IS NOT DISTINCT FROM k.keeper THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN k.digest IS NULL OR p.page_id IS NOT DISTINCT FROM k.keeper THEN NULL ELSE k.keeper END AS refers_to
        FROM p LEFT JOIN k ON p.digest = k.digest AND p.n >= {REVISIT_BYTES}
    """
}
