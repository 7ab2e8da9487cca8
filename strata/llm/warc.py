"""WARC archives: write, normalise monolithic gzip files, read back by offset index.

``write_archives`` writes one gzip stream per archive over all its records, which is the
layout the normaliser exists for.  ``normalise_archives`` inflates each such stream once,
front to back, rewrites every record as its own gzip member and writes a sidecar index
(offset and length of each member).  ``read_indexed`` then opens single members at their
offsets.  Archives live in the shared scratch folder; they are reached through
``pyarrow.fs``, so the folder may be local, HDFS or an object store.  Every task attempt
writes names of its own and only the attempt whose rows Spark keeps is listed in the
manifest, so a lost executor or a speculative twin leaves at most an unlisted file.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import record_batch, stage
from strata.session import new_scratch

#: An archive is closed once it holds this many payload bytes (a longer record fits whole).
ARCHIVE_BYTES = 16_000_000
CHUNK = 1 << 20

# Fixed values of the WARC format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = pa.schema([("archive", pa.string()), ("records", pa.int64())])
INDEX = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
                    ("payload", pa.binary())])


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder named as Spark names it (``file:/x``, ``s3a://b/x``, ``hdfs://…``)."""
    if uri.startswith("s3a://"):
        uri = "s3://" + uri.removeprefix("s3a://")
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def header_value(value: str) -> str:
    """Header lines can't hold line ends; anything outside printable ASCII is percent-encoded."""
    from urllib.parse import quote

    return quote(value, safe="".join(map(chr, range(33, 127))).replace("%", ""))


def render(page_id, url, payload: bytes, sha: str, refers_to, revisit: bool) -> bytes:
    """One record.  A revisit has no block; it names its response and the full length."""
    block = b"" if revisit else payload
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Payload-Digest": f"sha1:{sha}",
        "X-Payload-Length": str(len(payload)),
        "Content-Type": "text/html; charset=utf-8",
    }
    if url is not None:
        head["WARC-Target-URI"] = header_value(url)
    if revisit:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<urn:page:{refers_to}>"}
    head["Content-Length"] = str(len(block))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return VERSION + b"\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_head(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def split_records(blocks: Iterator[bytes]) -> Iterator[bytes]:
    """The records of an inflated stream, each whole, holding one record at a time."""
    buffer = bytearray()
    need = None
    for block in blocks:
        buffer += block
        while True:
            if need is None:
                end = buffer.find(b"\r\n\r\n")
                if end < 0:
                    break
                need = end + 8 + int(parse_head(bytes(buffer[:end]))["content-length"])
            if len(buffer) < need:
                break
            yield bytes(buffer[:need])
            del buffer[:need]
            need = None
    if buffer:
        raise ValueError("the archive ends within a record")


def inflate(source) -> Iterator[bytes]:
    """A gzip file of one or more members, in blocks; a cut-off file is an error."""
    z, begun = zlib.decompressobj(31), False
    while data := source.read(CHUNK):
        while data:
            begun = True
            yield z.decompress(data)
            data = z.unused_data
            if z.eof:
                z, begun = zlib.decompressobj(31), False
    if begun:
        raise ValueError("the gzip stream is cut off")


def plan_records(pages: DataFrame, page_id: str = "page_id", html: str = "html", url: str = "url",
                 least: int = 0) -> DataFrame:
    """pages + payload digest and the response each record refers to.

    Digests are counted with map-side partial sums, so a payload that a third of the
    pages share is one row per task; only digests that occur twice are joined back, and
    both sides of that join are staged tables, so Spark can split a hot digest.
    """
    has_url = url in pages.columns
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"),
                        (F.col(url).cast("string") if has_url else F.lit(None).cast("string")).alias("url"),
                        F.coalesce(F.col(html), F.lit("")).alias("html"))
    digests = stage(rows.select("page_id", F.sha1("html").alias("sha"), F.octet_length("html").alias("n")), "warc-digests")
    shared = stage(digests.where(F.col("n") >= least).groupBy("sha")
                   .agg(F.max("page_id").alias("response"), F.count("*").alias("copies"))
                   .where("copies > 1").select("sha", "response"), "warc-shared")
    return rows.withColumn("sha", F.sha1("html")).join(shared, "sha", "left")


def write_archives(planned: DataFrame, name: str = "warc") -> DataFrame:
    """Write ``plan_records`` rows into monolithic gzip archives: (archive, records)."""
    folder = new_scratch(planned.sparkSession, name)

    def write(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_folder(folder)
        store.create_dir(root)
        out = z = path = None
        records = size = 0
        for batch in it:
            for row in batch.to_pylist():
                if out is None:
                    path = f"{root}/{uuid.uuid4().hex}.warc.gz"
                    out, z, records, size = store.open_output_stream(path, compression=None), zlib.compressobj(6, zlib.DEFLATED, 31), 0, 0
                payload = row["html"].encode()
                revisit = row["response"] is not None and row["page_id"] != row["response"]
                out.write(z.compress(render(row["page_id"], row["url"], payload, digest(payload), row["response"], revisit)))
                records, size = records + 1, size + len(payload)
                if size >= ARCHIVE_BYTES:
                    out.write(z.flush())
                    out.close()
                    out = None
                    yield record_batch({"archive": [path], "records": [records]}, MANIFEST)
        if out is not None:
            out.write(z.flush())
            out.close()
            yield record_batch({"archive": [path], "records": [records]}, MANIFEST)

    return stage(planned.select("page_id", "url", "html", "response")
                 .mapInArrow(write, "archive string, records bigint"), f"{name}-manifest")


def normalise_archives(manifest: DataFrame, folder_of: str, name: str = "warc-members") -> DataFrame:
    """Rewrite each monolithic archive record by record: (archive, offset, length).

    One task inflates an archive once as a stream (gzip can't be entered elsewhere) and
    holds one record at a time; archives are dealt out evenly by number, and
    ``ARCHIVE_BYTES`` bounds each.  The index is also written beside the archive, one
    tab-separated line per member: offset, length, type, record id, payload digest.
    ``folder_of`` is any URI of the store that holds the archives.
    """
    folder = new_scratch(manifest.sparkSession, name)

    def rewrite(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_folder(folder)
        store.create_dir(root)
        source_store, _ = open_folder(folder_of)
        for batch in it:
            for archive in batch.column(0).to_pylist():
                path = f"{root}/{uuid.uuid4().hex}.warc.gz"
                offsets, sizes, lines, at = [], [], [], 0
                with source_store.open_input_stream(archive, compression=None) as source, \
                        store.open_output_stream(path, compression=None) as out:
                    for record in split_records(inflate(source)):
                        z = zlib.compressobj(6, zlib.DEFLATED, 31)
                        member = z.compress(record) + z.flush()
                        out.write(member)
                        head = parse_head(record[:record.index(b"\r\n\r\n")])
                        lines.append(f"{at}\t{len(member)}\t{head['warc-type']}\t{head['warc-record-id']}\t"
                                     f"{head['warc-payload-digest']}\n")
                        offsets.append(at)
                        sizes.append(len(member))
                        at += len(member)
                with store.open_output_stream(path + ".idx", compression=None) as out:
                    out.write("".join(lines).encode())
                for i in range(0, len(offsets), 10_000):
                    n = len(offsets[i:i + 10_000])
                    yield record_batch({"archive": [path] * n, "offset": offsets[i:i + n], "length": sizes[i:i + n]}, INDEX)

    slots = max(1, manifest.sparkSession.sparkContext.defaultParallelism)
    return stage(manifest.select("archive").repartition(4 * slots)
                 .mapInArrow(rewrite, "archive string, offset bigint, length bigint"), f"{name}-index")


def page_of(record_id: str) -> int | None:
    text = record_id.removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def read_indexed(index: DataFrame, folder_of: str) -> DataFrame:
    """Open every indexed member at its offset and parse its record (``RECORD``).

    A response's payload is hashed again and must equal its header's digest and length.
    """

    def load(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from urllib.parse import unquote

        store, _ = open_folder(folder_of)
        opened, path = None, None
        for batch in it:
            rows, held = {k: [] for k in RECORD.names}, 0
            for archive, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if archive != path:
                    if opened is not None:
                        opened.close()
                    opened, path = store.open_input_file(archive), archive
                opened.seek(offset)
                record = zlib.decompress(opened.read(length), 31)
                cut = record.index(b"\r\n\r\n")
                head, payload = parse_head(record[:cut]), record[cut + 4:-4]
                sha, n = head["warc-payload-digest"].removeprefix("sha1:"), int(head["x-payload-length"])
                revisit = head["warc-type"] == "revisit"
                if not revisit and (digest(payload) != sha or len(payload) != n):
                    raise ValueError(f"{archive}@{offset}: the payload doesn't match its digest")
                url = head.get("warc-target-uri")
                for k, v in zip(RECORD.names, (
                        page_of(head["warc-record-id"]), None if url is None else unquote(url), head["warc-type"], n, sha,
                        page_of(head["warc-refers-to"]) if revisit else None, None if revisit else payload), strict=True):
                    rows[k].append(v)
                held += len(payload)
                if held >= ARCHIVE_BYTES:
                    yield record_batch(rows, RECORD)
                    rows, held = {k: [] for k in RECORD.names}, 0
            if rows["page_id"]:
                yield record_batch(rows, RECORD)

    return index.mapInArrow(load, "page_id bigint, url string, record_type string, payload_bytes bigint, "
                                  "payload_digest string, refers_to bigint, payload binary")


def warc_round_trip(pages: DataFrame, page_id: str = "page_id", html: str = "html", url: str = "url") -> DataFrame:
    """Write ``pages`` as monolithic archives, normalise them and read them by index.

    One row per input row (``RECORD``).  A null html is the empty payload; among equal
    payloads the row with the largest page_id is the response.  Rows that repeat that
    page_id are responses too (they are the same record), a null page_id never is one
    while another row has the payload, and all-null ids with one payload are responses.
    Payloads of any length stay whole; an empty table gives no rows; other columns of
    ``pages`` are not read.
    """
    manifest = write_archives(plan_records(pages, page_id, html, url))
    root = new_scratch(pages.sparkSession, "warc")  # any URI of the shared store
    index = normalise_archives(manifest, root)
    return read_indexed(index, root)
