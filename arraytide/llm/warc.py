"""WARC archives: write captures as transactions, read records back, assemble one nested row per capture.

A capture is a request, a response (or a revisit of an equal payload) and a metadata record. Request and metadata name the response
record in WARC-Concurrent-To; `assemble` joins them on it. Archives are gzip members, one per record, cut into segments that the manifest
lists, so that large archives are read in parallel.

Defined results: a null payload is empty; a null page id is written without id and reads back null (nulls are below every id when the
largest is sought); rows that repeat page id and payload of the chosen response are responses themselves; an empty table gives an empty
manifest; a record without WARC-Concurrent-To that is no response makes a capture of its own with a null response.
"""
from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arraytide.llm import common

MANIFEST = "path string, start long, length long, records long"
RECORDS = ("record_id string, warc_type string, concurrent_to string, target_uri string, declared_digest string, payload_digest string, "
           "payload_bytes long, fields map<string,string>, payload binary")
EPOCH = "1970-01-01T00:00:00Z"


def with_roles(pages: DataFrame, min_bytes: int = 1000, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, payload, payload_digest, record_type and refers_to. Of equal payloads of at least `min_bytes` the largest id responds."""
    p = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                     common.text_of(html).cast("binary").alias("payload"))
    p = p.withColumn("payload_digest", F.sha1("payload"))
    groups = (p.where(F.octet_length("payload") >= min_bytes).groupBy("payload_digest")
              .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    revisit = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return (p.join(groups, "payload_digest", "left")
            .select("page_id", "url", F.when(~revisit | revisit.isNull(), F.col("payload")).alias("payload"), "payload_digest",
                    F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("keeper")).alias("refers_to")))


def _record(kind: str, rid: str, block: bytes, content_type: str, uri: str | None, extra: tuple[str, ...] = ()) -> bytes:
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{rid}>", f"WARC-Date: {EPOCH}",
            *([f"WARC-Target-URI: {' '.join(uri.split())}"] if uri else []), *extra, f"Content-Type: {content_type}", f"Content-Length: {len(block)}"]
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode() + b"\r\n\r\n") + z.compress(block) + z.compress(b"\r\n\r\n") + z.flush()


def _transaction(page_id, url, payload, digest, kind) -> list[bytes]:
    main = str(uuid.uuid4())
    joined = (f"WARC-Concurrent-To: <urn:uuid:{main}>",)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    about = (f"WARC-Payload-Digest: sha1:{digest}", *(("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",)
                                                      if kind == "revisit" else ()))
    facts = b"" if page_id is None else f"page-id: {page_id}\r\n".encode()
    return [_record("request", str(uuid.uuid4()), b"GET / HTTP/1.1\r\n\r\n", "application/http;msgtype=request", url, joined),
            _record(kind, main, http + (payload or b""), "application/http;msgtype=response", url, about),
            _record("metadata", str(uuid.uuid4()), facts, "application/warc-fields", url, joined)]


def write(roles: DataFrame, folder: str, archive_bytes: int = 256 << 20, segment_bytes: int = 2 << 20) -> DataFrame:
    """Write the rows of `with_roles` as archives under the shared `folder`; returns the stored manifest of segments.

    A task writes files of its own and the manifest keeps those of the task that finished, so a lost executor leaves no half archive in it.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        out, path, at, seg, n, rows = None, "", 0, 0, 0, []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "payload_digest", "record_type")), strict=True):
                if out is None:
                    path = f"{root}/{uuid.uuid4().hex}.warc.gz"
                    out, at, seg, n = fs.open_output_stream(path, compression=None), 0, 0, 0
                for piece in _transaction(*row):
                    out.write(piece)
                    at, n = at + len(piece), n + 1
                if at - seg >= segment_bytes or at >= archive_bytes:
                    rows.append((path, seg, at - seg, n))
                    seg, n = at, 0
                    if at >= archive_bytes:
                        out.close()
                        out = None
        if out is not None:
            if n:
                rows.append((path, seg, at - seg, n))
            out.close()
        scheme = folder.split("://")[0] + "://" if "://" in folder else ""
        host = folder[len(scheme):].split("/")[0] if scheme and scheme != "file://" else ""
        yield pa.RecordBatch.from_arrays([pa.array([f"{scheme}{host}{r[0]}" for r in rows], pa.string()),
                                          *(pa.array([r[i] for r in rows], pa.int64()) for i in (1, 2, 3))],
                                         ["path", "start", "length", "records"])

    return common.stored(roles.select("page_id", "url", "payload", "payload_digest", "record_type").mapInArrow(task, MANIFEST), "warc-manifest")


def _members(raw: bytes) -> Iterator[bytes]:
    view, at = memoryview(raw), 0
    while at < len(view):
        z, out = zlib.decompressobj(31), []
        while not z.eof:
            step = view[at: at + 65536]
            if not len(step):
                raise ValueError("truncated archive segment")
            out.append(z.decompress(step))
            at += len(step)
        at -= len(z.unused_data)
        yield b"".join(out)


def _fields(raw: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in raw.decode("utf-8", "replace").split("\r\n")) if k and v}


def _parse(raw: bytes, with_payload: bool) -> tuple:
    head, _, rest = raw.partition(b"\r\n\r\n")
    h = _fields(head.partition(b"\r\n")[2])
    block, kind = rest[: int(h["content-length"])], h.get("warc-type")
    payload = block.partition(b"\r\n\r\n")[2] if kind in ("response", "revisit", "request") else b""
    full = kind == "response"
    digest = h.get("warc-payload-digest", "").rpartition(":")[2] or None
    return (h.get("warc-record-id"), kind, h.get("warc-concurrent-to"), h.get("warc-target-uri"), digest,
            hashlib.sha1(payload).hexdigest() if full else None, len(payload) if full else None,
            list(_fields(block).items()) if kind == "metadata" else [], payload if with_payload and full else None)


def read(manifest: DataFrame, with_payload: bool = True, batch_records: int = 200) -> DataFrame:
    """One row per record of the manifest's segments; each segment is read by one task, a few records at a time."""
    kinds = [pa.string()] * 6 + [pa.int64(), pa.map_(pa.string(), pa.string()), pa.binary()]
    names = [x.split()[0] for x in RECORDS.split(", ")]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

        for batch in batches:
            for path, start, length in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "length")), strict=True):
                fs, at = pafs.FileSystem.from_uri(path)
                with fs.open_input_file(at) as f:
                    raw = f.read_at(length, start)
                rows = []
                for member in _members(raw):
                    rows.append(_parse(member, with_payload))
                    if len(rows) >= batch_records:
                        yield out(rows)
                        rows = []
                if rows:
                    yield out(rows)

    # a few dozen bytes per segment of megabytes: dealing the segments out evenly costs nothing
    spread = manifest.repartition(max(manifest.sparkSession.sparkContext.defaultParallelism * 2, 8))
    return spread.mapInArrow(task, RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: struct `response`, struct `request`, array `metadata`, with `warc_type` and `capture_id` on top.

    Requests and metadata meet their response on WARC-Concurrent-To. Several requests of one capture: that with the smallest id is nested,
    `n_requests` counts them. Records that name no response, or one that is not there, keep a row of their own.
    """
    main = records.where(F.col("warc_type").isin("response", "revisit"))
    side = records.where(~F.col("warc_type").isin("response", "revisit"))
    capture = F.coalesce("concurrent_to", "record_id").alias("capture_id")
    about = F.struct("record_id", "target_uri")
    req = (side.where("warc_type = 'request'").groupBy(capture)
           .agg(F.min(about).alias("request"), F.count(F.lit(1)).alias("n_requests")))
    meta = (side.where("warc_type <> 'request'").groupBy(capture)
            .agg(F.array_sort(F.collect_list(F.struct("record_id", "warc_type", F.map_entries("fields").alias("fields")))).alias("metadata")))
    body = main.select(F.col("record_id").alias("capture_id"), "warc_type",
                       F.struct("target_uri", "declared_digest", "payload_digest", "payload_bytes", "payload").alias("response"))
    return (body.join(req, "capture_id", "full").join(meta, "capture_id", "full")
            .withColumn("n_requests", F.coalesce("n_requests", F.lit(0))))


def resolve(captures: DataFrame) -> DataFrame:
    """Per response or revisit: page_id, payload_bytes, payload_digest, record_type, refers_to. A revisit takes them from its response."""
    entries = F.filter(F.flatten(F.transform("metadata", lambda m: m["fields"])), lambda e: e["key"] == "page-id")
    c = captures.where("warc_type is not null").select(
        F.get(entries, F.lit(0))["value"].cast("long").alias("page_id"), F.col("warc_type").alias("record_type"),
        F.coalesce("response.payload_digest", "response.declared_digest").alias("payload_digest"),
        F.col("response.payload_bytes").alias("own_bytes"))
    kept = (c.where("record_type = 'response'").groupBy("payload_digest")
            .agg(F.max("page_id").alias("response_page"), F.max("own_bytes").alias("there")))
    revisit = F.col("record_type") == "revisit"
    return (c.join(kept, "payload_digest", "left")
            .select("page_id", F.coalesce("own_bytes", "there").alias("payload_bytes"), "payload_digest", "record_type",
                    F.when(revisit, F.col("response_page")).alias("refers_to")))
