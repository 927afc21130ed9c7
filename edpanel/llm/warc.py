"""WARC archives of pages and their assembly into captures.

Each page becomes three records: a request, a response (or a revisit, where a page with a
smaller ``page_id`` has the same payload) and a metadata record. Request and metadata name the
response through WARC-Concurrent-To. Archives are gzip files with one member per record, at
most ``file_bytes`` of payload each (but for one longer page). Reading parses every record,
checks lengths and digests, and joins the three kinds on the identifiers into one nested row
per capture.

Defined results: a null html is an empty payload, which counts like any other; a null url gives
an empty target; a null ``page_id`` is kept and sorts first; rows that repeat get records of
their own, and those that repeat a response are responses too; an empty table gives no record;
extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edpanel.llm.common import fresh_folder, slices, write_blob, written

FILE_BYTES = 32 << 20
DATE = "2024-01-01T00:00:00Z"
_NAMES = uuid.uuid5(uuid.NAMESPACE_URL, "urn:edpanel:warc")
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
RECORDS = ("record_id string, kind string, concurrent_to string, refers_to string, target string, date string, "
           "payload_digest string, payload_bytes long, page_id long, refers_page long, payload binary")


def _line(value: str) -> str:
    """A header value on one line; escapes are undone by the reader."""
    return value.encode("unicode_escape").decode("ascii")


def _record(kind: str, ident: str, fields: dict[str, str | None], block: bytes) -> bytes:
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<{ident}>", "WARC-Date": DATE} | {k: v for k, v in fields.items() if v is not None}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    data = f"WARC/1.1\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def capture_records(page_id, url: str, payload: bytes, sha1: str, repeat: int, first_page, first_url: str) -> bytes:
    """The three records of one page. ``repeat`` tells equal rows apart."""
    def ident(page, target, n, kind):
        return uuid.uuid5(_NAMES, f"{page}\n{target}\n{sha1}\n{n}\n{kind}").urn
    digest = "sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode()
    own, http = ident(page_id, url, repeat, "response"), _HTTP.format(len(payload)).encode()
    common = {"WARC-Target-URI": _line(url), "WARC-Payload-Digest": digest}
    if first_page == page_id:
        main = _record("response", own, common | {"Content-Type": "application/http; msgtype=response"}, http + payload)
        meta = ""
    else:
        main = _record("revisit", own, common | {
            "Content-Type": "application/http; msgtype=response",
            "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            "WARC-Refers-To": f"<{ident(first_page, first_url, 0, 'response')}>", "WARC-Refers-To-Target-URI": _line(first_url)}, http)
        meta = f"refers-to-page: {'' if first_page is None else first_page}\r\n"
    target = {"WARC-Target-URI": _line(url), "WARC-Concurrent-To": f"<{own}>"}
    request = _record("request", ident(page_id, url, repeat, "request"), target | {"Content-Type": "application/http; msgtype=request"},
                      f"GET {_line(url)} HTTP/1.1\r\n\r\n".encode())
    meta = f"page-id: {'' if page_id is None else page_id}\r\npayload-bytes: {len(payload)}\r\n{meta}"
    return request + main + _record("metadata", ident(page_id, url, repeat, "metadata"), target | {"Content-Type": "application/warc-fields"}, meta.encode())


def write_warc(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the archives of ``pages`` (page_id, url, html) under ``folder``; returns the written
    manifest (file, n_records, n_bytes)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("sha1", F.sha1(F.encode("html", "utf-8")))
    # a small marker row goes before the rows of a page that revisits an earlier one: the texts
    # are shuffled once, by the order of the archive, and are never part of a join
    keys = rows.select("page_id", "url", "sha1")
    first = keys.groupBy("sha1").agg(F.min(F.struct("page_id", "url")).alias("first"))
    markers = (keys.join(first, "sha1").where(~F.col("page_id").eqNullSafe(F.col("first.page_id"))).distinct()
               .select("page_id", "url", F.lit(None).cast("string").alias("html"), "sha1", F.lit(0).alias("place"),
                       F.col("first.page_id").alias("first_page"), F.col("first.url").alias("first_url")))
    whole = rows.select("page_id", "url", "html", "sha1", F.lit(1).alias("place"), F.lit(None).cast("long").alias("first_page"),
                        F.lit(None).cast("string").alias("first_url"))
    order = ["page_id", "url", "sha1", "place"]
    ordered = whole.unionByName(markers).repartitionByRange(*order[:3]).sortWithinPartitions(*order)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, seq, parts, held = TaskContext.get(), 0, [], 0
        before, repeat, n, marker = None, 0, 0, None

        def file():
            nonlocal seq, parts, held, n
            name = f"part-{context.partitionId():06d}-{seq:06d}.warc.gz"
            data = b"".join(parts)
            write_blob(folder, name, data, context.taskAttemptId())
            row = pa.RecordBatch.from_pydict({"file": [name], "n_records": [n], "n_bytes": [len(data)]})
            seq, parts, held, n = seq + 1, [], 0, 0
            return row

        for batch in slices(batches):
            for r in batch.to_pylist():
                key = (r["page_id"], r["url"], r["sha1"])
                if r["place"] == 0:
                    marker = (key, r["first_page"], r["first_url"])
                    continue
                before, repeat = key, repeat + 1 if key == before else 0
                _, first_page, first_url = marker if marker and marker[0] == key else (key, r["page_id"], r["url"])
                payload = r["html"].encode()
                parts.append(capture_records(r["page_id"], r["url"], payload, r["sha1"], repeat, first_page, first_url))
                held, n = held + len(payload), n + 3
                if held >= file_bytes:
                    yield file()
        if parts:
            yield file()

    manifest = ordered.mapInArrow(task, "file string, n_records long, n_bytes long")
    manifest.write.parquet(f"{folder}/_manifest")
    return pages.sparkSession.read.schema(manifest.schema).parquet(f"{folder}/_manifest")


def _members(data: bytes, chunk: int = 1 << 14) -> Iterator[bytes]:
    view, at = memoryview(data), 0
    while at < len(view):
        opener, parts = zlib.decompressobj(31), []
        while not opener.eof:
            if at >= len(view):
                raise ValueError("an archive is cut off")
            parts.append(opener.decompress(view[at:at + chunk]))
            at = min(at + chunk, len(view)) - len(opener.unused_data)
        yield b"".join(parts)


_FIELD = re.compile(r"([^:\r\n]+):[ \t]*([^\r\n]*)\r\n")


def _members_of(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of every record of an archive."""
    for raw in _members(data):
        head, _, rest = raw.partition(b"\r\n\r\n")
        version, _, lines = head.decode().partition("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError("not a WARC record")
        fields = {k.strip().lower(): v for k, v in _FIELD.findall(lines + "\r\n")}
        size = int(fields["content-length"])
        if rest[size:] != b"\r\n\r\n":
            raise ValueError("a record's length is wrong")
        yield fields, rest[:size]


def _row(fields: dict[str, str], block: bytes, with_payload: bool) -> dict:
    def plain(name):
        return fields[name].strip("<>") if name in fields else None
    kind = fields["warc-type"]
    out = dict.fromkeys(n.split()[0] for n in RECORDS.split(", "))
    out |= {"record_id": plain("warc-record-id"), "kind": kind, "concurrent_to": plain("warc-concurrent-to"),
            "refers_to": plain("warc-refers-to"), "date": fields["warc-date"],
            "target": fields.get("warc-target-uri", "").encode("ascii").decode("unicode_escape"),
            "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None}
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != out["payload_digest"]:
            raise ValueError("a payload does not have its digest")
        out |= {"payload_bytes": len(payload), "payload": payload if with_payload else None}
    elif kind == "metadata":
        said = dict(_FIELD.findall(block.decode()))
        out |= {"payload_bytes": int(said["payload-bytes"]), "page_id": int(said["page-id"]) if said["page-id"] else None,
                "refers_page": int(said["refers-to-page"]) if said.get("refers-to-page") else None}
    return out


def read_records(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """One row per record of all archives in ``folder``."""
    kinds = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[t])
                       for n, t in (x.split() for x in RECORDS.split(", "))])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("content"):
                held, size = [], 0
                for fields, block in _members_of(data.as_buffer().to_pybytes()):
                    held.append(_row(fields, block, with_payload))
                    size += len(block) * with_payload + 500
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema=kinds)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=kinds)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select("content")
    return files.mapInArrow(task, RECORDS)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: the response or revisit with its request and metadata record,
    joined through the concurrent-to identifiers. A capture without one of them has it null."""
    main = records.where(F.col("kind").isin("response", "revisit"))
    request = records.where("kind = 'request'").select("concurrent_to", F.struct("record_id", "target", "date").alias("request"))
    metadata = records.where("kind = 'metadata'").select("concurrent_to", F.struct("record_id", "page_id", "payload_bytes", "refers_page").alias("metadata"))
    response = main.select("record_id", F.struct("record_id", "kind", "target", "date", "refers_to", "payload_digest", "payload_bytes", "payload").alias("response"))
    joined = response.join(request, response.record_id == request.concurrent_to, "left").drop("concurrent_to")
    joined = joined.join(metadata, joined.record_id == metadata.concurrent_to, "left").drop("concurrent_to")
    return joined.select("record_id", "request", "response", "metadata")


def archive_round_trip(pages: DataFrame, with_payload: bool = False, **options) -> DataFrame:
    """Write ``pages`` as archives into a new shared folder and return their captures."""
    spark = pages.sparkSession
    folder = fresh_folder(spark, "warc")
    if write_warc(pages, folder, **options).isEmpty():
        return captures(spark.createDataFrame([], RECORDS))
    return captures(written(read_records(spark, folder, with_payload), "records"))  # parsed once for three reads
