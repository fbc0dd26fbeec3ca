"""WARC archives: written with an index, and read back by coalesced byte ranges.

Each record is a gzip member of its own.  Writing a record adds a row to the
index: archive, offset, length, URL, digest.  Reading starts from the index:
the rows of the selected records are sorted by archive and offset, ranges that
(nearly) touch are read at once, and each record is cut out of what was read.

Equal payloads of at least LEAST_BYTES are stored once: the row with the
largest key gets the response record and all others get revisit records, which
name it and its payload's digest and length.
"""

from __future__ import annotations

import hashlib
import math
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.llm.common import give_back, shared_dir, stored, table
from cadastra.llm.files import opened

#: Payloads from which on equal ones are stored once; bytes after which a task starts another archive.
LEAST_BYTES, ARCHIVE_BYTES = 1000, 256 << 20
#: Bytes between two ranges that are read rather than skipped; most bytes of a read of several records.
GAP_BYTES, READ_BYTES = 64 << 10, 8 << 20
INDEX = "archive string, offset long, length long, key long, url string, digest string, record_type string"
RECORD = "key long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"
#: Bytes of records that a task reads back.
TASK_BYTES = 32 << 20
BREAKS = re.compile(r"[\s\x00-\x1f\x7f]")
_END, _DATE = b"\r\n\r\n", b"1970-01-01T00:00:00Z"


def record_id(key: int | None, digest: str) -> bytes:
    """Follows from key and payload, so that a revisit can name the response; rows equal in both share it."""
    return b"<urn:uuid:%s>" % str(uuid.uuid5(uuid.NAMESPACE_URL, f"{key} {digest}")).encode()


def record_bytes(key: int | None, url: str, payload: bytes, kind: str, refers_to: int | None, payload_bytes: int, digest: str) -> bytes:
    """One WARC/1.1 record.

    Header values have no white space or control characters: a URL that has any gets them, and its percent signs,
    percent-encoded, and a header that says so; other URLs stand as they are.
    """
    escaped = bool(BREAKS.search(url or ""))
    target = re.sub(rf"{BREAKS.pattern}|%", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url) if escaped else url or ""
    head = [
        b"WARC/1.1",
        b"WARC-Type: " + kind.encode(),
        b"WARC-Record-ID: " + record_id(key, digest),
        b"WARC-Date: " + _DATE,
        b"WARC-Target-URI: " + target.encode(),
        b"WARC-Payload-Digest: sha1:" + digest.encode(),
    ]
    if escaped:
        head.append(b"X-Target-Escaped: percent")
    if key is not None:
        head.append(b"X-Row-Key: %d" % key)
    if kind == "revisit":
        head += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", b"WARC-Refers-To: " + record_id(refers_to, digest), b"X-Refers-To-Key: %d" % refers_to, b"X-Payload-Length: %d" % payload_bytes]
        payload = b""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d" % payload_bytes + _END + payload
    head += [b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(head) + _END + block + _END


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record."""
    head, _, rest = raw.partition(_END)
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])].partition(_END)[2]


def plan(pages: DataFrame, key: str, url: str, payload: str, path: str) -> DataFrame:
    """pages as (key, url, payload, digest, n, refers_to): where to refer_to is null, the row gets a response record.

    Only digests that several rows share are looked up, and they are stored
    first, so that Spark sees how many they are when it chooses the join.
    """
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(url), F.lit("")).alias("url"), body.alias("payload"), F.sha1(body.cast("binary")).alias("digest"), F.octet_length(body).cast("long").alias("n"))
    large = rows.where(F.col("n") >= LEAST_BYTES)
    copies = large.groupBy("digest", "n").agg(F.count(F.lit(1)).alias("copies"), F.max("key").alias("first")).where("copies > 1 and first is not null").drop("copies")
    seen = stored(copies, f"{path}/copies").withColumnRenamed("n", "copy_n")
    joined = rows.join(seen, (rows.digest == seen.digest) & (rows.n == seen.copy_n), "left")
    refers = F.when(~F.col("key").eqNullSafe(F.col("first")), F.col("first"))
    return joined.select("key", "url", F.when(refers.isNull(), F.col("payload")).otherwise("").alias("payload"), rows.digest, "n", refers.alias("refers_to"))


def write(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write a record for each row below `path`; returns the index, which is stored there too.

    A null payload counts as empty, a null URL as empty.  Rows that share key
    and payload all get response records.  A task that runs again writes other
    archives: only those of the attempt that Spark commits are in the index.
    """
    rows = plan(pages, key, url, payload, path)
    folder = f"{path}/archives"
    schema = pages.sparkSession.createDataFrame([], INDEX).schema
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = opened(folder)
        system.create_dir(base, recursive=True)
        out, name, at = None, "", 0
        for batch in batches:
            index: list[tuple] = []
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                k, target, text, digest, n, refers = r
                if out is None or at >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = system.open_output_stream(f"{base}/{name}", compression=None)
                kind = "response" if refers is None else "revisit"
                z = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = z.compress(record_bytes(k, target, text.encode(), kind, refers, n, digest)) + z.flush()
                out.write(member)
                index.append((name, at, len(member), k, target, digest, kind))
                at += len(member)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*index) if index else [[]] * len(names), types, strict=True)], names=names)
        if out is not None:
            out.close()

    types = [pa.int64() if f.dataType.simpleString() == "bigint" else pa.string() for f in schema]
    return stored(rows.mapInArrow(run, schema), f"{path}/index")


def ranges(rows: list[tuple[str, int, int]], gap: int = GAP_BYTES, most: int = READ_BYTES) -> Iterator[tuple[str, int, int, list[int]]]:
    """(archive, start, end, positions in rows): sorted rows whose ranges (nearly) touch, read at once."""
    at, start, end, part = "", 0, 0, []
    for i, (archive, offset, length) in enumerate(rows):
        if part and (archive != at or offset > end + gap or offset + length - start > most):
            yield at, start, end, part
            part = []
        if not part:
            at, start, end = archive, offset, offset + length
        part.append(i)
        end = max(end, offset + length)
    if part:
        yield at, start, end, part


def read(index: DataFrame, path: str, payloads: bool = False) -> DataFrame:
    """The records of the given index rows; payload_bytes and payload_digest are those of the full payload.

    A response's are measured on what was read and must agree with its header;
    a revisit has no payload and its header's are given.  With `payloads`, the
    column payload (binary) is added, null for revisits.
    """
    schema = index.sparkSession.createDataFrame([], RECORD + (", payload binary" if payloads else "")).schema
    folder = f"{path}/archives"

    def record(raw: bytes) -> tuple:
        fields, payload = parse(zlib.decompress(raw, 31))
        kind, said = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
        key = int(fields["X-Row-Key"]) if "X-Row-Key" in fields else None
        target = unquote(fields["WARC-Target-URI"]) if "X-Target-Escaped" in fields else fields["WARC-Target-URI"]
        if kind == "revisit":
            out = (key, target, kind, int(fields["X-Refers-To-Key"]), int(fields["X-Payload-Length"]), said)
            return (*out, None) if payloads else out
        digest = hashlib.sha1(payload).hexdigest()
        if digest != said:
            raise ValueError(f"record {key}: payload digest {digest}, but its header says {said}")
        out = (key, target, kind, None, len(payload), digest)
        return (*out, payload) if payloads else out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = opened(folder)
        name, source = "", None
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            for archive, start, end, part in ranges(rows):
                if archive != name:
                    if source is not None:
                        source.close()
                    name, source = archive, system.open_input_file(f"{base}/{archive}")
                raw = source.read_at(end - start, start)
                found = [record(raw[rows[i][1] - start : rows[i][1] - start + rows[i][2]]) for i in part]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types, strict=True)], names=names)

    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    types, names = [kinds[f.dataType.simpleString()] for f in schema], schema.fieldNames()
    # by the bytes that are read, not by those of the index
    tasks = max(1, math.ceil((index.agg(F.sum("length")).first()[0] or 0) / TASK_BYTES))
    wanted = index.select("archive", "offset", "length").repartitionByRange(tasks, "archive", "offset").sortWithinPartitions("archive", "offset")
    return wanted.mapInArrow(run, schema)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    give_back(spark)
    path = shared_dir(spark)
    index = write(table(spark, sf_dir, "pages"), path)
    give_back(spark)
    return read(index, path).select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL = """
with p as (select page_id, coalesce(html, '') as body from pages),
     d as (select page_id, octet_length(encode(body)) as payload_bytes, sha1(body) as payload_digest from p),
     f as (select *, case when payload_bytes >= 1000 then max(page_id) over (partition by payload_digest, payload_bytes) end as first from d)
select page_id, payload_bytes, payload_digest,
       case when first is not null and first <> page_id then 'revisit' else 'response' end as record_type,
       case when first <> page_id then first end as refers_to
from f
"""
