"""Web archives: monolithic gzip files normalised to a member per record with a sidecar offset index."""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

DATE = "1970-01-01T00:00:00Z"
ID = "urn:x-page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SALTS = 64
LEVEL = 6
BATCH_BYTES = 16 << 20
GZIP = 31  # zlib's window bits for a gzip header and trailer
INDEX = "offset bigint, length bigint, type string, id string, uri string, digest string"
RECORD = "id string, type string, uri string, digest string, refers_to string, payload_bytes bigint, payload binary"


def payload_digest(payload: bytes) -> str:
    """SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(kind: str, page: str | None, uri: str | None, refers_to: str | None, payload: bytes, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{ID}{'' if page is None else page}>"), ("WARC-Date", date)]
    if uri is not None:
        fields.append(("WARC-Target-URI", re.sub("[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", uri)))
    fields.append(("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"))
    if kind == "revisit":
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{ID}{'' if refers_to is None else refers_to}>")]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode() + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def _uri_of(value: str | None) -> str | None:
    return value[1:-1] if value and value.startswith("<") and value.endswith(">") else value


def decide(rows: DataFrame, id_: str, uri: str, payload: str, least_bytes: int = 0) -> DataFrame:
    """``id, uri, body, kind, refers_to`` for each row: which of equal payloads is the response.

    A group of equal payloads is split by a hash of the id into ``SALTS`` parts, here and in the joins,
    so a group of a third of all rows is no single task's work. The payload moves once.
    """
    body = F.coalesce(F.col(payload).cast("string").cast("binary"), F.lit(b""))
    rows = rows.select(F.col(id_).alias("id"), F.col(uri).cast("string").alias("uri"), body.alias("body"))
    key = F.struct(F.unhex(F.sha2("body", 256)).alias("sha"), F.octet_length("body").alias("n"))
    rows = rows.withColumn("key", key).withColumn("salt", F.pmod(F.xxhash64("id", "uri"), F.lit(SALTS)).cast("int"))
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", F.col("uri").isNull().alias("no_uri"), "uri")
    counted = F.col("key.n") >= least_bytes
    parts = rows.where(counted).groupBy("key", "salt").agg(F.min(order).alias("first"))
    firsts = parts.groupBy("key").agg(F.min(F.struct("first", "salt")).alias("best"))
    parts = parts.select("key", "salt").join(firsts, "key")
    within = Window.partitionBy("key", "salt").orderBy(*[order[c] for c in ("no_id", "id", "no_uri", "uri")])
    rows = rows.withColumn("nth", F.row_number().over(within)).join(parts, ["key", "salt"], "left")
    response = ~counted | ((F.col("salt") == F.col("best.salt")) & (F.col("nth") == 1))
    return rows.select(
        "id", "uri", "body", F.when(response, "response").otherwise("revisit").alias("kind"), F.when(~response, F.col("best.first.id")).alias("refers_to")
    )


def write_archives(
    rows: DataFrame, path: str, id_: str = "page_id", uri: str = "url", payload: str = "html", date: str = DATE, least_bytes: int = 0
) -> None:
    """One archive per task under ``path``, each a whole-file gzip stream of WARC records.

    Of the rows with equal payloads of at least ``least_bytes`` that with the smallest id is written
    as a response, the others as revisits of it, without the payload but with its digest and length;
    shorter payloads are all responses. Spark's text sink compresses and commits the files: a row is
    a record up to its last line end, which the sink adds.

    Defined results: a null payload is empty; null ids come after all others and have an empty id in
    their record, a revisit of such a row refers to it; of rows with the same id the lowest URI comes
    first, of wholly equal rows any; a null URI is left out, white space and control characters in
    one are percent-encoded; other columns take no part; an empty table gives archives without records.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for page, address, body, kind, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                out.append(_record(kind, page, address, refers_to, body, date)[:-1])
                size += len(out[-1])
                if size > BATCH_BYTES:
                    yield pa.record_batch([pa.array(out, pa.binary())], names=["value"])
                    out, size = [], 0
            yield pa.record_batch([pa.array(out, pa.binary())], names=["value"])

    decided = decide(rows, id_, uri, payload, least_bytes)
    decided = decided.select(F.col("id").cast("string"), "uri", "body", "kind", F.col("refers_to").cast("string"))
    records = decided.mapInArrow(build, "value binary").select(F.col("value").cast("string"))
    records.write.option("compression", "gzip").option("lineSep", "\n").text(path)


def _whole_records(buffer: bytearray) -> Iterator[bytes]:
    """The complete records at the front of the buffer, which keeps the rest."""
    at = 0
    while (head := buffer.find(b"\r\n\r\n", at)) >= 0:
        fields = _fields(bytes(buffer[at:head]))
        if not buffer.startswith(b"WARC/", at) or not fields.get("content-length", "").isdigit():
            raise ValueError(f"no WARC record: {bytes(buffer[at : at + 80])!r}")
        end = head + 4 + int(fields["content-length"]) + 4
        if len(buffer) < end:
            break
        yield bytes(buffer[at:end])
        at = end
    del buffer[:at]


def _members(level: int):
    """Lines of inflated archives, in order, to gzip members with their places and to index lines."""
    names = ["sidecar", "archive", "offset", "value"]

    def normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, offset, buffer, out, size = None, 0, bytearray(), [], 0

        def batch():
            columns = list(zip(*out)) if out else [[]] * 4
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.bool_(), pa.int64(), pa.int64(), pa.binary()))], names=names)

        def closed():
            if bytes(buffer).strip():
                raise ValueError(f"archive {file} ends within a record")

        for lines in batches:
            files = lines.column(0).to_numpy()
            cuts = [0, *(i for i in range(1, len(files)) if files[i] != files[i - 1]), len(files)] if len(files) else [0]
            for a, b in zip(cuts, cuts[1:]):
                if file != files[a]:
                    closed()
                    file, offset, buffer = int(files[a]), 0, bytearray()
                buffer += b"\n".join(lines.column(1).slice(a, b - a).to_pylist()) + b"\n"
                for record in _whole_records(buffer):
                    packer = zlib.compressobj(level, zlib.DEFLATED, GZIP)
                    member = packer.compress(record) + packer.flush()
                    fields = _fields(record[: record.index(b"\r\n\r\n")])
                    entry = {"offset": offset, "length": len(member), "type": fields.get("warc-type"), "id": _uri_of(fields.get("warc-record-id"))}
                    entry |= {"uri": fields.get("warc-target-uri"), "digest": (fields.get("warc-payload-digest") or "").removeprefix("sha1:") or None}
                    # The sink ends every row with a zero byte: the last of a member's size, or padding.
                    value = member[:-1] if member.endswith(b"\0") else member
                    out += [(False, file, offset, value), (True, file, offset, json.dumps(entry, ensure_ascii=False).encode())]
                    offset += len(value) + 1
                    size += len(value)
                    if size > BATCH_BYTES:
                        yield batch()
                        out, size = [], 0
        closed()
        yield batch()

    return normalise


def normalise_archives(spark: SparkSession, source: str, target: str, level: int = LEVEL) -> None:
    """Rewrite the gzip archives ``source`` (a folder or glob of ``*.gz``) with one member per record.

    Every archive is inflated once, as a stream, by Spark's line reader, which knows any store Spark
    knows; a task holds one record at a time and not the file. Under ``target``, ``sidecar=false``
    holds one file per archive, its records each a gzip member of its own, and ``sidecar=true`` the
    offset index of each: JSON rows of ``offset, length, type, id, uri, digest``, ended by zero bytes.
    An archive is named by a hash of the path it came from.

    Defined results: any record type is kept byte for byte; members may be followed by one zero byte
    of padding, as gzip allows, where a record has 16 MiB or more; an empty archive gives no file; a
    record without length or cut off by the end of its file is an error that names the archive.
    """
    lines = spark.read.option("lineSep", "\n").text(source)
    lines = lines.select(F.xxhash64("_metadata.file_path").alias("archive"), F.col("value").cast("binary").alias("line"))
    packed = lines.mapInArrow(_members(level), "sidecar boolean, archive bigint, offset bigint, value binary")
    packed = packed.sortWithinPartitions("sidecar", "archive", "offset").select("sidecar", "archive", F.col("value").cast("string").alias("value"))
    packed.write.partitionBy("sidecar", "archive").option("lineSep", "\0").text(target)


def archive_index(spark: SparkSession, target: str) -> DataFrame:
    """The sidecars' rows, with the ``archive`` they belong to."""
    rows = spark.read.schema(f"{INDEX}, sidecar boolean, archive bigint").option("lineSep", "\0").json(target)
    return rows.where("sidecar").drop("sidecar")


def read_archives(spark: SparkSession, target: str, index: DataFrame | None = None, payloads: bool = True) -> DataFrame:
    """The records that ``index`` names (all of them by default), each inflated from its own span.

    ``id, type, uri, digest, refers_to, payload_bytes, payload``; the payload is null for revisits, and
    for all without ``payloads``. Digest and length are those of the full payload: computed from it
    for a response, taken from the record and its HTTP header for a revisit. A span that is no member
    of its own, or a payload that isn't the one the record states, is an error.
    """
    index = archive_index(spark, target) if index is None else index
    spans = index.groupBy("archive").agg(F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("spans"))
    files = spark.read.format("binaryFile").load(target)
    if "archive" in files.columns:
        files = files.where("not sidecar").withColumn("archive", F.col("archive").cast("bigint"))
    else:
        files = files.withColumn("archive", F.lit(None).cast("bigint"))  # no archive has a record
    kind = pa.schema([(f.split()[0], {"bigint": pa.int64(), "binary": pa.binary()}.get(f.split()[1], pa.string())) for f in RECORD.split(", ")])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                content = memoryview(batch.column(0)[i].as_buffer())
                out, size = [], 0
                for span in batch.column(1)[i].as_py():
                    out.append(_parsed(content[span["offset"] : span["offset"] + span["length"]], payloads))
                    size += len(out[-1]["payload"] or b"") + 256
                    if size > BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(out, kind)
                        out, size = [], 0
                yield pa.RecordBatch.from_pylist(out, kind)

    return files.join(spans, "archive").select("content", "spans").mapInArrow(read, RECORD)


def _parsed(member: memoryview, payloads: bool) -> dict:
    unpacker = zlib.decompressobj(GZIP)
    record = unpacker.decompress(member)
    if not unpacker.eof or unpacker.unused_data:
        raise ValueError("the index names a span that is not one gzip member")
    head = record.index(b"\r\n\r\n")
    fields = _fields(record[:head])
    block = record[head + 4 : head + 4 + int(fields["content-length"])]
    kind, stated = fields.get("warc-type"), (fields.get("warc-payload-digest") or "").removeprefix("sha1:")
    payload, n, digest = None, None, stated or None
    if fields.get("content-type", "").startswith("application/http"):
        end = block.index(b"\r\n\r\n")
        if kind == "response":
            payload = block[end + 4 :]
            n, digest = len(payload), payload_digest(payload)
            if stated and stated != digest:
                raise ValueError(f"payload of {fields.get('warc-record-id')} is not the one its digest states")
        else:
            n = int(_fields(block[:end]).get("content-length", "0"))
    return {
        "id": _uri_of(fields.get("warc-record-id")), "type": kind, "uri": fields.get("warc-target-uri"), "digest": digest,
        "refers_to": _uri_of(fields.get("warc-refers-to")), "payload_bytes": n, "payload": payload if payloads else None,
    }


def archived_pages(pages: DataFrame, source: str, target: str, least_bytes: int = 0) -> DataFrame:
    """Pages through archives and back: written to ``source``, normalised to ``target``, read from there.

    ``page_id, payload_bytes, payload_digest, record_type, refers_to``; see the three functions for
    nulls, repeats and empty tables.
    """
    spark = pages.sparkSession
    write_archives(pages, source, least_bytes=least_bytes)
    normalise_archives(spark, source, target)
    page = lambda c: F.nullif(F.replace(F.col(c), F.lit(ID), F.lit("")), F.lit("")).cast("bigint")
    return read_archives(spark, target, payloads=False).select(
        page("id").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), page("refers_to").alias("refers_to")
    )
