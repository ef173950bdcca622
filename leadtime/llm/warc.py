"""WARC archives: written as whole-file gzip streams, normalised to one member per record, read back by offset.

``write_archives`` lets Spark's text sink write the records (the separator of WARC records is its line separator), so
each file is one monolithic gzip stream. ``normalise`` inflates each such stream once, in pieces, rewrites every record
as its own gzip member, and writes beside each archive a sidecar ``.idx`` (offset, length, record id); the same index is
returned as a table. ``read_records`` opens single members by that index.

A task writes its archive under a name of its own and only names that reach the committed index table are ever read, so
retried tasks leave nothing but unread files. Archives are written through ``pyarrow.fs``, which opens the scheme of the
shared folder (file, hdfs, s3, gs).

Nulls: a null html is an empty payload, a null url is written as ``about:blank``, a null page_id as ``urn:page:null`` and
comes back as null. Of equal payloads the smallest page_id (null last) is the response; repeated rows of that id are
responses as well. Empty tables give empty archives and an empty result. Records of any length pass: memory holds one
record and its member. Columns beside page_id, url, html are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadtime.plans.lineage import fresh_path, materialize

WARC_DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
#: Bytes that are inflated at a time, gzip level of members, most records in an archive.
INFLATE_BYTES, LEVEL, FILE_RECORDS = 1 << 16, 1, 20_000
INDEX = "archive string, number long, offset long, length long, record_id string"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target_uri string"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: 160 bits are four groups of eight digits."""
    hexed = F.sha1(payload.cast("binary"))
    groups = [F.lpad(F.conv(F.substring(hexed, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def _record(page_id, url, html, payload_digest, first) -> Column:
    """The text of one record, without the separator behind it."""
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"), F.when(first.isNull(), html).otherwise(F.lit("")))
    uri = F.regexp_replace(F.coalesce(F.nullif(url, F.lit("")), F.lit("about:blank")), r"[\x00-\x20\x7F]", "%20")
    head = [F.lit("WARC/1.0\r\nWARC-Type: "), F.when(first.isNull(), F.lit("response")).otherwise(F.lit("revisit")),
            F.lit("\r\nWARC-Record-ID: "), _urn(page_id), F.lit(f"\r\nWARC-Date: {WARC_DATE}\r\nWARC-Target-URI: "), uri,
            F.lit("\r\nWARC-Payload-Digest: sha1:"), payload_digest,
            F.when(first.isNull(), F.lit("")).otherwise(F.concat(F.lit("\r\nWARC-Refers-To: "), _urn(first), F.lit(f"\r\nWARC-Profile: {PROFILE}"))),
            F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(http).cast("string"), F.lit("\r\n\r\n"), http]
    return F.concat(*head)


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """One record per page below ``path``. Repeats of a payload of ``least_bytes`` or more become revisits."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("payload_digest", base32_sha1(F.col("html")))
    firsts = (rows.where(F.octet_length("html") >= least_bytes).groupBy(F.col("payload_digest").alias("same"))
              .agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies")))
    firsts = firsts.where("copies > 1 AND first_id IS NOT NULL").select("same", "first_id")
    rows = rows.join(firsts, (F.col("payload_digest") == F.col("same")) & (F.octet_length("html") >= least_bytes), "left")
    first = F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    text = rows.select(_record(F.col("page_id"), F.col("url"), F.col("html"), F.col("payload_digest"), first).alias("value"))
    text.write.option("compression", "gzip").option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", FILE_RECORDS).text(path)


def _inflated(content: bytes):
    """The plain bytes of a gzip file in pieces, whether it has one member or many."""
    at = 0
    while at < len(content):
        stream = zlib.decompressobj(31)
        while not stream.eof and at < len(content):
            piece = content[at:at + INFLATE_BYTES]
            at += len(piece)
            if plain := stream.decompress(piece):
                yield plain
        at -= len(stream.unused_data)


def records(content: bytes):
    """The bytes of each record of an archive, its separator included."""
    held = bytearray()
    pieces = _inflated(content)
    need = 0
    while True:
        head = held.find(b"\r\n\r\n") if len(held) >= need else -1
        if head >= 0:
            fields = _fields(bytes(held[:head]))
            size = head + 4 + int(fields["content-length"]) + 4
            if len(held) >= size:
                yield fields, bytes(held[:size])
                del held[:size]
                need = 0
                continue
            need = size
        piece = next(pieces, None)
        if piece is None:
            if held.strip():
                raise ValueError("an archive ends inside a record")
            return
        held += piece


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def _normalise(folder: str):
    def work(batches):
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base)
        for batch in batches:
            for content in batch.column("content"):
                name = f"{base}/{uuid.uuid4().hex}.warc.gz"
                rows, at = [], 0
                with store.open_output_stream(name, compression=None) as out:
                    for fields, record in records(content.as_py()):
                        member = gzip.compress(record, LEVEL, mtime=0)
                        out.write(member)
                        rows.append((at, len(member), fields["warc-record-id"]))
                        at += len(member)
                with store.open_output_stream(f"{name}.idx") as out:
                    out.write("".join(f"{a} {n} {i}\n" for a, n, i in rows).encode())
                n = len(rows)
                offsets, lengths, ids = zip(*rows) if rows else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array([name] * n, pa.string()), pa.array(range(n), pa.int64()), pa.array(offsets, pa.int64()),
                                                  pa.array(lengths, pa.int64()), pa.array(ids, pa.string())],
                                                 names=["archive", "number", "offset", "length", "record_id"])
    return work


def normalise(spark: SparkSession, path: str, out: str) -> DataFrame:
    """Rewrite every archive below ``path`` with one gzip member per record below ``out``; returns the offset index."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    index = files.mapInArrow(_normalise(f"{out}/archives"), INDEX)
    index.write.parquet(f"{out}/index")
    return spark.read.schema(INDEX).parquet(f"{out}/index")


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number.lstrip("-").isdigit() else None


def _read(folder: str):
    def work(batches):
        store = fs.FileSystem.from_uri(folder)[0]
        name, file = None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["archive"] != name:
                    if file is not None:
                        file.close()
                    name, file = row["archive"], store.open_input_file(row["archive"])
                file.seek(row["offset"])
                record = zlib.decompress(file.read(row["length"]), 31)
                head, _, block = record.partition(b"\r\n\r\n")
                fields = _fields(head)
                payload = block[:int(fields["content-length"])].partition(b"\r\n\r\n")[2]
                whole = fields["warc-type"] == "response"
                out.append({"page_id": _page(fields["warc-record-id"]), "payload_bytes": len(payload) if whole else None,
                            "payload_digest": base64.b32encode(hashlib.sha1(payload).digest()).decode() if whole else fields["warc-payload-digest"].removeprefix("sha1:"),
                            "record_type": fields["warc-type"], "refers_to": _page(fields.get("warc-refers-to")), "target_uri": fields["warc-target-uri"]})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
                ("refers_to", pa.int64()), ("target_uri", pa.string())]))
        if file is not None:
            file.close()
    return work


def read_records(index: DataFrame, out: str) -> DataFrame:
    """One row per record of the index. Length and digest are taken from the payload itself; revisits have no payload
    and get both from the response that they refer to."""
    rows = materialize(index.select("archive", "offset", "length").mapInArrow(_read(f"{out}/archives"), RECORD), "records")
    responses = (rows.where("record_type = 'response'").groupBy(F.col("page_id").alias("id"), F.col("payload_digest").alias("same"))
                 .agg(F.max("payload_bytes").alias("full_bytes")))
    rows = rows.join(responses, (F.col("refers_to") == F.col("id")) & (F.col("payload_digest") == F.col("same")), "left")
    return rows.select("page_id", F.coalesce("payload_bytes", "full_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to", "target_uri")


def archive_pages(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write the pages as monolithic archives, normalise them, and read them back through the index."""
    spark = pages.sparkSession
    raw, out = fresh_path(spark, "warc-raw"), fresh_path(spark, "warc")
    write_archives(pages, raw, least_bytes)
    return read_records(normalise(spark, raw, out), out)
