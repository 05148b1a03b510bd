"""WARC archives without repeated payloads, and the resolution of their revisit records.

``resolve`` looks only at headers (id, payload length, payload digest): they are
shuffled by digest and the smallest id of each payload becomes its response; the
others revisit it. ``write_archive`` writes fresh records as WARC/1.1, responses
with their payload, revisits as headers that name the response.
``read_archive`` reads the files back by their Content-Length, and
``resolve_revisits`` joins the revisits to the responses by digest, which
restores length and digest of every record, whoever wrote the archive.

Revisits carry the headers of the standard: WARC-Refers-To with the record id of
the response, WARC-Refers-To-Target-URI and WARC-Refers-To-Date. A response's
record id is made from its digest and page id, so that revisits can name it
without seeing it.

Archives are written by Spark's text writer, whose line separator is the blank
lines that end a record, so they land wherever Spark can write, under its
commit protocol, as plain files or gzipped as wholes (that writer can't gzip
record by record). A file holds at most ``file_records`` records and at most
``file_bytes`` bytes of payload, or one longer record: records that could break the
second bound lie in files by size below ``large``. A reader decompresses one
file in a stream and holds one block of it at a time.

Null payloads count as empty. Payloads shorter than ``least_bytes`` are never
revisits. Rows that share the smallest id of a payload are all responses; they
have random record ids, and revisits of them no WARC-Refers-To. Rows
without an id revisit, unless no row of that payload has an id. An empty table
gives an archive without records. Other columns play no part.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketweave.llm.common import staged
from marketweave.session import shared_dir

#: Records in a file of an archive at most, and their payload bytes before compression; a record longer than that is a file of its own.
FILE_RECORDS, FILE_BYTES = 2048, 1 << 27
#: Payload bytes that a reader gathers before it hands rows on.
_BATCH_BYTES = 1 << 24

_END = "\r\n"
_RECORD_END = _END * 2
#: Base 32 as conv() writes it and as RFC 4648 does.
_CONV_DIGITS, _RFC_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def payload_digest(payload: Column) -> Column:
    """Base 32 of the payload's SHA-1: 40 hex digits are eight groups of 20 bits, four digits each."""
    digits = F.sha1(payload.cast("binary"))
    groups = [F.lpad(F.conv(F.substring(digits, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.upper(F.concat(*groups)), _CONV_DIGITS, _RFC_DIGITS)


def _headed(records: DataFrame) -> DataFrame:
    payload = F.coalesce("payload", F.lit(""))
    return records.select("page_id", "url", payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"), payload_digest(payload).alias("payload_digest"))


def _record_id(digest: Column, page_id: Column) -> Column:
    """The record id of the only response with this digest and page id: a URN from their MD5 (version 8, which leaves the other bits free)."""
    x = F.md5(F.concat_ws(":", F.lit("page"), digest, page_id.cast("string")).cast("binary"))
    part = lambda at, n: F.substring(x, at, n)
    return F.concat(F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-8"), part(14, 3), F.lit("-a"), part(18, 3), F.lit("-"), part(21, 12), F.lit(">"))


def _firsts(headed: DataFrame) -> DataFrame:
    """One row for each payload: its smallest page id, the number of rows that bear it, and their url.

    Rows are counted by payload and page first, so that a payload of very many pages is reduced in many tasks.
    """
    rows = headed.groupBy("payload_digest", "page_id").agg(F.count(F.lit(1)).alias("n"), F.min("url").alias("url"))
    first = F.min(F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "n", "url"))
    found = rows.groupBy("payload_digest").agg(first.alias("f"))
    return found.select("payload_digest", F.col("f.page_id").alias("first"), (F.col("f.n") == 1).alias("only"), F.col("f.url").alias("first_url"))


def resolve(records: DataFrame, least_bytes: int = 0) -> DataFrame:
    """The rows of ``records`` (page_id, url, payload) as records to write: payload (null for revisits), payload_bytes, payload_digest, record_type, refers_to,
    record_id (null: any), refers_record, refers_url.

    Payloads are moved once, those of responses only; revisits are decided and written from headers.
    """
    headed = _headed(records)
    firsts = staged(_firsts(headed.where(F.col("payload_bytes") >= least_bytes)), "firsts")
    same = F.col("page_id").eqNullSafe(F.col("first")) | F.col("first").isNull()
    named_record = F.when(F.col("only"), _record_id(F.col("payload_digest"), F.col("first")))
    revisits = headed.drop("payload").join(firsts, "payload_digest").where(~same)
    named = firsts.withColumnRenamed("payload_digest", "digest")
    responses = headed.join(named, (F.col("payload_digest") == F.col("digest")) & (F.coalesce(F.col("page_id"), F.lit(0)) == F.coalesce(F.col("first"), F.lit(0))) & same)
    responses = responses.withColumn("record_id", named_record).select(*headed.columns, "record_id")
    if least_bytes > 0:
        responses = responses.unionAll(headed.where(F.col("payload_bytes") < least_bytes).withColumn("record_id", F.lit(None).cast("string")))
    nothing = F.lit(None).cast("string")
    columns = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "refers_record", "refers_url"]
    written = responses.withColumns({"record_type": F.lit("response"), "refers_to": F.lit(None).cast("long"), "refers_record": nothing, "refers_url": nothing})
    revisited = {"record_type": F.lit("revisit"), "refers_to": F.col("first"), "refers_record": named_record, "refers_url": F.col("first_url"), "payload": nothing, "record_id": nothing}
    return written.select(columns).unionAll(revisits.withColumns(revisited).select(columns))


def _record(kind: str, headers: list[tuple[str, Column]], block: Column) -> Column:
    """Fresh headers of one record with its block. Headers whose value is null are left out."""
    lines = [F.lit(f"WARC/1.1{_END}WARC-Type: {kind}{_END}")]
    lines += [F.coalesce(F.concat(F.lit(f"{k}: "), v, F.lit(_END)), F.lit("")) for k, v in headers]
    return F.concat(*lines, F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(_END * 2)), block)


def records_text(resolved: DataFrame, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """One column ``value``: the text of each WARC record, without its closing blank lines."""
    digest = F.concat(F.lit("sha1:"), "payload_digest")
    line = lambda c: F.regexp_replace(c, r"[\r\n]", "")  # noqa: E731  a header is one line
    uri = F.concat(F.lit("urn:page:"), F.col("page_id").cast("string"))
    record_id = F.coalesce("record_id", F.concat(F.lit("<urn:uuid:"), F.expr("uuid()"), F.lit(">")))
    shared = [("WARC-Record-ID", record_id), ("WARC-Date", F.lit(date)), ("WARC-Target-URI", line("url")), ("WARC-Page-ID", uri), ("WARC-Payload-Digest", digest)]
    revisit = [
        ("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        ("WARC-Refers-To", F.col("refers_record")),
        ("WARC-Refers-To-Target-URI", line("refers_url")),
        ("WARC-Refers-To-Date", F.lit(date)),
        ("WARC-Refers-To-Page-ID", F.concat(F.lit("urn:page:"), F.col("refers_to").cast("string"))),
    ]
    text = F.when(F.col("record_type") == "revisit", _record("revisit", shared + revisit, F.lit(""))).otherwise(_record("response", shared, F.col("payload")))
    return resolved.select(text.alias("value"))


def write_archive(resolved: DataFrame, path: str, file_records: int = FILE_RECORDS, compression: str = "gzip", file_bytes: int = FILE_BYTES) -> None:
    """Writes the records of ``resolve`` below ``path``; ``compression`` is of whole files, "none" leaves them plain.

    Payloads of up to ``file_bytes / file_records`` bytes are bounded by their number. The others go by size, doubled from class to class: of
    every so many consecutive rows of a task, as many as records of that size may share a file, those of one size share one.
    """
    least = max(1, file_bytes // file_records)
    size = F.coalesce(F.octet_length("payload"), F.lit(0))
    options = {"lineSep": _RECORD_END, "maxRecordsPerFile": file_records, "compression": compression}
    records_text(resolved.where(size <= least)).write.options(**options).text(path)
    times = F.ceil(F.log2(F.octet_length("value") / F.lit(least))).cast("int")
    in_file = F.greatest(F.lit(1), F.floor(F.lit(file_records) / F.pow(F.lit(2.0), times)).cast("long"))
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    large = records_text(resolved.where(size > least)).withColumn("part", F.concat_ws("-", times, F.floor(row / in_file)))
    large.write.options(**options).partitionBy("part").text(f"{path}/large")


def parse_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers, names in lower case, and block of each record of an archive file, which is read as a stream: one block is held at a time."""
    stream = io.BytesIO(content)
    if content[:2] == b"\x1f\x8b":
        stream = io.BufferedReader(gzip.GzipFile(fileobj=stream), 1 << 18)
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        headers = {}
        while (line := stream.readline()).strip(b"\r\n"):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        yield headers, stream.read(int(headers.get("content-length", 0)))


_HEADERS = "page_id long, url string, record_type string, named_digest string, named_response long, payload_bytes long, payload_digest string, payload binary"


def _parsed(with_payload: bool):
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = lambda x: int(x.rsplit(":", 1)[1]) if x else None
        names = [x.split()[0] for x in _HEADERS.split(", ")]
        types = [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[x.split()[1]] for x in _HEADERS.split(", ")]
        batch_of = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
        for batch in batches:
            for content in batch.column("content"):
                rows, held = [], 0
                for h, block in parse_records(content.as_py()):
                    response = h["warc-type"] == "response"
                    digest = base64.b32encode(hashlib.sha1(block).digest()).decode() if response else None
                    named = h.get("warc-payload-digest", "").rpartition(":")[2] or None
                    rows.append((number(h.get("warc-page-id")), h.get("warc-target-uri"), h["warc-type"], named, number(h.get("warc-refers-to-page-id")), len(block) if response else None, digest, block if response and with_payload else None))
                    held += len(block) if with_payload else 0
                    if len(rows) == 4096 or held >= _BATCH_BYTES:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return parse


def read_archive(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """The records of the archives below ``path``: what their headers name, and length and digest of the payload that a response holds."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content").mapInArrow(_parsed(with_payload), _HEADERS)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to: revisits take length and digest from the response with the digest they name."""
    responses = records.where("record_type = 'response'")
    originals = responses.where("payload_digest is not null").groupBy(F.col("payload_digest").alias("named_digest")).agg(F.max("payload_bytes").alias("bytes"), F.min("page_id").alias("first"))
    revisits = records.where("record_type = 'revisit'").join(originals, "named_digest", "left")
    return responses.select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to")).unionAll(
        revisits.select("page_id", F.col("bytes").alias("payload_bytes"), F.col("named_digest").alias("payload_digest"), "record_type", F.coalesce("first", "named_response").alias("refers_to"))
    )


def deduplicate(pages: DataFrame, path: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) as an archive without repeated payloads and returns what reading it back gives."""
    spark = pages.sparkSession
    path = path or shared_dir(spark, "marketweave-llm", f"warc-{uuid.uuid4().hex}")
    records = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").alias("payload"))
    write_archive(resolve(records, least_bytes), path)
    return resolve_revisits(staged(read_archive(spark, path), "headers"))
