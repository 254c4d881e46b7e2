"""WARC archives: writing, reading, and revisit records in place of repeated payloads.

An archive is written by Spark's text writer, one record per row, with the format's two line ends as
row separator, so any file system that Spark reaches will do and lost tasks are written again. It is
gzip-compressed and read back as one stream per file: the reader puts records together by their
Content-Length, so payloads may hold anything, line ends and record headers included.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatelog.llm.common import scratch, stored, utf8

#: Fixed by the WARC 1.1 format.
VERSION, VERSIONS = "WARC/1.1", (b"WARC/1.0\r\n", b"WARC/1.1\r\n")
END = b"\r\n\r\n"
SAME_PAYLOAD = "http://netpreservefoundation.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads below this size are never replaced by a revisit record.
LEAST_BYTES = 1000
#: Records to a file at most.
FILE_RECORDS = 20_000


def resolve(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Per page: page_id, url, payload (binary), payload_bytes, payload_digest, record_type, refers_to, refers_to_uri.

    Only headers are grouped by payload digest: of equal payloads of at least ``least_bytes`` the one
    with the largest key is the original, combined before the shuffle, and the pages are joined to it.
    A null payload is empty. Pages with the largest key of their group are all responses (repeated
    rows); a null key is smaller than any other, and where all keys of a group are null all are
    responses. No pages give no records.
    """
    source = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), utf8(F.col(payload)).alias("payload"))
    told = source.withColumns({"payload_digest": F.sha1("payload"), "payload_bytes": F.octet_length("payload").cast("long")})
    headers = told.where(F.col("payload_bytes") >= least_bytes).select("page_id", "url", "payload_digest")
    originals = (
        headers.groupBy("payload_digest")
        .agg(F.count("*").alias("copies"), F.max(F.struct("page_id", "url")).alias("first"))
        .where("copies > 1 and first.page_id is not null")
        .select("payload_digest", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_uri"))
    )
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return told.join(originals, "payload_digest", "left").select(
        "page_id",
        "url",
        "payload",
        "payload_bytes",
        "payload_digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first_id")).alias("refers_to"),
        F.when(again, F.col("first_uri")).alias("refers_to_uri"),
    )


def _uuid(key) -> F.Column:
    """The record id of a page: stable, so that a rewritten archive keeps its references."""
    name = F.md5(F.concat(F.lit("page:"), F.coalesce(key.cast("string"), F.lit("null"))).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(name, "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"), F.lit(">"))


def write(records: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """Writes the rows of ``resolve`` with fresh headers: full responses, and revisits without payload.

    Line ends and other controls in an address are percent-encoded, since they would end the header.
    """
    uri = F.coalesce(F.col("url"), F.lit(""))
    other = F.coalesce(F.col("refers_to_uri"), F.lit(""))
    clean = lambda c: F.regexp_replace(c, r"[\x00-\x20\x7f]", "%20")
    revisit = F.col("record_type") == "revisit"
    none = F.lit("")
    header = F.concat(
        F.lit(f"{VERSION}\r\nWARC-Type: "),
        F.col("record_type"),
        F.lit("\r\nWARC-Record-ID: "),
        _uuid(F.col("page_id")),
        F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Target-URI: "),
        clean(uri),
        F.lit("\r\nWARC-Payload-Digest: sha1:"),
        F.col("payload_digest"),
        F.when(revisit, F.concat(
            F.lit(f"\r\nWARC-Profile: {SAME_PAYLOAD}\r\nWARC-Refers-To: "),
            _uuid(F.col("refers_to")),
            F.lit("\r\nWARC-Refers-To-Target-URI: "),
            clean(other),
        )).otherwise(none),
        F.when(F.col("page_id").isNotNull(), F.concat(F.lit("\r\nPage-ID: "), F.col("page_id").cast("string"))).otherwise(none),
        F.lit("\r\nPayload-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.when(revisit, "0").otherwise(F.col("payload_bytes").cast("string")),
        F.lit("\r\n\r\n"),
    )
    body = F.when(revisit, F.lit(b"")).otherwise(F.col("payload"))
    # a cast from binary to string keeps the bytes as they are
    record = F.concat(header.cast("binary"), body).cast("string").alias("value")
    writer = records.select(record).write.option("lineSep", END.decode()).option("compression", "gzip")
    writer.option("maxRecordsPerFile", FILE_RECORDS).text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per record: record_id, page_id (string, null if absent), url, record_type, payload, payload_bytes, payload_digest, refers_to (a record id).

    A file is read as a stream by one task, which holds one record at a time. Versions 1.0 and 1.1 are read;
    records of other types than response and revisit are passed over. The payload of an HTTP response is what
    follows its head. A digest may be hexadecimal or base 32; without one it is the payload's. Payloads that do not match their
    digest, files that end within a record, and bytes that are no record raise an error.
    """
    lines = spark.read.option("lineSep", END.decode()).text(path)
    source = lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("data"))
    names = ["record_id", "page_id", "url", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to"]
    types = [pa.string(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, pending, needed = None, bytearray(), 0
        for batch in batches:
            columns: list[list] = [[] for _ in names]
            for file, data in zip(*batch.columns, strict=True):
                if file.as_py() != current:
                    ended(current, pending)
                    current, pending, needed = file.as_py(), bytearray(), 0
                pending += (data.as_py() or b"") + END
                while len(pending) > needed and pending != END:
                    if not pending.startswith(VERSIONS):
                        raise ValueError(f"{current}: no record of a known version where one should begin")
                    fields, begin, needed = head(pending)
                    if len(pending) < needed:
                        needed -= 1
                        break
                    if pending[needed - len(END) : needed] != END:
                        raise ValueError(f"{current}: a record is longer than it says")
                    if fields["warc-type"] in ("response", "revisit"):
                        for column, item in zip(columns, content(fields, pending, begin), strict=True):
                            column.append(item)
                    del pending[:needed]
                    needed = 0
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)
        ended(current, pending)

    return source.mapInArrow(
        run, "record_id string, page_id string, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to string"
    )


def ended(file: str | None, pending: bytearray) -> None:
    if pending.strip(b"\r\n"):
        raise ValueError(f"{file} ends within a record")


def head(data: bytearray) -> tuple[dict[str, str], int, int]:
    """The header fields, by lower-case name, of the record that ``data`` begins with, where its block begins and where it ends."""
    split = data.find(END)
    lines = (line.partition(":") for line in data[:split].decode().split("\r\n")[1:])
    fields = {name.strip().lower(): value.strip() for name, _, value in lines}
    begin = split + len(END)
    return fields, begin, begin + int(fields["content-length"]) + len(END)


def content(fields: dict[str, str], data: bytearray, begin: int) -> tuple:
    """The row of a record; a payload that does not match its digest raises."""
    kind, payload = fields["warc-type"], bytes(data[begin : begin + int(fields["content-length"])])
    if kind == "response" and fields.get("content-type", "").startswith("application/http"):
        payload = payload.partition(END)[2]
    own = hashlib.sha1(payload).hexdigest()
    digest = fields.get("warc-payload-digest", own).removeprefix("sha1:")
    if len(digest) == 32:
        digest = base64.b32decode(digest).hex()
    if kind == "response" and own != digest.lower():
        raise ValueError(f"payload of {fields.get('warc-record-id')} does not match its digest")
    return (
        fields.get("warc-record-id"),
        fields.get("page-id"),
        fields.get("warc-target-uri"),
        kind,
        payload if kind == "response" else None,
        int(fields.get("payload-length", len(payload))),
        digest.lower(),
        fields.get("warc-refers-to"),
    )


def joined(records: DataFrame, *wanted: str) -> DataFrame:
    """The revisits among ``records``, each with the columns ``wanted`` of its original as ``original_…``.

    A revisit is joined to the response whose record id it names, or to one of its payload digest if it
    names none. Of several such responses (repeated rows) the one with the greatest columns ``wanted``
    counts; without one they are null. Responses are one row per key before the join, and a key that
    many revisits name is split by the engine.
    """
    by_digest = F.concat(F.lit("sha1:"), F.col("payload_digest"))
    keys = F.explode(F.array("record_id", by_digest)).alias("key")
    responses = records.where("record_type = 'response'").select(keys, F.struct(*wanted).alias("own")).where(F.col("key").isNotNull())
    originals = responses.groupBy("key").agg(F.max("own").alias("own"))
    revisits = records.where("record_type = 'revisit'").withColumn("key", F.coalesce("refers_to", by_digest))
    found = revisits.join(originals, "key", "left")
    return found.select(*records.columns, *(F.col("own").getField(c).alias(f"original_{c}") for c in wanted))


def restored(spark: SparkSession, path: str) -> DataFrame:
    """Per record of the archives: record_id, page_id, url, payload; a revisit has its original's payload, or null if that is not there."""
    records = stored(read(spark, path))
    again = joined(records, "payload").withColumn("payload", F.col("original_payload"))
    columns = ["record_id", "page_id", "url", "payload"]
    return records.where("record_type = 'response'").select(*columns).unionByName(again.select(*columns))


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Archives the pages, reads the archives back, joins revisits to their originals and returns a row per record, without payloads.

    Nulls, repeated rows and empty tables as for ``resolve``; only the named columns are read.
    """
    spark = pages.sparkSession
    path = scratch(spark)
    write(resolve(pages, key, url, payload, least_bytes), path)
    kind = pages.schema[key].dataType
    records = stored(read(spark, path).drop("payload"))
    responses = records.where("record_type = 'response'").withColumn("original_page_id", F.lit(None).cast("string"))
    return responses.unionByName(joined(records, "page_id")).select(
        F.col("page_id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("original_page_id").cast(kind).alias("refers_to"),
        "url",
    )
