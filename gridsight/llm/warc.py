"""A content-addressed WARC archive: payload bytes once, exact record headers apart.

The archive folder holds two tables. ``payloads`` has every distinct payload once, by its SHA-256, packed
with zstandard; ``headers`` has, for every record, its header block byte for byte (WARC and HTTP headers)
and the payload's address. Reading joins the two by address, unpacks, and checks length, SHA-1 and SHA-256
of the stored bytes against the header; a mismatch is an error. A record's bytes are header, payload (not
for a revisit) and two line ends.

Of records with equal payloads of at least ``MIN_REVISIT`` bytes, that with the largest page_id is the
response and the others are revisits of it; smaller ones are all responses (which share stored bytes).
Which payloads occur twice is settled on digests alone; unique payloads are never shuffled when written.

Cases: a NULL payload is empty; a NULL page_id is less than any other; rows that repeat the largest
page_id of a payload are all responses; a NULL url has no target line, and control characters in it are
percent-encoded; an empty table makes an empty archive. Other columns are not stored.
"""

from __future__ import annotations

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridsight.llm.common import kept, utf8

#: Payloads shorter than this are never written as revisits.
MIN_REVISIT = 1000
#: When the pages were fetched, where the table does not say.
CAPTURED = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEVEL = 3

_HEADERS = "header binary, address binary"
_PAYLOADS = "address binary, packed binary"


def _pack(payload: str | Column) -> Column:
    @F.arrow_udf("binary")
    def pack(payloads: pa.Array) -> pa.Array:
        compress = zstandard.ZstdCompressor(level=LEVEL).compress
        return pa.array([compress(p) for p in payloads.to_pylist()], pa.binary())

    return pack(payload)


def _unpack(packed: str | Column) -> Column:
    @F.arrow_udf("binary")
    def unpack(payloads: pa.Array) -> pa.Array:
        decompress = zstandard.ZstdDecompressor().decompress
        return pa.array([decompress(p) if p else b"" for p in payloads.to_pylist()], pa.binary())

    return unpack(packed)


def _record_id(page_id: Column, address: Column) -> Column:
    name = F.sha2(F.concat_ws("|", page_id.cast("string"), F.hex(address)), 256)
    parts = [F.substring(name, at, size) for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line, none for NULL."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _clean(url: Column) -> Column:
    for code in (0, 9, 10, 13):
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return url


def header(captured: str = CAPTURED) -> Column:
    """The exact header block of a record, from page_id, url, payload, address, record_type and
    refers_to."""
    size = F.length("payload").cast("string")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit("\r\n\r\n"))
    revisit = F.col("record_type") == "revisit"
    length = F.length(http) + F.when(revisit, 0).otherwise(F.length("payload"))
    return F.concat(
        F.lit("WARC/1.1\r\n"), _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("address"))),
        _line("WARC-Date", F.lit(captured)), _line("WARC-Target-URI", _clean(F.col("url"))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.sha1("payload"))),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("WARC-Refers-To", F.when(revisit, _record_id(F.col("refers_to"), F.col("address")))),
        _line("X-Page-ID", F.col("page_id").cast("string")),
        _line("X-Refers-To-Page-ID", F.when(revisit, F.col("refers_to").cast("string"))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", length.cast("string")), F.lit("\r\n"), http).cast("binary")


def write_archive(pages: DataFrame, folder: str, payload: str = "html", captured: str = CAPTURED) -> None:
    """Write a record for every row of ``pages`` (page_id, url and the payload column)."""
    records = pages.select("page_id", "url", utf8(payload).alias("payload")).withColumn(
        "address", F.unhex(F.sha2("payload", 256)))
    repeated = kept(
        records.groupBy("address").agg(F.count("*").alias("n"), F.max("page_id").alias("last")).where("n > 1"), "repeated")
    placed = records.join(repeated, "address", "left")
    is_last = F.col("page_id").eqNullSafe(F.col("last"))
    revisit = F.col("n").isNotNull() & (F.length("payload") >= MIN_REVISIT) & ~is_last
    typed = placed.withColumn("record_type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))).withColumn(
        "refers_to", F.when(revisit, F.col("last")))
    typed.select(header(captured).alias("header"), "address").write.mode("overwrite").parquet(f"{folder}/headers")
    once = placed.where("n IS NULL").select("address", _pack("payload").alias("packed"))
    shared = placed.where(F.col("n").isNotNull() & is_last).groupBy("address").agg(F.first("payload").alias("payload"))
    once.unionByName(shared.select("address", _pack("payload").alias("packed"))).write.mode("overwrite").parquet(
        f"{folder}/payloads")


def _field(name: str) -> Column:
    """A header's value; NULL where the record has no such line."""
    found = F.regexp_extract_all(F.col("head"), F.lit(rf"\r\n{name}: ([^\r]*)"), F.lit(1))
    return F.try_element_at(found, F.lit(1))


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Every record with its header block, parsed fields, and full payload, also for revisits."""
    headers = spark.read.schema(_HEADERS).parquet(f"{folder}/headers")
    payloads = spark.read.schema(_PAYLOADS).parquet(f"{folder}/payloads")
    joined = headers.join(payloads, "address", "left").withColumn("payload", _unpack(F.coalesce("packed", F.lit(b""))))
    fields = joined.withColumn("head", F.col("header").cast("string")).select(
        "header", "payload", "address",
        _field("X-Page-ID").cast("bigint").alias("page_id"), _field("WARC-Target-URI").alias("url"),
        _field("WARC-Type").alias("record_type"), _field("X-Refers-To-Page-ID").cast("bigint").alias("refers_to"),
        F.substring(_field("WARC-Payload-Digest"), 6, 40).alias("digest"),
        F.regexp_extract("head", r"\r\n\r\n(?s:.*)\r\nContent-Length: ([0-9]+)", 1).cast("bigint").alias("size"))
    whole = ((F.sha1("payload") == F.col("digest")) & (F.sha2("payload", 256) == F.lower(F.hex("address")))
             & (F.length("payload") == F.col("size")))
    checked = F.when(whole, F.col("digest")).otherwise(
        F.raise_error(F.concat(F.lit("payload and header differ at "), F.hex("address"))))
    return fields.select(
        "page_id", "url", "record_type", "refers_to", "header", "payload",
        F.length("payload").cast("bigint").alias("payload_bytes"), checked.alias("payload_digest"))


def record_bytes() -> Column:
    """A record of ``read_archive`` as it stands in a WARC file."""
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return F.concat(F.col("header"), body, F.lit(b"\r\n\r\n"))
