import hashlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gridsight.llm import warc

SCHEMA = "page_id bigint, url string, html string, address string, payload int"


def pages():
    long, other = "ä" * 700, "x" * 1000
    return [
        (1, "http://a", long, "", 1), (5, "http://b", long, "", 1), (3, None, long, "", 1), (None, "http://n", long, "", 1),
        (9, "http://c\r\nWARC-Type: evil\t\0", other, "", 1), (9, "http://d", other, "", 1), (2, "http://e", other, "", 1),
        (4, "", "x" * 999, "", 1), (6, "http://f", "x" * 999, "", 1), (7, "http://g", None, "", 1), (8, "http://h", "", "", 1),
        (None, "u", "y" * 2000, "", 1), (None, "v", "y" * 2000, "", 1), (11, "w", "payload\r\n\r\nContent-Length: 7\r\n", "", 1),
    ]


def plain(rows):
    out = []
    for page, url, html, *_ in rows:
        body = (html or "").encode()
        same = [p for p, _, h, *_ in rows if (h or "").encode() == body]
        last = max((p for p in same if p is not None), default=None)
        revisit = len(body) >= 1000 and page != last
        out.append((page, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", last if revisit else None))
    return out


def test_round_trip(spark, folder):
    warc.write_archive(spark.createDataFrame(pages(), SCHEMA).repartition(3), folder)
    got = warc.read_archive(spark, folder)
    key = lambda r: str(tuple(r))
    fields = got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(key, fields)) == sorted(map(key, plain(pages())))
    back = [(r.page_id, bytes(r.payload)) for r in got.collect()]
    assert sorted(map(key, back)) == sorted(key((p, (h or "").encode())) for p, _, h, *_ in pages())
    assert spark.read.parquet(f"{folder}/payloads").count() == len({(h or "") for _, _, h, *_ in pages()})


def test_record_is_a_warc_record(spark, folder):
    warc.write_archive(spark.createDataFrame(pages(), SCHEMA), folder)
    for r in warc.read_archive(spark, folder).withColumn("record", warc.record_bytes()).collect():
        record = bytes(r.record)
        head, rest = record.split(b"\r\n\r\n", 1)
        lines = head.split(b"\r\n")
        fields = dict(x.split(b": ", 1) for x in lines[1:])
        assert lines[0] == b"WARC/1.1" and record.endswith(b"\r\n\r\n") and len(fields) == len(lines) - 1
        assert int(fields[b"Content-Length"]) == len(rest) - 4
        assert fields[b"WARC-Type"].decode() == r.record_type
        if r.record_type == "response":
            assert rest.split(b"\r\n\r\n", 1)[1][:-4] == bytes(r.payload)
        else:
            assert b"WARC-Refers-To" in fields and fields[b"WARC-Refers-To"] != fields[b"WARC-Record-ID"]


def test_urls_are_kept(spark, folder):
    warc.write_archive(spark.createDataFrame(pages(), SCHEMA), folder)
    urls = {r.url for r in warc.read_archive(spark, folder).collect()}
    assert {None, "", "http://a", "http://c%0D%0AWARC-Type: evil%09%00"} <= urls


def test_damage_is_an_error(spark, folder):
    warc.write_archive(spark.createDataFrame(pages(), SCHEMA), folder)
    spark.read.parquet(f"{folder}/payloads").select("address", warc._pack(F.lit(b"other")).alias("packed")).write.parquet(f"{folder}/bad")
    spark.read.parquet(f"{folder}/bad").write.mode("overwrite").parquet(f"{folder}/payloads")
    with pytest.raises(PySparkException, match="payload and header differ"):
        warc.read_archive(spark, folder).select("payload_digest").collect()


def test_empty(spark, folder):
    warc.write_archive(spark.createDataFrame([], SCHEMA), folder)
    assert warc.read_archive(spark, folder).count() == 0
