import hashlib

import pytest
from pyspark.sql import functions as F

from trailmill.llm import warc


def archive(spark, tmp_path, rows, schema="page_id long, url string, html string, digest string, payload int"):
    pages = spark.createDataFrame(rows, schema)
    path = str(tmp_path / "archive")
    warc.write_archive(pages, path, "page_id", "url", "html")
    return path


def test_records_come_back_with_exact_bytes(spark, tmp_path):
    big = "é" * 60
    rows = [(3, "http://c", big, "x", 1), (1, "http://a\r\nX: y", big, "x", 1), (2, None, "small", "x", 1), (4, "u", "small", "x", 1), (5, "u", None, "x", 1), (6, "u", "", "x", 1)]
    path = archive(spark, tmp_path, rows)
    found = {r["record_id"]: r for r in warc.read_archive(spark, path).withColumn("record", warc.record_bytes()).collect()}
    assert len(found) == 6
    for page_id, _, html, *_ in rows:
        payload, r = (html or "").encode(), found[page_id]
        head, _, rest = bytes(r["record"]).partition(b"\r\n\r\n")
        assert rest == payload + b"\r\n\r\n" and f"Content-Length: {len(payload)}".encode() in head
        assert r["payload_digest"] == hashlib.sha256(payload).hexdigest() and r["payload_bytes"] == len(payload)
    assert b"WARC-Type: revisit" in bytes(found[3]["header"]) and b"WARC-Refers-To: <urn:page:1>" in bytes(found[3]["header"])
    assert all(b"WARC-Type: response" in bytes(found[i]["header"]) for i in (1, 2, 4, 5, 6))
    assert bytes(found[1]["header"]).count(b"\r\nX:") == 0
    assert spark.read.parquet(f"{path}/payloads").count() == 3


def test_null_ids_and_repeated_rows(spark, tmp_path):
    big = "x" * 200
    rows = [(None, "u", big, "x", 1), (1, "u", big, "x", 1), (1, "u", big, "x", 1), (None, "u", "y" * 100, "x", 1)]
    path = archive(spark, tmp_path, rows)
    kinds = warc.read_archive(spark, path).select("record_id", warc.header_field(F.col("header"), "WARC-Type").alias("t")).collect()
    assert sorted(map(tuple, kinds), key=str) == sorted([(None, "revisit"), (1, "response"), (1, "response"), (None, "response")], key=str)


def test_empty_table(spark, tmp_path):
    assert warc.read_archive(spark, archive(spark, tmp_path, [])).count() == 0


def test_damaged_payload_is_an_error(spark, tmp_path):
    path = archive(spark, tmp_path, [(1, "u", "z" * 150, "x", 1)])
    stored = spark.read.parquet(f"{path}/payloads")
    other = str(tmp_path / "other")
    stored.withColumn("payload", F.lit("changed").cast("binary")).write.parquet(f"{other}/payloads")
    spark.read.parquet(f"{path}/records").write.parquet(f"{other}/records")
    with pytest.raises(Exception, match="does not match"):
        warc.read_archive(spark, other).select("payload_digest", "payload").collect()
