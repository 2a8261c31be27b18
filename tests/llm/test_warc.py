import hashlib

import pytest
from pyspark.sql import functions as F

from lakecat.llm.warc import page_number, read_archives, read_record, resolve, round_trip, write_archives
from lakecat.session import fresh_path


def pages(spark):
    long = "<p>é\r\n\r\nWARC/1.1\r\n</p>" * 20
    return spark.createDataFrame(
        [(5, "http://a/1", long, 1), (3, "http://a/2\r\nx: 100%", long, 2), (9, None, long, 3), (9, None, long, 3),
         (1, "u", None, 4), (2, "u", "", 5), (4, "u", "short", 6), (6, "u", "short", 7), (None, "u", long, 8),
         (7, "u", "z" * 3_000_000, 9), (8, "u", "z" * 3_000_000, 10), (10, "u", "y" * 100, 11), (11, "u", "y" * 100, 12)],
        "page_id long, url string, html string, payload string")


def expected(rows):
    out = []
    for key, url, html, *_ in rows:
        data = (html or "").encode()
        same = [r[0] for r in rows if (r[2] or "") == (html or "") and r[0] is not None]
        first = min(same) if same else None
        revisit = len(data) >= 100 and key is not None and key != first
        out.append((key, url, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response",
                    first if revisit else None))
    return sorted(out, key=str)


COLUMNS = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def test_round_trip(spark):
    df = pages(spark)
    got = round_trip(df)
    assert sorted(map(tuple, got.select(*COLUMNS).collect()), key=str) == expected([tuple(r) for r in df.collect()])
    texts = sorted(((r["page_id"], r["payload"]) for r in got.collect()), key=str)
    assert texts == sorted(((r["page_id"], r["html"] or "") for r in df.collect()), key=str)


def test_payloads_are_stored_once(spark):
    path = fresh_path(spark, "test-warc")
    write_archives(pages(spark), path)
    kept = read_archives(spark, path).filter("payload IS NOT NULL AND payload_bytes >= 100 AND page_id IS NOT NULL")
    assert kept.count() == kept.select("payload_digest").distinct().count() == 3


def test_headers_alone(spark):
    df = pages(spark)
    got = round_trip(df, payloads=False)
    assert "payload" not in got.columns
    assert sorted(map(tuple, got.select(*COLUMNS).collect()), key=str) == expected([tuple(r) for r in df.collect()])


def test_records_are_read_alone(spark):
    path = fresh_path(spark, "test-warc")
    index = write_archives(pages(spark), path).collect()
    assert len(index) == 13 and len({(r["file"], r["offset"]) for r in index}) == 13
    for r in index:
        record = read_record(path, r["file"], r["offset"], r["length"])
        assert page_number(record["WARC-Record-ID"]) == r["page_id"]
        if record["WARC-Type"] == "response":
            assert "sha256:" + hashlib.sha256(record["block"]).hexdigest() == record["WARC-Payload-Digest"]


def test_a_revisit_without_its_response_fails(spark):
    records = round_trip(pages(spark)).withColumn("refers_to", F.when(F.col("refers_to") == 3, F.lit(4)).otherwise(F.col("refers_to")))
    with pytest.raises(Exception, match="no response for the revisit of page 4"):
        resolve(records.checkpoint(), "payload_bytes").collect()


def test_empty(spark):
    assert round_trip(pages(spark).limit(0)).count() == 0
