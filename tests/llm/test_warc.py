"""Archives written and read back."""

from __future__ import annotations

import gzip
import hashlib
import io

from pyspark.sql import functions as F

from ontime.llm import warc
from ontime.session import scratch_path

SCHEMA = "page_id long, url string, html string"


def test_round_trip_and_revisits(spark):
    long = "é" * 600
    rows = [
        (1, "http://a/ b\r\nX: y", long), (5, None, long), (9, "http://c", long), (9, "http://c", long), (2, "u", "short"),
        (3, "u", "short"), (4, "u", None), (6, "u", ""), (None, "u", long), (7, "u", "WARC/1.1\r\n\r\n" * 200 + "\r\n\r\nWARC/1.1"),
    ]
    folder = scratch_path(spark, "warc")
    warc.write_archives(spark.createDataFrame(rows, SCHEMA).withColumn("keeper", F.lit(1)), folder)
    records = warc.read_records(spark, folder)
    found = warc.resolved_headers(records).collect()
    assert len(found) == len(rows)
    by_page = {r["page_id"]: r for r in found}
    for page, _, html in rows:
        body = (html or "").encode()
        assert by_page[page]["payload_bytes"] == len(body)
        assert by_page[page]["payload_digest"] == hashlib.sha1(body).hexdigest()
    kinds = {p: (r["record_type"], r["refers_to"]) for p, r in by_page.items()}
    assert {p: k for p, k in kinds.items() if k[0] == "revisit"} == {1: ("revisit", 9), 5: ("revisit", 9), None: ("revisit", 9)}
    assert sorted(r["payload"] for r in records.filter("page_id = 7").collect()) == [rows[-1][2]]
    content = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).collect()
    assert sum(1 for c in content for _ in warc.parse(io.BytesIO(gzip.decompress(bytes(c["content"]))))) == len(rows)


def test_empty_table(spark):
    folder = scratch_path(spark, "warc")
    warc.write_archives(spark.createDataFrame([], SCHEMA), folder)
    assert warc.resolved_headers(warc.read_records(spark, folder)).count() == 0
