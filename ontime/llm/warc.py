"""WARC archives with revisit records for payloads that were seen before.

Headers are grouped by payload digest, every record learns the one response that keeps its payload,
and archives are written with fresh headers. Files are written and committed by Spark's own writer,
so a lost task leaves no torn archive and any file system of the cluster will do.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

LEAST = 1000  # bytes from which equal payloads are stored once
RECORDS = 2000  # per file
EPOCH = "1970-01-01T00:00:00Z"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id: Column) -> Column:
    """A UUID that follows from the page id."""
    digest = F.md5(F.concat(F.lit("page "), F.coalesce(page_id.cast("string"), F.lit("without id"))))
    parts = [F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def target(url: Column) -> Column:
    """A URL fit for a header line: blanks and control characters are percent-encoded away."""
    return F.regexp_replace(F.coalesce(url, F.lit("")), r"[\x00-\x20\x7f]+", "%20")


def headers(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest; a null payload is empty."""
    payload = F.coalesce("html", F.lit(""))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), target(F.col("url")).alias("url"),
        payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha1(payload).alias("payload_digest"),
    )


def resolve(records: DataFrame, least: int = LEAST) -> DataFrame:
    """Add keeper and keeper_url, the response that a record revisits; null for responses.

    Of equal payloads of ``least`` bytes or more the record with the largest page_id keeps it (of
    several with that id, each does); a null id is smaller than all others. Counts merge before
    the shuffle; payloads move once, in a join whose hot digests Spark splits.
    """
    large = records.filter(F.col("payload_bytes") >= least)
    keepers = large.groupBy(F.col("payload_digest").alias("_digest")).agg(
        F.max("page_id").alias("_keeper"), F.count(F.lit(1)).alias("_records"),
        F.max(F.struct("page_id", "url"))["url"].alias("_url"),
    ).filter("_records > 1 and _keeper is not null")
    joined = records.join(
        keepers,
        (F.col("payload_digest") == F.col("_digest")) & (F.col("payload_bytes") >= least), "left",
    )
    revisit = F.col("_keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_keeper"))
    return joined.select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(revisit, F.col("_keeper")).alias("keeper"), F.when(revisit, F.col("_url")).alias("keeper_url"),
    )


def record_text(date: Column) -> Column:
    """A WARC record without its final blank lines, which are the line separator of the file."""
    revisit = F.col("keeper").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"), F.lit(END),
    )
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), record_id(F.col("page_id"))),
        F.concat(F.lit("WARC-Page-ID: "), F.col("page_id").cast("string")),
        F.concat(F.lit("WARC-Target-URI: "), F.col("url")),
        F.concat(F.lit("WARC-Date: "), date),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), record_id(F.col("keeper")))),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To-Target-URI: "), F.col("keeper_url"))),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To-Date: "), date)),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END), block)


def write_archives(pages: DataFrame, folder: str, date: str = EPOCH, least: int = LEAST) -> None:
    """Write gzip-compressed archives of ``RECORDS`` records at most into a new folder.

    Other columns of ``pages`` are ignored. An empty table gives a folder without records.
    """
    resolved = resolve(headers(pages), least)
    (
        resolved.select(record_text(F.lit(date)).alias("value")).write.mode("errorifexists")
        .option("lineSep", END).option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS).text(folder)
    )


def parse(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of every record of a stream."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"a record begins with {line[:40]!r}")
        fields: dict[str, str] = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8").partition(":")
            fields[name.strip().lower()] = value.strip()
        block = stream.read(int(fields["content-length"]))
        if len(block) != int(fields["content-length"]):
            raise ValueError("the archive ends inside a record")
        yield fields, block


RECORD_SCHEMA = (
    "page_id long, record_id string, record_type string, url string, payload_bytes long, "
    "payload_digest string, refers_to_record string, payload string"
)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all archives; lengths and digests of responses are computed from payloads.

    A task holds the compressed bytes of one file and one record at a time.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows: list[tuple] = []
                held = 0
                for fields, block in parse(io.BufferedReader(gzip.open(io.BytesIO(content)))):
                    http, _, body = block.partition(END.encode())
                    length = len(body)
                    digest = hashlib.sha1(body).hexdigest()
                    if fields["warc-type"] == "revisit":
                        body, digest = None, fields["warc-payload-digest"].removeprefix("sha1:")
                        named = dict(x.lower().split(b":", 1) for x in http.split(b"\r\n")[1:])
                        length = int(named[b"content-length"])
                    page = fields.get("warc-page-id")
                    rows.append((
                        int(page) if page is not None else None, fields["warc-record-id"],
                        fields["warc-type"], fields["warc-target-uri"], length, digest,
                        fields.get("warc-refers-to"), None if body is None else body.decode("utf-8"),
                    ))
                    held += length
                    if held > 8_000_000:
                        yield frame(rows)
                        rows, held = [], 0
                yield frame(rows)

    def frame(rows: list[tuple]) -> pd.DataFrame:
        names = [field.split()[0] for field in RECORD_SCHEMA.split(", ")]
        made = pd.DataFrame(rows, columns=names)
        return made.astype({"page_id": "Int64", "payload_bytes": "Int64"})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    return files.select("content").mapInPandas(read, RECORD_SCHEMA)


def resolved_headers(records: DataFrame) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest, record_type and refers_to.

    A revisit refers to the page of the response whose record id and digest it names.
    """
    light = records.drop("payload", "url")
    responses = light.filter("record_type = 'response'").select(
        F.col("record_id").alias("_id"), F.col("payload_digest").alias("_digest"),
        F.col("page_id").alias("refers_to"),
    ).distinct()
    joined = light.join(
        responses,
        (F.col("payload_digest") == F.col("_digest")) & (F.col("refers_to_record") == F.col("_id")),
        "left",
    )
    return joined.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
