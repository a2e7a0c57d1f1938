"""Content-addressed web archive: payloads once by verified digest, exact record headers apart.

``write`` makes two tables: ``payloads`` (digest, payload) has the bytes of each distinct payload
once, ``headers`` has one row for each record with its exact header block and HTTP head. ``read``
checks every stored payload against its digest and joins the two back into the original records.
``export`` writes them as WARC 1.1 files, ``import_files`` reads such files.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SMALLEST_REVISIT = 100
CRLF = "\r\n"


def _payload(html: str) -> Column:
    return F.encode(F.coalesce(F.col(html).cast("string"), F.lit("")), "UTF-8")


def _escaped(url: Column) -> Column:
    r"""A line break would end the header: CR and LF become \r and \n, a backslash becomes two."""
    for plain, code in (("\\", "\\\\"), ("\r", "\\r"), ("\n", "\\n")):
        url = F.replace(url, F.lit(plain), F.lit(code))
    return url


def _unescaped(url: Column) -> Column:
    """The URL before ``_escaped``: what stands between double backslashes has only line breaks."""
    def codes(part: Column) -> Column:
        return F.replace(F.replace(part, F.lit("\\r"), F.lit("\r")), F.lit("\\n"), F.lit("\n"))

    return F.array_join(F.transform(F.split(url, r"\\\\", -1), codes), "\\")


def _line(name: str, *value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), *value, F.lit(CRLF))


def _http_head() -> Column:
    """The head of the HTTP message whose body is the payload, the stored text in UTF-8."""
    return F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=UTF-8{CRLF}"),
                    _line("Content-Length", F.col("payload_bytes").cast("string")), F.lit(CRLF))


def _record_id(page: Column, url: Column) -> Column:
    """Records of one page_id with another url or payload have ids of their own."""
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit("/"), F.md5(
        F.concat(F.coalesce(url.cast("string"), F.lit("")), F.lit("\n"), F.col("digest"))),
        F.lit(">"))


def _header_block(kind: Column, smallest: Column, first_url: Column, date: str) -> Column:
    """WARC 1.1 header lines of a record whose block is an HTTP message; a revisit's has no body."""
    revisit = kind == "revisit"
    target = F.coalesce(_line("WARC-Target-URI", _escaped(F.col("url").cast("string"))), F.lit(""))
    refers_to = F.concat(
        _line("WARC-Profile", F.lit(
            "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        _line("WARC-Refers-To", _record_id(smallest, first_url)))
    length = F.octet_length(_http_head()) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"), _line("WARC-Type", kind),
        _line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("url"))),
        _line("WARC-Date", F.lit(date)), target,
        _line("WARC-Payload-Digest", F.lit("sha256:"), F.col("digest")),
        F.when(revisit, refers_to).otherwise(F.lit("")),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", length.cast("string")))


def write(pages: DataFrame, folder: str, date: str | None = None) -> None:
    """Write the archive of ``pages`` (page_id, url, html) into a new ``folder``.

    date: the records' WARC-Date, as 2024-01-31T00:00:00Z; without one the time of the call.

    A null html is the empty payload; a null url has no header line. Of records with equal payloads of ``SMALLEST_REVISIT`` bytes or
    more, the one with the least page_id is the response and the others revisit it; rows that repeat
    that page_id are responses too, and so are all rows if they have no page_id. Smaller payloads are
    all responses, but stored once like any other. Other columns are left out; an empty table
    makes an empty archive. Equal digests with different bytes (compared by length and a second hash)
    raise an error. Copies are combined before the shuffle, and headers carry no payload.
    """
    spark = pages.sparkSession
    typed = pages.select("page_id", "url", _payload("html").alias("payload"))
    hashed = typed.withColumns({"digest": F.sha2("payload", 256),
                                "payload_bytes": F.octet_length("payload").cast("long")})
    second = F.xxhash64("payload")
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    first = F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url")))
    store = hashed.groupBy("digest").agg(
        F.first("payload").alias("payload"), first.alias("first"),
        F.min("payload_bytes").alias("payload_bytes"),
        (F.min(second) == F.max(second)).alias("same"),
        (F.min("payload_bytes") == F.max("payload_bytes")).alias("same_length"))
    store.withColumn("payload", F.when(F.col("same") & F.col("same_length"), F.col("payload"))
                     .otherwise(F.raise_error(F.lit("different payloads with one digest"))
                                .cast("binary"))).select(
        "digest", "payload", "first", "payload_bytes").write.parquet(f"{folder}/payloads")
    stored = spark.read.parquet(f"{folder}/payloads").select("digest", "first")
    records = hashed.select("page_id", "url", "digest", "payload_bytes").join(stored, "digest")
    smallest, first_url = F.col("first.page_id"), F.col("first.url")
    kind = F.when((F.col("payload_bytes") >= SMALLEST_REVISIT) & smallest.isNotNull()
                  & ~F.col("page_id").eqNullSafe(smallest), "revisit").otherwise("response")
    records.select(
        "page_id", "digest", _header_block(kind, smallest, first_url, date).alias("headers"),
        _http_head().alias("http_head")).write.parquet(f"{folder}/headers")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The records: page_id, headers, payload, and what headers and payload say of them.

    payload_bytes and payload_digest are taken from the stored bytes, which must have the digest that
    they are stored under; record_type, url and refers_to are parsed from the headers. ``record`` is
    the WARC record itself (a revisit's has no payload), ``original`` the bytes of headers, empty line,
    HTTP head and payload, whatever the type. Columns that aren't used cost no join bytes.
    """
    kept = spark.read.parquet(f"{folder}/payloads").select(
        F.col("digest").alias("key"), "payload", F.sha2("payload", 256).alias("own"),
        F.octet_length("payload").cast("long").alias("payload_bytes"))
    checked = kept.select("key", "payload", "payload_bytes", F.when(
        F.col("own") == F.col("key"), F.col("own")).otherwise(F.raise_error(
            F.concat(F.lit("damaged payload "), F.col("key")))).alias("payload_digest"))
    headers = spark.read.parquet(f"{folder}/headers")
    records = headers.join(checked, F.col("digest") == F.col("key"))

    def value(name: str, pattern: str = r"([^\r]*)") -> Column:
        found = F.regexp_extract("headers", rf"\n{name}: {pattern}\r\n", 1)
        return F.when(found != "", found)

    url = F.when(F.contains("headers", F.lit("\nWARC-Target-URI: ")), _unescaped(F.regexp_extract(
        "headers", r"\nWARC-Target-URI: ([^\r]*)\r\n", 1)))
    refers = value("WARC-Refers-To", "<urn:page:([^>/]*)/[^>]*>").cast(headers.schema["page_id"].dataType)
    body = F.when(F.col("record_type") == "revisit", F.lit("")).otherwise(
        F.decode("payload", "UTF-8"))
    return records.select(
        "page_id", "headers", "http_head", "payload", "payload_bytes", "payload_digest",
        value("WARC-Type").alias("record_type"), url.alias("url"),
        refers.alias("refers_to")).withColumns({
            "record": F.concat("headers", F.lit(CRLF), "http_head", body),
            "original": F.concat(F.encode(F.concat("headers", F.lit(CRLF), "http_head"), "UTF-8"),
                                 "payload")})


def export(spark: SparkSession, folder: str, target: str) -> None:
    """Write the records as WARC files: each one followed by two line ends."""
    read(spark, folder).select("record").write.option("lineSep", CRLF * 2).text(target)


def import_files(spark: SparkSession, target: str) -> DataFrame:
    """(headers, block) of the records in WARC files, as ``export`` writes them.

    A record's length is that of its Content-Length header, so its block may hold any bytes. A file is
    one task's work; one that ends inside a record, or has other bytes between records, is refused.
    """
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                data, at = content.as_buffer().to_pybytes(), 0
                headers, blocks = [], []
                while at < len(data):
                    end = data.find(b"\r\n\r\n", at)
                    head = data[at:end + 2]
                    length = re.search(rb"\nContent-Length: (\d+)\r\n", head)
                    if end < 0 or not head.startswith(b"WARC/1.1\r\n") or length is None:
                        raise ValueError(f"no WARC record at byte {at}")
                    start = end + 4
                    at = start + int(length[1])
                    if data[at:at + 4] != b"\r\n\r\n":
                        raise ValueError(f"a WARC record doesn't end at byte {at}")
                    headers.append(head.decode())
                    blocks.append(data[start:at])
                    at += 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(headers, pa.string()), pa.array(blocks, pa.binary())],
                    ["headers", "block"])

    files = spark.read.format("binaryFile").load(target).select("content")
    return files.mapInArrow(parse, "headers string, block binary")
