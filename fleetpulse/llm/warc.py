"""WARC archives: written from pages, read back, and assembled into one nested row per capture.

A capture is a request, a response (or a revisit of an earlier payload) and a metadata record; the request and the
metadata name the response or revisit in WARC-Concurrent-To. Archives are written by Spark's text writer, whose
committer leaves out what a lost executor half wrote, and may lie on any file system that Spark knows. A file holds a
bounded number of records.

Pages whose payload is at least `min_revisit_bytes` long and equal to that of a page with a larger page_id revisit that
one; pages that share the largest page_id are all responses. Null html: an empty payload. Null url: no target. Null
page_id: smaller than any other, and null again when read. Very long payloads: one record, held by a worker together with
the rest of its file. Rows that repeat in all three columns are one capture that is
written, and returned, as often as it is given. An empty table gives an empty archive. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm.common import ship_package, stored
from fleetpulse.session import shared_dir

MIN_REVISIT_BYTES = 1000
#: Records of a file, at most: a file is read as a whole.
FILE_RECORDS = 6000
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = (
    "record_id string, record_type string, target_uri string, concurrent_to string, refers_to string, "
    "payload_digest string, payload_bytes long, fields map<string,string>, block binary"
)


def _record(kind: str, record_id: Column, headers: list[tuple[str, Column]], block: Column) -> Column:
    """One record without its last newline, which the text writer adds. Null headers are left out."""
    lines = [F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")) for name, value in headers]
    return F.concat(
        F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Date: {DATE}\r\nWARC-Record-ID: "),
        record_id,
        F.lit("\r\n"),
        *[F.coalesce(line, F.lit("")) for line in lines],
        F.lit("Content-Length: "),
        F.octet_length(block).cast("string"),
        F.lit("\r\n\r\n"),
        block,
        F.lit("\r\n\r"),
    )


def _urn(kind: str, *of: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.lit(kind), *of))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def write_archives(pages: DataFrame, path: str, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Write the three records of each page (page_id, url, html) below the path, gzipped."""
    text = F.coalesce(F.col("html").cast("string"), F.lit(""))
    page = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        # A line break in an address would end its header.
        F.regexp_replace(F.regexp_replace(F.col("url").cast("string"), "\r", "%0D"), "\n", "%0A").alias("url"),
        text.alias("html"),
    ).select("*", F.sha1(F.col("html").cast("binary")).alias("digest"), F.octet_length("html").alias("bytes"))
    groups = (
        page.where(F.col("bytes") >= min_revisit_bytes)
        .groupBy("digest")
        .agg(F.max(F.struct("page_id", "url")).alias("held"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "held")
    )
    page = page.join(groups, "digest", "left")

    def identity(page_id: Column, url: Column) -> Column:
        return _urn(
            "capture",
            F.coalesce(page_id.cast("string"), F.lit("-")),
            F.coalesce(F.concat(F.lit("="), url), F.lit("-")),
            F.col("digest"),
        )

    own = identity(F.col("page_id"), F.col("url"))
    revisit = F.coalesce(~F.col("page_id").eqNullSafe(F.col("held.page_id")) & F.col("held").isNotNull(), F.lit(False))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"),
        F.lit("\r\n\r\n"),
    )
    target = ("WARC-Target-URI", F.col("url"))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    capture = F.when(
        revisit,
        _record(
            "revisit",
            own,
            [
                target,
                ("WARC-Refers-To", identity(F.col("held.page_id"), F.col("held.url"))),
                ("WARC-Profile", F.lit(REVISIT_PROFILE)),
                digest,
                ("Content-Type", F.lit("application/http;msgtype=response")),
            ],
            http,
        ),
    ).otherwise(
        _record(
            "response",
            own,
            [target, digest, ("Content-Type", F.lit("application/http;msgtype=response"))],
            F.concat(http, F.col("html")),
        )
    )
    parts = F.regexp_extract(F.col("url"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)([^#]*)", 1), F.regexp_extract(
        F.col("url"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)([^#]*)", 2
    )
    get = F.concat(
        F.lit("GET "),
        F.when(F.coalesce(parts[1], F.lit("")) == "", F.lit("/")).otherwise(parts[1]),
        F.lit(" HTTP/1.1\r\nHost: "),
        F.coalesce(parts[0], F.lit("")),
        F.lit("\r\n\r\n"),
    )
    request = _record(
        "request",
        _urn("request", own),
        [target, ("WARC-Concurrent-To", own), ("Content-Type", F.lit("application/http;msgtype=request"))],
        get,
    )
    about = _record(
        "metadata",
        _urn("metadata", own),
        [target, ("WARC-Concurrent-To", own), ("Content-Type", F.lit("application/warc-fields"))],
        F.coalesce(F.concat(F.lit("pageId: "), F.col("page_id").cast("string"), F.lit("\r\n")), F.lit("\r\n")),
    )
    records = page.select(F.explode(F.array(request, capture, about)).alias("value"))
    (
        records.write.option("compression", "gzip")
        .option("maxRecordsPerFile", FILE_RECORDS)
        .option("lineSep", "\n")
        .text(path)
    )


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an archive, plain or gzipped in one or many members."""
    if content[:2] == b"\x1f\x8b":
        members, rest = [], content
        while rest:
            unzip = zlib.decompressobj(wbits=31)
            members.append(unzip.decompress(rest))
            rest = unzip.unused_data
        content = b"".join(members)
    at = 0
    while at < len(content):
        if content[at : at + 2] == b"\r\n":  # between records
            at += 2
            continue
        end = content.find(b"\r\n\r\n", at)
        if end < 0 or content[at : at + 5] != b"WARC/":
            raise ValueError(f"no WARC record at byte {at}")
        headers: dict[str, str] = {}
        last = None
        for line in content[at:end].decode("utf-8", "replace").split("\r\n")[1:]:
            if line[:1] in " \t" and last:  # a folded header
                headers[last] += " " + line.strip()
                continue
            name, _, value = line.partition(":")
            last = name.strip().lower()
            headers[last] = value.strip()
        size = int(headers["content-length"])
        block = content[end + 4 : end + 4 + size]
        if len(block) < size:
            raise ValueError(f"the record at byte {at} is cut off")
        yield headers, block
        at = end + 4 + size


def _fields(block: bytes) -> dict[str, str]:
    """Named lines of a block of warc-fields or of HTTP headers."""
    out = {}
    for line in block.decode("utf-8", "replace").split("\r\n"):
        name, colon, value = line.partition(":")
        if colon:
            out[name.strip().lower()] = value.strip()
    return out


def _row(headers: dict[str, str], block: bytes, blocks: bool) -> dict:
    kind = headers.get("warc-type")
    http, _, payload = block.partition(b"\r\n\r\n")
    fields, size = {}, None
    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if kind == "metadata":
        fields = _fields(block)
    elif kind in ("request", "response", "revisit"):
        fields = _fields(http)
    if kind == "response":
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    elif kind == "revisit" and fields.get("content-length", "").isdigit():
        size = int(fields["content-length"])
    return {
        "record_id": headers.get("warc-record-id"),
        "record_type": kind,
        "target_uri": headers.get("warc-target-uri"),
        "concurrent_to": headers.get("warc-concurrent-to"),
        "refers_to": headers.get("warc-refers-to"),
        "payload_digest": digest,
        "payload_bytes": size,
        "fields": list(fields.items()),
        "block": block if blocks else None,
    }


def read_records(spark: SparkSession, path: str, blocks: bool = True) -> DataFrame:
    """One row per record of the archives below the path; blocks: with their contents."""
    ship_package(spark)
    schema = pa.schema(
        [
            *[(c, pa.string()) for c in ("record_id", "record_type", "target_uri", "concurrent_to", "refers_to", "payload_digest")],
            ("payload_bytes", pa.int64()),
            ("fields", pa.map_(pa.string(), pa.string())),
            ("block", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files in batches:
            for content in files["content"]:
                found: list[dict] = []
                for headers, block in parse(content.as_py()):
                    found.append(_row(headers, block, blocks))
                    if len(found) == 500:
                        yield pa.RecordBatch.from_pylist(found, schema)
                        found = []
                yield pa.RecordBatch.from_pylist(found, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, and the structs request, response (or revisit) and metadata.

    Records that name no other stand for their own capture; a capture that was written n times comes n times.
    """
    held = F.struct(*[c for c in records.columns if c != "concurrent_to"])
    kind = F.col("record_type")
    one = records.withColumn("capture_id", F.coalesce("concurrent_to", "record_id")).groupBy("capture_id")
    rows = one.agg(
        F.first(F.when(kind == "request", held), ignorenulls=True).alias("request"),
        F.first(F.when(kind.isin("response", "revisit"), held), ignorenulls=True).alias("response"),
        F.first(F.when(kind == "metadata", held), ignorenulls=True).alias("metadata"),
        F.count(F.when(kind.isin("response", "revisit"), True)).alias("_n"),
    ).where("_n > 0")
    return rows.withColumn("_n", F.explode(F.array_repeat(F.lit(0), F.col("_n").cast("int")))).drop("_n")


def captures(spark: SparkSession, path: str, blocks: bool = True) -> DataFrame:
    """The captures below a path with their page, and for revisits the page whose payload they share (refers_to_page)."""
    assembled = stored(
        assemble(read_records(spark, path, blocks)).withColumn("page_id", F.col("metadata.fields")["pageid"].cast("long")),
        "captures",
    )
    first = assembled.where("response.refers_to is null").withColumn("refers_to_page", F.lit(None).cast("long"))
    again = assembled.where("response.refers_to is not null").withColumn("_to", F.col("response.refers_to"))
    held = assembled.where("response.record_type = 'response'").select(
        F.col("capture_id").alias("_to"), F.col("page_id").alias("refers_to_page")
    )
    # Captures that were written more than once are one page.
    held = held.groupBy("_to").agg(F.max("refers_to_page").alias("refers_to_page"))
    return first.unionByName(again.join(held, "_to", "left").drop("_to"))


def archive_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/llm/warc-{uuid.uuid4().hex}"
