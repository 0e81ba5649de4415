"""WARC: pages written as request, response and metadata records, and put together again.

Writing: each page gives three records of one transaction. Of pages with equal payloads
of at least `LEAST_REVISIT` bytes, the one with the smallest id is a `response`, the
others are `revisit` records without a payload that refer to it. Request and metadata
name the record they belong to in WARC-Concurrent-To. Spark's text writer writes the
files: every record ends with a line feed, so records are lines of the writer, and
the files are plain WARC 1.0, compressed as a whole.

Files are bounded by bytes: pages of up to `LARGE_PAGE` bytes come at most `FILE_PAGES` to a
file, larger ones go to files of their own folder, as few to a file as `FILE_BYTES` asks for.

Reading: each file is unpacked as it is read, record by record, and cut by Content-Length, never by
looking for a mark in a payload. Transaction assembly then groups the records of one
read by the identifier that they share, that of the response or revisit itself and that in
WARC-Concurrent-To of the others, and emits one nested row per capture. The page's id
comes from the metadata record, its address from any of the three, all else from the response.

Defined cases: a null payload is empty; a null address is the empty one; line ends in
an address are percent-encoded; a null id is written as such and counts as the largest;
repeated pages are written each, the first as response; a capture without request, metadata or
response has null there, so a lost metadata record shows as a page without id and a lost response as a
page without payload; of records of one kind with the same identifier the smallest counts; an
empty table gives no captures; other columns are ignored.
"""

from __future__ import annotations

import gzip
import io
import re
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.operators.joins import keyed_join
from tallyfold.session import materialise

LEAST_REVISIT = 100
# Pages of at most so many bytes come FILE_PAGES to a file; of larger ones, a file holds FILE_BYTES, or one page.
FILE_PAGES, LARGE_PAGE, FILE_BYTES = 1000, 2**20, 2**30
# A batch of records that a worker hands on.
BATCH_ROWS, BATCH_BYTES = 512, 2**23
CAPTURED = "2020-01-01T00:00:00Z"
# Fixed values of the format.
VERSION, NEWLINE, BLANK = "WARC/1.0", "\r\n", "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
HTTP_OK = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
_RECORD = ("kind string, record_id string, concurrent_to string, refers_to string, "
           "target_uri string, digest string, block binary")
_ARROW = pa.schema([(c, pa.string()) for c in ("kind", "record_id", "concurrent_to", "refers_to", "target_uri", "digest")]
                   + [("block", pa.binary())])


def _text(*parts: str | Column) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _record(kind: str | Column, id: Column, headers: list[str | Column], block: Column) -> Column:
    """One record as text, but for its last line feed, which the writer adds."""
    return _text(
        f"{VERSION}{NEWLINE}WARC-Type: ", kind, f"{NEWLINE}WARC-Record-ID: <", id, f">{NEWLINE}WARC-Date: {CAPTURED}",
        *headers, f"{NEWLINE}Content-Length: ", F.octet_length(block).cast("string"), BLANK, block, "\r\n\r",
    )


def _repeats(pages: DataFrame) -> DataFrame:
    """One row per payload that several pages have: its digest and `first`, the page that is the response.

    Only what a page holds decides, no row number, so the answer is the same whenever the
    pages are read. `first.copies` counts rows that are alike in all three columns.
    """
    slim = pages.where(F.octet_length("html") >= LEAST_REVISIT)
    alike = slim.groupBy("digest", "page_id", "url_hash").agg(F.count(F.lit(1)).alias("copies"))
    page = F.struct(F.col("page_id").isNull().alias("unknown"), "page_id", "url_hash", "copies")
    groups = alike.groupBy("digest").agg(F.min(page).alias("first"), F.sum("copies").alias("n"))
    return groups.where("n > 1").drop("n")


def _capture_id(page_id: Column, rest: Column) -> Column:
    return _text("urn:capture:", F.coalesce(page_id.cast("string"), F.lit("")), ":", rest)


def _with_roles(rows: DataFrame, repeats: DataFrame, part: str) -> DataFrame:
    """Rows with `revisit`, `main` (their capture's identifier) and `target` (that of the response).

    `part` names the rows that are numbered together. A response that others refer to is named by its payload, any other capture by a number
    of its row. Rows alike in all columns come from one of them, so that exactly one is the response.
    """
    placed = keyed_join(rows, repeats, ["digest"], "left")
    first = F.col("first")
    leads = F.coalesce(F.col("page_id").eqNullSafe(first["page_id"]) & (F.col("url_hash") == first["url_hash"]), F.lit(False))
    placed = placed.withColumn("leads", first.isNotNull() & leads)
    alone = placed.where(~F.col("leads") | (first["copies"] == 1)).withColumn("copy", F.lit(0).cast("long"))
    alike = placed.where(F.col("leads") & (first["copies"] > 1)).dropDuplicates(["digest", "page_id", "url_hash"])
    alike = alike.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), first["copies"] - 1)))
    rows = alone.unionByName(alike)
    leads = F.col("leads") & (F.col("copy") == 0)
    number = F.concat_ws("-", F.lit(part), F.monotonically_increasing_id().cast("string"), F.col("copy").cast("string"))
    return rows.withColumns({
        "revisit": first.isNotNull() & ~leads,
        "main": _capture_id(F.col("page_id"), F.when(leads, F.col("digest")).otherwise(number)),
        "target": _capture_id(first["page_id"], F.col("digest")),
    })


def write_archives(pages: DataFrame, path: str, id: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Write the pages to gzip-compressed WARC files in folders of `path`: `pages`, and `large` if there are any."""
    rows = pages.select(
        F.col(id).cast("long").alias("page_id"), F.coalesce(F.col(html), F.lit("")).alias("html"),
        F.replace(F.replace(F.coalesce(F.col(url), F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")).alias("url"),
    ).withColumns({"digest": F.sha2("html", 256), "url_hash": F.xxhash64("url")})
    repeats = materialise(_repeats(rows), "warc-repeats")
    size = F.octet_length(F.col(html))
    largest = pages.agg(F.max(size)).first()[0] or 0
    is_large = F.octet_length("html") > LARGE_PAGE
    parts = [("pages", rows.where(~is_large), FILE_PAGES)]
    if largest > LARGE_PAGE:
        parts.append(("large", rows.where(is_large), max(1, FILE_BYTES // largest)))
    for part, some, per_file in parts:
        _records(_with_roles(some, repeats, part)).write.options(
            compression="gzip", lineSep="\n", maxRecordsPerFile=3 * per_file).text(f"{path}/{part}")


def _records(placed: DataFrame) -> DataFrame:
    """The three records of each page as rows of text."""
    main, revisit = F.col("main"), F.col("revisit")
    target = [f"{NEWLINE}WARC-Target-URI: ", F.col("url")]
    together = [f"{NEWLINE}WARC-Concurrent-To: <", main, ">"]
    http = f"{NEWLINE}Content-Type: application/http; msgtype="
    request = _record("request", _text(main, ":request"), [*target, *together, f"{http}request"],
                      _text("GET ", F.col("url"), f" HTTP/1.1{BLANK}"))
    digest = [f"{NEWLINE}WARC-Payload-Digest: sha256:", F.col("digest"), f"{http}response"]
    size = F.octet_length("html").cast("string")
    response = _record("response", main, [*target, *digest], _text(HTTP_OK, size, BLANK, F.col("html")))
    again = _record("revisit", main, [*target, *digest, f"{NEWLINE}WARC-Profile: {REVISIT_PROFILE}",
                                      f"{NEWLINE}WARC-Refers-To: <", F.col("target"), ">"],
                    _text(HTTP_OK, size, BLANK))
    metadata = _record("metadata", _text(main, ":metadata"),
                       [*target, *together, f"{NEWLINE}Content-Type: application/warc-fields"],
                       _text("page-id: ", F.coalesce(F.col("page_id").cast("string"), F.lit("")), NEWLINE))
    records = F.array(request, F.when(revisit, again).otherwise(response), metadata)
    return placed.select(F.explode(records).alias("value"))


_HEADER = re.compile(rb"^([^:\r\n]+): *(.*?)\r?$", re.MULTILINE)
_FIELDS = (b"warc-type", b"warc-record-id", b"warc-concurrent-to", b"warc-refers-to", b"warc-target-uri", b"warc-payload-digest")


def cut_records(file: BinaryIO) -> Iterator[tuple]:
    """(kind, record_id, concurrent_to, refers_to, target_uri, digest, block) of a WARC file, one record at a time."""
    while line := file.readline():
        lines = []
        while line.strip():
            lines.append(line)
            line = file.readline()
        if not lines:
            continue
        head = {k.lower(): v.decode() for k, v in _HEADER.findall(b"".join(lines))}
        length = int(head[b"content-length"])
        block = file.read(length)
        if len(block) < length:
            raise ValueError(f"record {head.get(b'warc-record-id')} ends after {len(block)} of {length} bytes")
        fields = [head.get(k) for k in _FIELDS]
        yield (fields[0], *[f and f.strip("<>") for f in fields[1:4]], fields[4],
               fields[5] and fields[5].removeprefix("sha256:"), block)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the WARC files in a folder and those below it."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)

        for batch in batches:
            for content in batch.column(0):
                raw, rows, held = pa.BufferReader(content.as_buffer()), [], 0
                packed = raw.read(2) == b"\x1f\x8b"
                raw.seek(0)
                for row in cut_records(io.BufferedReader(gzip.GzipFile(fileobj=raw) if packed else raw, 2**18)):
                    rows.append(row)
                    held += len(row[-1])
                    if len(rows) == BATCH_ROWS or held > BATCH_BYTES:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").options(pathGlobFilter="part-*", recursiveFileLookup="true").load(path)
    return files.select("content").mapInArrow(records, _RECORD)


def _payload(block: Column) -> Column:
    """What follows the HTTP header of a block."""
    text = block.cast("string")
    return F.substring(block, F.instr(text, BLANK) + 4, 2**31 - 1)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture, target_uri, response, request, metadata.

    `response` holds kind, refers_to, digest and block, that of a revisit without a payload. One grouping
    by the transaction's identifier, which three records share, so no key is hot.
    """
    kind = F.col("kind")
    main = kind.isin("response", "revisit")
    capture = F.when(main, F.col("record_id")).otherwise(F.coalesce("concurrent_to", "record_id"))

    def one(of: Column, *fields: str) -> Column:
        return F.min(F.when(of, F.struct(*fields)))

    other = kind.isin("request", "metadata")
    return records.where(main | other).groupBy(capture.alias("capture")).agg(
        F.min("target_uri").alias("target_uri"), one(main, "kind", "refers_to", "digest", "block").alias("response"),
        one(kind == "request", "record_id", "block").alias("request"),
        one(kind == "metadata", "record_id", "block").alias("metadata"))


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    return assemble(read_records(spark, path))


def capture_pages(captures: DataFrame) -> DataFrame:
    """Per capture: page_id, payload_bytes, payload_digest, record_type, refers_to (a page id).

    Payloads of responses are measured as read; a revisit has those of the response it
    refers to. Written once without payloads, as both sides of that look-up need it.
    """
    page = F.nullif(F.regexp_extract(F.col("metadata.block").cast("string"), r"^page-id: (-?\d+)", 1), F.lit("")).cast("long")
    # The HTTP header has only one-byte characters, so its length in characters is that in bytes.
    payload = _payload(F.col("response.block"))
    read = materialise(captures.select(
        "capture", page.alias("page_id"), F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha2(payload, 256).alias("payload_digest"), F.col("response.kind").alias("record_type"),
        F.col("response.refers_to").alias("target"),
    ), "warc-captures")
    plain = read.where("record_type IS DISTINCT FROM 'revisit'").drop("target")
    found = plain.where("record_type = 'response'").select(F.col("capture").alias("target"), F.col("page_id").alias("refers_to"),
                         F.col("payload_bytes").alias("full_bytes"), F.col("payload_digest").alias("full_digest"))
    revisits = read.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest")
    resolved = keyed_join(revisits, found, ["target"], "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return plain.withColumn("refers_to", F.lit(None).cast("long")).select(*columns).unionByName(
        resolved.withColumnsRenamed({"full_bytes": "payload_bytes", "full_digest": "payload_digest"}).select(*columns))
