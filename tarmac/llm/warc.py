"""Content-addressed WARC archive.

An archive is two tables.  ``payloads`` holds the bytes of every distinct
payload once, under their SHA-256; ``headers`` holds the exact header block of
every record beside the digest of its payload.  Records are rebuilt by joining
the two.  The join recomputes each payload's digest, so that a damaged or
swapped payload ends the query instead of entering a record.

* Payload bytes are shuffled once to be stored (equal ones are merged before
  the shuffle) and once to be joined; which record is the response of a group
  of copies is found on digests alone.
* A payload that a third of all records carry is one stored row; its headers
  are many rows of one join key, which adaptive execution splits.
"""

from __future__ import annotations

import gzip
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, table
from .registry import query

# fixed values of the WARC 1.1 format
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"
DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

#: date of records whose table has none
NO_DATE = "1970-01-01T00:00:00Z"
#: records in one written file
FILE_RECORDS = 20_000


class Archive(NamedTuple):
    headers: DataFrame    # page_id, digest, header
    payloads: DataFrame   # digest, payload


def base32(hexed: Column) -> Column:
    """Upper-case base 32 (RFC 4648) of 160 bits given as 40 hexadecimal digits."""
    parts = [F.lpad(F.conv(F.substring(hexed, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), DIGITS, BASE32)


def _record_id(page_id: Column, rid: Column) -> Column:
    h = F.md5(F.concat_ws("/", F.coalesce(page_id.cast("string"), F.lit("-")), rid.cast("string")))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """One header line; none if the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def _field(header: Column, name: str) -> Column:
    found = F.regexp_extract(header, rf"\r\n{name}: ([^\r]*)", 1)
    return F.when(found != "", found)


def archive(pages: DataFrame, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html",
            min_bytes: int = 0, date: str = NO_DATE, content_type: str = "text/html") -> Archive:
    """Write one record per row of ``pages`` to a new archive.

    Of records with equal payloads of at least ``min_bytes`` bytes the one with
    the smallest id (null ids are larger than any; among equal ids one of the
    rows) is a ``response``, the others are ``revisit`` records without a
    block; records with smaller payloads are all responses.  A null payload is
    an empty one, a null URI leaves its header line out, line breaks in a URI
    are written as ``%0D`` and ``%0A``.  Payloads may be text (stored as
    UTF-8) or binary.  Other columns are ignored.
    """
    scratch = Scratch(pages.sparkSession, "warc")
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("binary"), F.lit(b""))
    digest = F.unhex(F.sha2(payload, 256))
    uri = F.replace(F.replace(F.col(f"`{uri_col}`").cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    entries = scratch.keep(pages.select(
        F.monotonically_increasing_id().alias("rid"), F.col(f"`{id_col}`").alias("page_id"), uri.alias("uri"),
        digest.alias("digest"), base32(F.sha1(payload)).alias("sha1"), F.octet_length(payload).cast("long").alias("bytes")),
        "entries")
    # distinct on the bytes as well: equal payloads are merged, two payloads of one digest would stay two rows
    payloads = scratch.keep(pages.select(digest.alias("digest"), payload.alias("payload")).distinct(), "payloads")
    if not payloads.groupBy("digest").count().filter("count > 1").isEmpty():
        raise ValueError("two payloads share a SHA-256 digest")
    by_id = (entries.filter(F.col("bytes") >= min_bytes).groupBy("digest", "page_id")
             .agg(F.min("rid").alias("first_rid"), F.count("*").alias("n")))
    copied = by_id.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.sum("n").alias("n")).filter("n > 1")
    lead = copied.select(F.col("digest").alias("d"), "first_id").join(
        by_id, (F.col("d") == by_id["digest"]) & F.col("first_id").eqNullSafe(by_id["page_id"]))
    met = entries.join(lead.select("d", "first_id", "first_rid"), entries["digest"] == F.col("d"), "left")
    again = F.col("first_rid").isNotNull() & (F.col("first_rid") != F.col("rid"))
    header = F.concat(
        F.lit(VERSION + CRLF), _line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("rid"))), _line("WARC-Target-URI", F.col("uri")),
        _line("WARC-Date", F.lit(date)), _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        F.when(again, F.concat(
            _line("WARC-Profile", F.lit(PROFILE)),
            _line("WARC-Refers-To", _record_id(F.col("first_id"), F.col("first_rid"))),
            _line("Refers-To-Page", F.col("first_id").cast("string")))).otherwise(""),
        _line("Page-ID", F.col("page_id").cast("string")), _line("Content-Type", F.lit(content_type)),
        _line("Content-Length", F.when(again, F.lit(0)).otherwise(F.col("bytes")).cast("string")), F.lit(CRLF))
    headers = scratch.keep(met.select("page_id", "digest", header.cast("binary").alias("header")), "headers")
    return Archive(headers, payloads)


def records(store: Archive) -> DataFrame:
    """(page_id, record, payload): the original records, rebuilt from headers and verified payloads.

    ``record`` is the whole WARC record, ``payload`` the full payload also of
    a revisit record.
    """
    sound = F.when(F.unhex(F.sha2("payload", 256)) == F.col("digest"), F.col("payload")).otherwise(
        F.raise_error(F.lit("a stored payload does not have its digest")))
    whole = store.headers.join(store.payloads, "digest").select("page_id", "header", sound.alias("payload"))
    block = F.when(_field(F.col("header").cast("string"), "WARC-Type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return whole.select("page_id", F.concat("header", block, F.lit((CRLF * 2).encode())).alias("record"), "payload")


def parsed(found: DataFrame) -> DataFrame:
    """Columns of ``found(record)`` and the fields of its records: record_type, record_id, uri, date, payload_digest,
    refers_to_id, refers_to, content_length, block.  A field that a record lacks is null."""
    text = F.substring_index(F.col("record").cast("string"), CRLF * 2, 1)
    head = F.octet_length(text) + 4
    length = _field(text, "Content-Length").cast("int")
    return found.withColumns({
        "record_type": _field(text, "WARC-Type"), "record_id": _field(text, "WARC-Record-ID"),
        "uri": _field(text, "WARC-Target-URI"), "date": _field(text, "WARC-Date"),
        "payload_digest": F.regexp_replace(_field(text, "WARC-Payload-Digest"), "^sha1:", ""),
        "refers_to_id": _field(text, "WARC-Refers-To"), "refers_to": _field(text, "Refers-To-Page").cast("long"),
        "content_length": length.cast("long"), "block": F.substring(F.col("record"), head + 1, length)})


def write_files(found: DataFrame, path: str, compression: str | None = None, file_records: int = FILE_RECORDS) -> None:
    """Write ``found(record)`` as WARC files of at most ``file_records`` records each, straight from the tasks.

    Every record ends with two line breaks, so it is a line of a text sink
    with that separator.  ``compression`` is one of the text sink's codecs.
    """
    line = F.expr("substring(record, 1, octet_length(record) - 4)").cast("string")
    out = found.select(line.alias("value")).write.option("lineSep", CRLF * 2).option("maxRecordsPerFile", file_records)
    (out.option("compression", compression) if compression else out).text(path)


def _cut(frames):
    """Records of whole files, by their Content-Length."""
    for pdf in frames:
        for data in pdf["content"]:
            data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
            at, found = 0, []
            while data.startswith(b"WARC/", at):
                head = data.index(b"\r\n\r\n", at) + 4
                length = next(int(x.partition(b":")[2]) for x in data[at:head].split(b"\r\n")
                              if x.lower().startswith(b"content-length:"))
                found.append(data[at:head + length + 4])
                at = head + length + 4
            if at < len(data):
                raise ValueError(f"no record at byte {at}")
            yield pd.DataFrame({"record": found})


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(record) of the WARC files (plain or gzip, one or many members) in a folder; a file is read by one task."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(_cut, "record binary")


ORACLE_SQL = """
SELECT page_id, strlen(html) AS payload_bytes,
  (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
     1 + ((CAST('0x' || substr(sha1(html), 5 * (i // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31)::INT, 1), ''
     ORDER BY i) FROM range(32) t(i)) AS payload_digest,
  CASE WHEN nth = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN nth > 1 THEN first_id END AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS html, row_number() OVER w AS nth, first_value(page_id) OVER w AS first_id
  FROM pages WINDOW w AS (PARTITION BY coalesce(html, '') ORDER BY page_id NULLS LAST))
"""


@query("op11_content_addressed_warc", ORACLE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = parsed(records(archive(table(spark, sf_dir, "pages"))))
    sha1 = base32(F.sha1("payload"))
    checked = F.when(F.col("payload_digest") == sha1, sha1).otherwise(F.raise_error(F.lit("payload and header differ")))
    return back.select("page_id", F.octet_length("payload").cast("long").alias("payload_bytes"),
                       checked.alias("payload_digest"), "record_type", "refers_to")
