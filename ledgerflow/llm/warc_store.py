"""Content-addressed WARC archive.

An archive is a folder of two Parquet tables.  ``payloads`` holds the bytes of
each different payload once, under its SHA-256; ``headers`` holds the exact bytes
around it for each record (WARC fields, HTTP head, end of record).  Whole records
come back, byte for byte, by joining the two.  The digest is verified on both
ways: rows that share one are compared in full when they are written, and every
payload is hashed again when it is read.

Pages become ``response`` records.  Of equal payloads of at least ``smallest``
bytes, the row with the largest id (of one id: one row) is the response and the
others are ``revisit`` records of it, which hold no payload of their own; smaller
payloads are all responses, though stored once as well.

A payload that a third of all rows share is no hot key: copies collapse before
the shuffle, and rows look up what belongs to their digest by (digest, one of
``SPREAD`` salts), for which only as many rows are made as there are salts.

Defined results: a null payload is empty; a null url is left out of the record,
line breaks and other controls in it become ``%XX``; a null id is smaller than
others and stays null; repeated rows are records of their own; other columns are
ignored; an empty table gives an empty archive.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.common import stored
from ledgerflow.session import checkpoint_dir

#: Salts that the rows of one digest are dealt over.
SPREAD = 32
END = "\r\n\r\n"
_HEADERS = "id long, row long, digest string, embedded boolean, header binary, tail binary"
_PAYLOADS = "digest string, payload binary"


def _for_each(many: DataFrame, one: DataFrame, key: str) -> DataFrame:
    """``many`` with the columns of ``one`` (a row a key); ``many`` is a stored table with a ``row`` number."""
    many = many.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SPREAD)))
    return many.join(many.select(key, "salt").distinct().join(one, key), [key, "salt"]).drop("salt")


def _distinct_payloads(rows: DataFrame) -> DataFrame:
    """(digest, payload): one row a digest, after a full comparison of all payloads that have it."""
    low, high = F.min("payload").alias("low"), F.max("payload").alias("high")
    same = F.when(F.col("low") == F.col("high"), F.col("low")) \
        .otherwise(F.raise_error(F.concat(F.lit("different payloads with digest "), F.col("digest"))).cast("binary"))
    return rows.groupBy("digest").agg(low, high).select("digest", same.alias("payload"))


def _new_folder(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark)}/llm-warc-{uuid.uuid4().hex}"


def _digest(payload: Column) -> Column:
    return F.sha2(payload, 256)


# -- pages as records ---------------------------------------------------------------

def _record_id(digest: str, row: str) -> Column:
    h = F.sha2(F.concat_ws("|", digest, row), 256)
    at = [(1, 8), (9, 4), (14, 3), (18, 3), (21, 12)]
    a, b, c, d, e = (F.substring(h, k, n) for k, n in at)
    return F.concat(F.lit("<urn:uuid:"), a, F.lit("-"), b, F.lit("-8"), c, F.lit("-8"), d, F.lit("-"), e, F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A field, or nothing if the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))


def _clean_url(url: Column) -> Column:
    parts = F.transform(F.split(url.cast("string"), ""), lambda c: F.when(
        c.rlike(r"[\x00-\x20\x7F]"), F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(c)), 2, "0"))).otherwise(c))
    return F.when(url.rlike(r"[\x00-\x20\x7F]"), F.array_join(parts, "")).otherwise(url.cast("string"))


def archive_pages(df: DataFrame, path: str | None = None, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", smallest: int = 1000, date: str = "2000-01-01T00:00:00Z") -> str:
    """Write one record per row of ``df``; returns the archive's folder (``path``, or a new one in the shared folder)."""
    path = path or _new_folder(df.sparkSession)
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary"))
    pages = df.select(F.col(id_col).cast("long").alias("id"), _clean_url(F.col(url_col)).alias("url"), payload.alias("payload"))
    digested = pages.withColumn("digest", _digest(F.col("payload")))
    _distinct_payloads(digested.select("digest", "payload")).write.parquet(f"{path}/payloads")

    # row numbers hold for the stored table only, so that is what everything below reads
    marks = stored(digested.select("id", "url", "digest", F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("size"),
                                   F.monotonically_increasing_id().alias("row")), "warc-marks")
    large = marks.filter(F.col("size") >= smallest).withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SPREAD)))
    some = large.groupBy("digest", "salt").agg(F.max(F.struct("id", "row")).alias("last"), F.count(F.lit(1)).alias("n"))
    first = some.groupBy("digest").agg(F.max("last").alias("last"), F.sum("n").alias("n")).filter("n > 1").select("digest", "last")
    # rows of one digest meet their response under its salts; most rows are alone and have none
    known = some.select("digest", "salt").join(first, "digest")
    rows = marks.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SPREAD))).join(known, ["digest", "salt"], "left")
    revisit = F.col("last").isNotNull() & (F.col("last.row") != F.col("row")) & (F.col("size") >= smallest)

    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), _line("Content-Length", F.col("size")), F.lit("\r\n"))
    whole = F.length("http") + F.when(revisit, 0).otherwise(F.col("size"))
    fields = F.concat(
        F.lit("WARC/1.1\r\n"), _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id("digest", "row")), _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")), _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _line("Page-Id", F.col("id")),
        F.when(revisit, F.concat(
            _line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            _line("WARC-Refers-To", _record_id("digest", "last.row")), _line("Refers-To-Page-Id", F.col("last.id")))).otherwise(""),
        _line("Content-Type", F.lit("application/http; msgtype=response")), _line("Content-Length", whole), F.lit("\r\n"))
    rows.withColumn("http", http).select(
        "id", "row", "digest", (~revisit).alias("embedded"), F.concat(fields, F.col("http")).cast("binary").alias("header"),
        F.lit(END).cast("binary").alias("tail")).write.parquet(f"{path}/headers")
    return path


# -- records as they come -----------------------------------------------------------

def _split(record: Column) -> dict[str, Column]:
    """Columns header, payload, tail of a record; joined they are the record, whatever its bytes.  The HTTP
    head of an ``application/http`` block belongs to the header.  A record without the end of its fields
    is all header."""
    text = F.decode(record, "ISO-8859-1")              # a character for each byte
    fields = F.locate(END, text)
    block = fields + len(END)
    inside = F.substring(text, F.lit(1), fields)
    http = F.when(inside.rlike(r"(?i)\r\ncontent-type:\s*application/http"), F.locate(END, text))
    http = F.when(http.isNotNull(), F.instr(F.substr(text, block), END))
    length = F.coalesce(F.regexp_extract(inside, r"(?i)\r\ncontent-length:\s*(\d{1,18})", 1).try_cast("long"), F.lit(0))
    head = F.when(fields == 0, F.octet_length(record)).otherwise(block - 1 + F.when(http > 0, http + len(END) - 1).otherwise(0))
    size = F.when(fields == 0, 0).otherwise(F.greatest(length - (head - block + 1), F.lit(0)))
    head, size = head.cast("int"), F.least(size, F.octet_length(record) - head).cast("int")
    return {"header": F.substr(record, F.lit(1), head), "payload": F.substr(record, head + 1, size),
            "tail": F.substr(record, head + size + 1)}


def archive_records(df: DataFrame, path: str | None = None, id_col: str = "id", record_col: str = "record") -> str:
    """Archive whole WARC records (one binary value a row); null counts as an empty record."""
    path = path or _new_folder(df.sparkSession)
    record = F.coalesce(F.col(record_col).cast("binary"), F.lit("").cast("binary"))
    parts = df.select(F.col(id_col).cast("long").alias("id"), *[c.alias(n) for n, c in _split(record).items()]) \
        .withColumn("digest", _digest(F.col("payload")))
    _distinct_payloads(parts.select("digest", "payload")).write.parquet(f"{path}/payloads")
    parts.select("id", F.monotonically_increasing_id().alias("row"), "digest", F.lit(True).alias("embedded"), "header", "tail") \
        .write.parquet(f"{path}/headers")
    return path


# -- reading ------------------------------------------------------------------------

def _table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.schema({"headers": _HEADERS, "payloads": _PAYLOADS}[name]).parquet(f"{path}/{name}")


def _payloads(spark: SparkSession, path: str) -> DataFrame:
    """The payload table; a payload that is not what its digest says ends the job."""
    fail = F.raise_error(F.concat(F.lit("payload damaged: "), F.col("digest"))).cast("binary")
    return _table(spark, path, "payloads").select(
        "digest", F.when(_digest(F.col("payload")) == F.col("digest"), F.col("payload")).otherwise(fail).alias("payload"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """(id, row, record): every record as it was, byte for byte."""
    found = _for_each(_table(spark, path, "headers"), _payloads(spark, path), "digest")
    body = F.when(F.col("embedded"), F.col("payload")).otherwise(F.lit("").cast("binary"))
    return found.select("id", "row", F.concat("header", body, "tail").alias("record"))


def originals(spark: SparkSession, path: str) -> DataFrame:
    """(id, url, payload) of every page, those of revisits taken from their response."""
    found = _for_each(_table(spark, path, "headers"), _payloads(spark, path), "digest")
    return found.select("id", field("WARC-Target-URI").alias("url"), "payload")


def field(name: str, header: str = "header") -> Column:
    """A field of the WARC header; null if it isn't there."""
    found = F.regexp_extract(F.col(header).cast("string"), rf"\r\n{name}: ([^\r]*)\r\n", 1)
    return F.when(found != "", found)


def listing(spark: SparkSession, path: str) -> DataFrame:
    """Per record of archived pages: page_id, payload_bytes, payload_digest, record_type, refers_to.  Size and digest are
    taken from the stored payload; a header that says otherwise ends the job."""
    facts = _payloads(spark, path).select("digest", F.octet_length("payload").cast("long").alias("payload_bytes"),
                                          F.sha1("payload").alias("payload_digest"))
    found = _for_each(_table(spark, path, "headers"), facts, "digest")
    said = F.concat(F.lit("sha1:"), F.col("payload_digest"))
    checked = F.when(field("WARC-Payload-Digest") == said, F.col("payload_digest")) \
        .otherwise(F.raise_error(F.concat(F.lit("header and payload differ: "), said)).cast(T.StringType()))
    return found.select(field("Page-Id").cast("long").alias("page_id"), "payload_bytes", checked.alias("payload_digest"),
                        field("WARC-Type").alias("record_type"), field("Refers-To-Page-Id").cast("long").alias("refers_to"))
