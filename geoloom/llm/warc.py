"""A content-addressed WARC archive.

Two tables in the shared folder hold the archive. `payloads` has every distinct payload once,
under its SHA-256; `headers` has the exact header bytes of every record and the digest that
its payload is stored under. A record's bytes are put together again by joining the two, and whatever is read
is parsed from those bytes. Digests are verified twice: on writing, no two different payloads may share one
(their SHA-1 and lengths are compared in the aggregate that keeps one copy), and on reading, the payload's
digests are computed anew and compared with the header.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_dir

#: Payloads shorter than this are always stored as responses of their own.
LEAST_REVISIT_BYTES = 1_000
CRLF = "\r\n"
#: Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _line(name: str, value: Column) -> Column:
    """One header line; left out where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def _field(name: str) -> Column:
    found = F.regexp_extract(F.col("head"), rf"\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(found != "", found)


def _uri(url: Column) -> Column:
    """Line ends are percent-encoded; what looks like a line end encoded gets its own sign encoded, so that this can be undone."""
    url = F.regexp_replace(url, "%(?=(?:25)*0[AD])", "%25")
    return F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _url(uri: Column) -> Column:
    uri = F.replace(F.replace(uri, F.lit("%0D"), F.lit("\r")), F.lit("%0A"), F.lit("\n"))
    return F.regexp_replace(uri, "%25(?=(?:25)*0[AD])", "%")


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", date: str | None = None) -> None:
    """Writes path/payloads and path/headers, a record for each row of pages, dated `date` (UTC, as 2020-01-31T00:00:00Z; now if it is not given).

    Of rows with equal payloads of at least LEAST_REVISIT_BYTES, that with the largest id is
    the response (all of them where rows share that id) and the others are revisits of it;
    shorter payloads are always responses. Null payload: empty. Null id: an empty record id,
    smaller than any other. Null or empty url: no target line. Columns other than these
    three are not read.
    """
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload")).withColumns(
        {"sha256": F.sha2("payload", 256), "sha1": F.sha1("payload"), "size": F.octet_length("payload").cast("long")}
    )
    stored = rows.groupBy("sha256").agg(
        F.first("payload").alias("payload"),
        F.max("id").alias("owner"),
        F.max("size").alias("size"),
        F.max("sha1").alias("sha1"),
        ((F.min("sha1") != F.max("sha1")) | (F.min("size") != F.max("size"))).alias("clash"),
    )
    verified = stored.withColumn("payload", F.when(F.col("clash"), F.raise_error(F.lit("two payloads share a SHA-256"))).otherwise(F.col("payload")))
    verified.select("sha256", "payload", "owner").write.parquet(f"{path}/payloads")

    owners = pages.sparkSession.read.parquet(f"{path}/payloads").select("sha256", "owner")
    records = rows.drop("payload").join(owners, "sha256")
    revisit = (F.col("size") >= LEAST_REVISIT_BYTES) & F.col("id").eqNullSafe(F.col("owner")).__invert__()
    header = F.concat(
        F.lit(VERSION + CRLF),
        _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(">"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.when(F.col("url") != "", _uri(F.col("url")))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _line("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.when(revisit, F.lit(None)).otherwise(F.col("sha256")))),
        _line("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        _line("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<urn:page:"), F.col("owner").cast("string"), F.lit(">")))),
        _line("Content-Type", F.when(~revisit, F.lit("text/html"))),
        _line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("size").cast("string"))),
        F.lit(CRLF),
    )
    records.select("sha256", header.cast("binary").alias("header")).write.parquet(f"{path}/headers")


def records(spark: SparkSession, path: str) -> DataFrame:
    """The records of an archive, put together again: record (the bytes of a whole record) and payload (also of revisits, whose record has none)."""
    headers = spark.read.parquet(f"{path}/headers").select("sha256", "header")
    payloads = spark.read.parquet(f"{path}/payloads").select("sha256", "payload")
    joined = headers.join(payloads, "sha256", "left")
    body = F.when(F.instr(F.col("header").cast("string"), f"{CRLF}WARC-Type: revisit{CRLF}") > 0, F.lit("").cast("binary")).otherwise(F.col("payload"))
    return joined.select(F.concat("header", body, F.lit(CRLF * 2).cast("binary")).alias("record"), "payload", "sha256")


def read_archive(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """One row per record: id, url, record_type, refers_to, payload_digest (SHA-1), record and payload (binary).

    A record's bytes are put together and then split as any reader would: the header ends at the first empty line, and
    the block has the length that the header says. The payload is a response's block, or what the store has
    for a revisit, and is compared with the header's digests. A record whose payload is missing or differs stops the read.
    """
    whole = records(spark, path)
    head = F.concat(F.substring_index(F.col("record").cast("string"), CRLF * 2, 1), F.lit(CRLF))
    parsed = whole.withColumn("head", head)
    number = lambda name: F.regexp_extract(_field(name), "^<urn:page:(.*)>$", 1)
    parsed = parsed.select(
        "record",
        "payload",
        "sha256",
        F.expr(f"substring(record, octet_length(head) + {len(CRLF) + 1}, int(regexp_extract(head, 'Content-Length: ([0-9]+)', 1)))").alias("block"),
        F.when(number("WARC-Record-ID") != "", number("WARC-Record-ID")).cast(id_type).alias("id"),
        _url(_field("WARC-Target-URI")).alias("url"),
        _field("WARC-Type").alias("record_type"),
        F.when(number("WARC-Refers-To") != "", number("WARC-Refers-To")).cast(id_type).alias("refers_to"),
        F.regexp_extract(_field("WARC-Payload-Digest"), "^sha1:(.*)$", 1).alias("payload_digest"),
        F.regexp_extract(_field("WARC-Block-Digest"), "^sha256:(.*)$", 1).alias("block_digest"),
    )
    told = parsed.withColumn("payload", F.when(F.col("record_type") == "revisit", F.col("payload")).otherwise(F.col("block")))
    digest = F.sha2("payload", 256)
    right = (F.sha1("payload") == F.col("payload_digest")) & (digest == F.col("sha256")) & ((F.col("record_type") == "revisit") | (digest == F.col("block_digest")))
    checked = F.when(F.coalesce(right, F.lit(False)), F.col("payload")).otherwise(F.raise_error(F.lit("a payload is missing or differs from its digest")).cast("binary"))
    return told.withColumn("payload", checked).drop("sha256", "block", "block_digest")


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Writes pages to a new archive in the shared folder and reads it back."""
    spark = pages.sparkSession
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archive(pages, path, id_col, url_col, payload_col)
    return read_archive(spark, path, pages.schema[id_col].dataType.simpleString())
