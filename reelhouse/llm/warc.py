"""WARC: a content-addressed archive written and read back with joins.

An archive is a folder with two tables:

* ``payloads``: each distinct payload once, under its SHA-256 digest. Copies
  are combined inside every map task before the shuffle, so a payload that a
  third of all pages share is shuffled once per task.
* ``headers``: the exact WARC header block of every record, with the digest.

Of equal payloads of at least ``MIN_REVISIT`` bytes the record with the
smallest id is a response and the others are revisits that refer to it;
smaller payloads are always responses. Reading joins headers to payloads on
the digest, recomputes the digest of every stored payload and fails on a
mismatch or a missing payload. ``export_warc`` writes the records as plain
WARC files.

Nulls: a null payload is empty; a null url is an empty URI; a null id never
is the one that others refer to unless no row with that payload has an id, and
is written as ``none``. Rows that repeat an id with the same payload are the
same page and get the same record type. Line breaks in a URI are
percent-encoded in its header. Very long payloads are stored whole. Extra columns
are not read, whatever their names. An empty table gives an empty archive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_REVISIT = 100
CRLF = "\r\n"
# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Capture time of rows that carry none.
UNKNOWN_DATE = "1970-01-01T00:00:00Z"


def _urn(col: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(col.cast("string"), F.lit("none")), F.lit(">"))


def _header(kind: Column, page: Column, url: Column, digest: Column, size: Column, refers: Column) -> Column:
    """The header block, up to and including the empty line."""
    uri = F.replace(F.replace(F.coalesce(url, F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    revisit = kind == "revisit"
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    return F.concat(
        F.lit(VERSION + CRLF),
        line("WARC-Type", kind),
        line("WARC-Record-ID", _urn(page)),
        line("WARC-Date", F.lit(UNKNOWN_DATE)),
        line("WARC-Target-URI", uri),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)),
        F.when(revisit, F.concat(line("WARC-Refers-To", _urn(refers)), line("WARC-Profile", F.lit(PROFILE)))).otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(size.cast("string"))),
        F.lit(CRLF),
    )


def _field(header: Column, name: str) -> Column:
    """Value of a header line; null when it is absent."""
    value = F.regexp_extract(header, rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(header.contains(f"{CRLF}{name}: "), value)


def write_archive(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_revisit: int = MIN_REVISIT,
) -> None:
    """Write the two tables of the archive below ``path``."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload")
    ).withColumn("digest", F.sha2("payload", 256))
    (
        rows.groupBy("digest")
        .agg(F.first("payload").alias("payload"), F.min("page_id").alias("owner"))
        .withColumn("octets", F.octet_length("payload").cast("long"))
        .write.mode("overwrite").parquet(f"{path}/payloads")
    )
    owners = spark.read.parquet(f"{path}/payloads").select("digest", "owner", "octets")
    first = (F.col("octets") < min_revisit) | F.col("page_id").eqNullSafe(F.col("owner"))
    kind = F.when(first, F.lit("response")).otherwise(F.lit("revisit"))
    (
        rows.select("page_id", "url", "digest")
        .join(owners, "digest")  # a hot digest repeats on the row side only; AQE splits it
        .select(
            "digest",
            _header(kind, F.col("page_id"), F.col("url"), F.col("digest"), F.col("octets"), F.col("owner")).alias("header"),
        )
        .write.mode("overwrite").parquet(f"{path}/headers")
    )


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Records as written: page_id, url, record_type, refers_to, payload_digest, payload_bytes, header, payload."""
    headers = spark.read.parquet(f"{path}/headers")
    stored = spark.read.parquet(f"{path}/payloads").select(
        F.col("digest").alias("_digest"),
        "payload",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        # Verified where the payload lies, once per distinct payload.
        F.when(F.sha2("payload", 256) == F.col("digest"), F.col("digest"))
        .otherwise(F.raise_error(F.concat(F.lit("payload does not match its digest "), F.col("digest"))).cast("string"))
        .alias("payload_digest"),
    )
    page = lambda v: F.regexp_extract(v, r"^<urn:page:(-?[0-9]+)>$", 1)
    as_id = lambda v: F.when(page(v) != "", page(v)).cast("long")
    header = F.col("header")
    found = F.substring_index(_field(header, "WARC-Payload-Digest"), ":", -1)
    return (
        headers.withColumn("_key", found)
        .join(stored, F.col("_key") == F.col("_digest"), "left")
        .select(
            as_id(_field(header, "WARC-Record-ID")).alias("page_id"),
            _field(header, "WARC-Target-URI").alias("url"),
            _field(header, "WARC-Type").alias("record_type"),
            as_id(_field(header, "WARC-Refers-To")).alias("refers_to"),
            F.coalesce("payload_digest", F.raise_error(F.concat(F.lit("no payload "), F.col("_key"))).cast("string")).alias("payload_digest"),
            "payload_bytes",
            "header",
            "payload",
        )
    )


def export_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write records as concatenated WARC records; a revisit carries no payload."""
    body = F.when(F.col("record_type") == "response", F.col("payload").cast("string")).otherwise("")
    # A record ends with two line breaks, which the text writer puts after every row.
    records.select(F.concat("header", body).alias("value")).write.mode("overwrite").option(
        "lineSep", CRLF + CRLF
    ).option("compression", compression).text(path)
