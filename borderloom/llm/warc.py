"""Content-addressed WARC archive.

An archive is two tables: ``payloads`` holds the bytes of each distinct payload
once, under their SHA-256, and ``headers`` holds a record's exact WARC and HTTP
headers with the digest of its payload.  Records come back by joining the two;
the digest is computed again from the stored bytes, and a mismatch or a missing
payload fails the read.

Everything is DataFrame functions.  Payloads are reduced to one a digest with
map-side partial aggregation, so a payload that a third of the pages share is
shuffled once a task; the joins on the digest are plain equi-joins, which AQE
splits where one digest has very many records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
END = "\r\n"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of a binary column: each 5 hexadecimal digits are 4 of base 32."""
    h = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(h, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*groups), _DIGITS, BASE32)


def _field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(END))


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0) -> None:
    """Write a record for each row of ``pages`` below ``path``.

    The payload is the html in UTF-8; a null one is empty.  Of the records with
    equal payloads of at least ``min_bytes`` bytes, the one with the smallest id
    is a response and the others revisit it; smaller payloads are all responses.
    Null ids come last; among rows of one id the first written is taken.  A null
    url is empty, and line ends in one are percent-encoded.  Other columns are
    ignored.  An empty table gives an empty archive.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    url = F.regexp_replace(F.regexp_replace(F.coalesce(F.col(url_col).cast("string"), F.lit("")), "\r", "%0D"), "\n", "%0A")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), url.alias("url"), payload.alias("payload"))
    rows.select(
        F.monotonically_increasing_id().alias("row"), "page_id", "url",
        F.sha2("payload", 256).alias("digest"), base32_sha1(F.col("payload")).alias("sha1"), F.octet_length("payload").cast("long").alias("bytes"),
    ).write.parquet(f"{path}/records")
    rows.select(F.sha2("payload", 256).alias("digest"), "payload").groupBy("digest").agg(F.first("payload").alias("payload")).write.parquet(f"{path}/payloads")

    records = spark.read.parquet(f"{path}/records")
    rank = F.struct(F.col("page_id").isNull().alias("unknown"), "page_id", "row")
    first = records.where(F.col("bytes") >= min_bytes).groupBy(F.col("digest").alias("of")).agg(F.min(rank).alias("first"))
    linked = records.join(first, F.col("digest") == F.col("of"), "left")
    revisit = F.col("first").isNotNull() & (F.col("first.row") != F.col("row"))
    warc = F.concat(
        F.lit(f"WARC/1.1{END}"),
        _field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _field("WARC-Record-ID", _urn(F.col("page_id"))),
        _field("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        _field("WARC-Target-URI", F.col("url")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, F.concat(_field("WARC-Refers-To", _urn(F.col("first.page_id"))), _field("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))).otherwise(F.lit("")),
        _field("Content-Type", F.lit("application/http; msgtype=response")),
    )
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}"), _field("Content-Length", F.col("bytes").cast("string")), F.lit(END))
    length = F.octet_length("http") + F.when(revisit, F.lit(0)).otherwise(F.col("bytes"))
    linked.withColumn("http", http).select(
        "row", "digest", F.concat(warc, _field("Content-Length", length.cast("string")), F.lit(END)).alias("warc"), "http"
    ).write.parquet(f"{path}/headers")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Rows (row, record binary, payload binary): every record's bytes, and its payload, which a revisit's bytes lack."""
    headers = spark.read.parquet(f"{path}/headers")
    payloads = spark.read.parquet(f"{path}/payloads").withColumnRenamed("digest", "of")
    held = headers.join(payloads, F.col("digest") == F.col("of"), "left")
    sound = held.where(F.assert_true(F.coalesce(F.sha2("payload", 256) == F.col("digest"), F.lit(False)), "a payload differs from its digest").isNull())
    body = F.when(F.col("warc").contains("WARC-Type: revisit\r\n"), F.lit("").cast("binary")).otherwise(F.col("payload"))
    record = F.concat(F.col("warc").cast("binary"), F.col("http").cast("binary"), body, F.lit(END + END).cast("binary"))
    return sound.select("row", record.alias("record"), "payload")


def parse_records(records: DataFrame) -> DataFrame:
    """Rows (page_id, url, payload_bytes, payload_digest, record_type, refers_to, digest_ok) of :func:`read_archive`."""
    head = F.concat(F.lit(END), F.substring_index(F.col("record").cast("string"), END + END, 1), F.lit(END))
    # a field ends at its \\r\\n alone: a URL may hold other line ends of Unicode
    field = lambda name: F.regexp_extract("head", f"(?s)\r\n{name}: (.*?)\r\n", 1)
    number = lambda c: F.regexp_extract(c, "<urn:page:(-?[0-9]+)>", 1).try_cast("long")
    return (
        records.select(head.alias("head"), "payload", base32_sha1(F.col("payload")).alias("payload_digest"))
        .select(
            number(field("WARC-Record-ID")).alias("page_id"),
            field("WARC-Target-URI").alias("url"),
            F.octet_length("payload").cast("long").alias("payload_bytes"),
            "payload_digest",
            field("WARC-Type").alias("record_type"),
            number(field("WARC-Refers-To")).alias("refers_to"),
            (F.concat(F.lit("sha1:"), F.col("payload_digest")) == field("WARC-Payload-Digest")).alias("digest_ok"),
        )
    )
