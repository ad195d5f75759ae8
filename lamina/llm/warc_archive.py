"""A content-addressed WARC archive: payloads once by digest, record headers apart.

``payloads`` holds each distinct payload once, under its SHA-256. ``records`` holds, for
every page, the exact bytes of its WARC and block headers and the digest of its payload.
A record is rebuilt by joining the two on the digest; reading checks the bytes against the
SHA-256 they are stored under and the SHA-1 that the header names.

Of the pages with equal payloads the one with the largest page_id is the response, the
others are revisits that refer to it. Pages that also share the page_id come in the order
of their row numbers, which are written out first; the last of them is the response. A null
html is an empty payload. A page with a null page_id is a response only if no equal payload
has a page_id; its record id is made from its row number. A null url leaves out the target
line. Line breaks in a url are percent-encoded, as a header line cannot hold them.

DataFrame functions only; the hot payload of a large group is stored once, found by a
partial aggregation, and its records join it on a key that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.session import fresh_path

# Fixed values of the format: base-32 digits of conv and of RFC 4648, header lines.
_CONV_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE32_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_VERSION, _LINE = "WARC/1.1", "\r\n"
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
#: No capture time is given with a page; one fixed time keeps the archive reproducible.
_DATE = "1970-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 as 32 upper-case base-32 digits: five bytes, that is ten hex digits, make eight."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), _CONV_DIGITS, _BASE32_DIGITS)


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(_LINE))


def _number(page_id: Column, row: Column) -> Column:
    return F.coalesce(page_id.cast("string"), F.concat(F.lit("row-"), row.cast("string")))


def _record_uri(number: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), number, F.lit(">"))


def write_archive(pages: DataFrame, path: str) -> None:
    """Write ``payloads`` and ``records`` below ``path``."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    staged = pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        payload.alias("payload"),
    ).withColumns({"sha256": F.sha2("payload", 256), "sha1": base32_sha1(F.col("payload"))})
    heads = staged.select("row", "page_id", "url", "sha256", "sha1", F.octet_length("payload").alias("bytes"))
    heads.write.parquet(f"{path}/staged")
    heads = spark.read.parquet(f"{path}/staged")

    once = staged.groupBy("sha256").agg(F.first("payload").alias("payload"))
    once.write.parquet(f"{path}/payloads")

    order = F.struct(F.col("page_id").isNotNull().alias("known"), F.col("page_id"), F.col("row"))
    latest = heads.groupBy("sha256").agg(F.max(order).alias("latest"))
    joined = heads.join(latest, "sha256")
    revisit = F.col("row") != F.col("latest.row")
    uri = _number(F.col("page_id"), F.col("row"))
    target = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    http = F.concat(F.lit(_HTTP), F.col("bytes").cast("string"), F.lit(_LINE * 2))
    of_block = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("bytes"))
    warc = F.concat(
        F.lit(_VERSION + _LINE),
        _header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _header("WARC-Record-ID", _record_uri(uri)),
        _header("WARC-Date", F.lit(_DATE)),
        F.when(F.col("url").isNotNull(), _header("WARC-Target-URI", target)).otherwise(""),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(
            revisit,
            F.concat(
                _header("WARC-Refers-To", _record_uri(_number(F.col("latest.page_id"), F.col("latest.row")))),
                _header("WARC-Profile", F.lit(_REVISIT_PROFILE)),
            ),
        ).otherwise(""),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", of_block.cast("string")),
        F.lit(_LINE),
    )
    joined.select("row", "page_id", "sha256", warc.cast("binary").alias("warc"), http.cast("binary").alias("http")) \
        .write.parquet(f"{path}/records")


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """sha256 and payload; raises where the bytes are not those of the digest."""
    stored = spark.read.parquet(f"{path}/payloads")
    wrong = F.raise_error(F.concat(F.lit("payload does not match "), F.col("sha256")))
    sound = F.when(F.sha2("payload", 256) == F.col("sha256"), F.col("payload")).otherwise(wrong.cast("binary"))
    return stored.select("sha256", sound.alias("payload"))


def _line_value(name: str) -> Column:
    return F.regexp_extract(F.col("warc").cast("string"), rf"\n{name}: ([^\r\n]*)\r\n", 1)


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """What the header lines of each record say, and the digest its payload is stored under."""
    refers = F.regexp_extract(_line_value("WARC-Refers-To"), r"^<urn:page:(-?\d+)>$", 1)
    return spark.read.parquet(f"{path}/records").select(
        "page_id",
        "sha256",
        "warc",
        "http",
        _line_value("WARC-Type").alias("record_type"),
        F.regexp_extract(_line_value("WARC-Payload-Digest"), "^sha1:(.*)$", 1).alias("named_digest"),
        F.nullif(refers, F.lit("")).cast("long").alias("refers_to"),
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The whole bytes of every record (``record``), with its payload and what its headers say."""
    joined = read_headers(spark, path).join(read_payloads(spark, path), "sha256")
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return joined.withColumn(
        "record", F.concat("warc", "http", body, F.lit((_LINE * 2).encode()))
    )


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to and record_sha256 of every rebuilt record.

    All of it is taken from the record that headers and payload give together; one whose header
    names another digest than its payload's raises. No pages give no rows.
    """
    records = read_records(spark, path).withColumn("payload_digest", base32_sha1(F.col("payload")))
    wrong = F.raise_error(F.concat(F.lit("record names another digest than "), F.col("payload_digest")))
    digest = F.when(F.col("named_digest") == F.col("payload_digest"), F.col("payload_digest")).otherwise(
        wrong.cast("string")
    )
    return records.select(
        "page_id",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        digest.alias("payload_digest"),
        "record_type",
        "refers_to",
        F.sha2("record", 256).alias("record_sha256"),
    )


def fresh_archive_path(spark: SparkSession) -> str:
    return fresh_path(spark, "archive")
