"""A content-addressed archive of web records.

The archive is two tables. ``payloads`` holds every payload's bytes once, under
their SHA-256. ``records`` holds the exact header bytes of each WARC record and of
the HTTP message in it. A record is its header, its HTTP header and, found by a
join on the digest, its payload.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import small_side
from tallyloom.plans.storage import materialize, new_folder

# Payloads below this many bytes are never replaced by a revisit record.
REVISIT_BYTES = 100

# Fixed values of the WARC 1.1 format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_END = "\r\n\r\n"


def _field(name: str, value: Column) -> Column:
    """A header line; none if the value is null. Line breaks in it are percent-encoded."""
    clean = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def _record_id(key: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), key.cast("string"), F.lit(">"))


def write_archive(pages: DataFrame, folder: str | None = None, id_column: str = "page_id",
                  url_column: str = "url", payload_column: str = "html",
                  date: str = "2024-01-01T00:00:00Z") -> str:
    """Write a record for each page and return the folder of the archive.

    The payload is the column in UTF-8 (or its bytes, if binary); null is an empty
    payload. Of records with equal payloads of at least ``REVISIT_BYTES`` bytes
    that with the smallest id is a response and the others revisit it; shorter
    payloads are all responses. If rows repeat the smallest id, all of them are
    responses; a null id is larger than any other, and if a payload has null ids
    only, all its records are responses. A null address leaves out its header
    line. No payload is shuffled except one copy for each task that repeats.
    """
    folder = folder or new_folder(pages.sparkSession, "archive")
    payload = F.coalesce(F.col(payload_column).cast("binary"), F.lit("").cast("binary"))
    found = pages.select(
        F.col(id_column).alias("key"), F.col(url_column).cast("string").alias("url"),
        payload.alias("payload"))
    keyed = found.withColumn("digest", F.sha2("payload", 256)).withColumn(
        "bytes", F.octet_length("payload").cast("long"))
    heads = materialize(keyed.select("key", "url", "digest", "bytes"), "heads")

    # The least id of each payload that several records share.
    shared = small_side(materialize(
        heads.groupBy("digest").agg(F.min("key").alias("first"), F.count("*").alias("n"))
        .where("n > 1").select("digest", "first", F.lit(True).alias("many")), "shared"))
    marked = heads.join(shared, "digest", "left")
    revisit = F.coalesce(
        (F.col("bytes") >= REVISIT_BYTES) & F.col("many") & ~F.col("key").eqNullSafe(F.col("first")),
        F.lit(False))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"), F.lit(RECORD_END))
    block = F.octet_length(http) + F.when(F.col("revisit"), F.lit(0)).otherwise(F.col("bytes"))
    kind = F.when(F.col("revisit"), "revisit").otherwise("response")
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        _field("WARC-Type", kind),
        _field("WARC-Record-ID", _record_id(F.coalesce(F.col("key").cast("string"), F.lit("")))),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", F.col("url")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        _field("WARC-Profile", F.when(F.col("revisit"), REVISIT_PROFILE)),
        _field("WARC-Refers-To", F.when(F.col("revisit"), _record_id(F.col("first")))),
        _field("Content-Type", F.lit("application/http;msgtype=response")),
        _field("Content-Length", block.cast("string")),
        F.lit("\r\n"))
    marked.withColumn("revisit", revisit).select(
        "digest", F.col("key").alias("record_key"), header.cast("binary").alias("header"),
        http.cast("binary").alias("http_header"),
    ).write.mode("overwrite").parquet(f"{folder}/records")

    # A payload that no other record shares is stored where it stands; of a shared
    # one the rows with the least id are, once.
    first = keyed.select("key", "digest", "payload").join(shared, "digest", "left").where(
        F.col("many").isNull() | F.col("key").eqNullSafe(F.col("first")))
    alone = first.where("many is null").select("digest", "payload")
    together = first.where("many").select("digest", "payload").dropDuplicates(["digest"])
    alone.unionByName(together).write.mode("overwrite").parquet(f"{folder}/payloads")
    return folder


def _header_value(name: str) -> Column:
    value = F.regexp_extract(F.col("header").cast("string"), rf"\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(value != "", value)


def read_archive(spark, folder: str, key_type: str = "long") -> DataFrame:
    """Read the records back, with all fields taken from the header bytes.

    Each payload's digest is computed again; a payload that does not have the
    digest it is stored under fails the read, and so does a record without payload,
    whichever columns are selected: the check is a condition on the rows.
    ``record`` is the exact record, ``original`` the record as a response with its
    payload even where the archive has a revisit.
    """
    stored = spark.read.parquet(f"{folder}/payloads").select(
        "digest", "payload", F.sha2("payload", 256).alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("payload_bytes"))
    records = spark.read.parquet(f"{folder}/records").select(
        "header", "http_header",
        F.replace(_header_value("WARC-Payload-Digest"), F.lit("sha256:"), F.lit("")).alias("digest"),
        _header_value("WARC-Type").alias("record_type"),
        _header_value("WARC-Target-URI").alias("url"),
        F.regexp_extract(F.coalesce(_header_value("WARC-Refers-To"), F.lit("")), "<urn:page:(.*)>", 1)
        .alias("refers"),
        F.regexp_extract(_header_value("WARC-Record-ID"), "<urn:page:(.*)>", 1).alias("page"),
    )
    sound = F.col("payload_digest").eqNullSafe(F.col("digest"))
    end = F.lit(RECORD_END).cast("binary")
    full = F.concat("header", "http_header", "payload", end)
    checked = F.when(sound, F.lit(True)).otherwise(F.raise_error(F.concat(
        F.lit("no sound payload for "), F.coalesce("digest", F.lit("a record")))).cast("boolean"))
    return records.join(stored, "digest", "left").where(checked).select(
        F.when(F.col("page") != "", F.col("page")).cast(key_type).alias("page_id"), "url",
        "payload_bytes", "payload_digest", "record_type",
        F.when(F.col("refers") != "", F.col("refers")).cast(key_type).alias("refers_to"),
        F.when(F.col("record_type") == "revisit", F.concat("header", "http_header", end))
        .otherwise(full).alias("record"),
        F.concat("http_header", "payload").alias("original"),
        "payload",
    )
