"""Content-addressed web archive.

``write_archive`` stores two Parquet tables: ``payloads`` has the bytes of each SHA-256 once, ``records``
the exact header bytes of every record with the digest it points to. ``read_archive`` joins both
and gives the records back byte by byte; stored bytes that no longer match their digest raise an error.

Of records with equal payloads of at least ``min_revisit`` bytes, that with the smallest id is a response
and the others revisit it. Defined cases: a null payload is empty; a null url has no header line; rows
that repeat an id and its payload are kept, all of the smallest id as responses; a null id counts
as larger than any other, and records with only null ids are all responses; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_REVISIT = 100
NO_DATE = "1970-01-01T00:00:00Z"


def header_line(name: str, value: Column) -> Column:
    safe = F.regexp_replace(value.cast("string"), r"[\r\n]", " ")
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def record_urn(record_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), record_id.cast("string"), F.lit(">"))


def header_bytes(date: str) -> Column:
    """Header of a row with record_id, url, record_type, refers_to, digest and payload_bytes."""
    revisit = F.col("record_type") == "revisit"
    text = F.concat(
        F.lit("WARC/1.1\r\n"),
        header_line("WARC-Type", F.col("record_type")),
        header_line("WARC-Record-ID", record_urn(F.col("record_id"))),
        header_line("WARC-Target-URI", F.col("url")),
        header_line("WARC-Date", F.lit(date)),
        header_line("WARC-Refers-To", F.when(revisit, record_urn(F.col("refers_to")))),
        header_line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        header_line("Content-Type", F.lit("text/html; charset=utf-8")),
        header_line("Content-Length", F.col("payload_bytes")),
        F.lit("\r\n"),
    )
    return text.cast("binary")


def header_field(header: Column, name: str) -> Column:
    """Value of a line of header bytes, null where the line is missing."""
    found = F.regexp_extract(header.cast("string"), rf"(?:^|\r\n){name}: ([^\r\n]*)\r\n", 1)
    return F.when(found != "", found)


def write_archive(
    pages: DataFrame, path: str, id_col: str, url_col: str, payload_col: str,
    min_revisit: int = MIN_REVISIT, date: str = NO_DATE,
) -> None:
    """Write the rows of ``pages`` as an archive at ``path``.

    Equal payloads meet in a partial aggregate, so a payload that a third of the pages share leaves
    each task once. The join that tells every record its response carries no payload.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col(id_col).alias("record_id"),
        F.col(url_col).alias("url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary")).alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    stored = rows.groupBy("digest").agg(
        F.first("payload").alias("payload"), F.min("record_id").alias("first_id")
    )
    stored.withColumn("payload_bytes", F.octet_length("payload").cast("long")).write.parquet(
        f"{path}/payloads"
    )
    firsts = spark.read.parquet(f"{path}/payloads").select("digest", "first_id", "payload_bytes")
    revisit = (F.col("payload_bytes") >= min_revisit) & ~F.col("record_id").eqNullSafe(F.col("first_id"))
    (
        rows.select("record_id", "url", "digest")
        .join(firsts, "digest")
        .withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
        .withColumn("refers_to", F.when(revisit, F.col("first_id")))
        .select("record_id", "digest", header_bytes(date).alias("header"))
        .write.parquet(f"{path}/records")
    )


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Original records: record_id, header, digest, payload, payload_bytes; each stored payload is verified once."""
    payloads = spark.read.parquet(f"{path}/payloads").select("digest", "payload", "payload_bytes")
    intact = F.sha2("payload", 256) == F.col("digest")
    verified = payloads.withColumn(
        "payload_digest", F.when(intact, F.col("digest")).otherwise(F.raise_error(F.lit("payload does not match its digest")))
    )
    return spark.read.parquet(f"{path}/records").join(verified, "digest")


def record_bytes() -> Column:
    """Bytes of a record read by ``read_archive`` as a WARC file holds them."""
    return F.concat(F.col("header"), F.col("payload"), F.lit("\r\n\r\n").cast("binary"))
