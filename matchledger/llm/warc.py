"""A content-addressed WARC archive.

An archive is a folder of two Parquet tables. `payloads` (digest, length, payload) holds each distinct payload once,
under its SHA-256, which is verified when the archive is read. `headers` (record, digest, header) holds the exact
header bytes of every record. records() joins them to the original records, byte for byte.

Of records with equal payloads of at least `least` bytes, the one with the smallest key is a response and the others
are revisits of it, which is what their headers say; shorter payloads are always responses. (Their bytes, too, are
stored once.) A revisit's payload is its response's, so Content-Length is that of the full payload here: the archive
stores exact headers apart from payloads, and export writes full records.

Defined results: a null payload counts as empty; rows without a key are never the response of others, and equal keys
are separate records (with equal payloads, both count as the smallest, so both are responses); an empty table gives an
empty archive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEAST = 100
CRLF = "\r\n"


def _header(key: Column, uri: Column, digest: Column, length: Column, refers: Column, date: str) -> Column:
    """The header lines of a record, with the empty line that ends them."""
    urn = lambda k: F.concat(F.lit("<urn:record:"), k.cast("string"), F.lit(">"))
    revisit = refers.isNotNull()
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), F.coalesce(urn(key), F.lit("<urn:record:none>"))),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace(F.coalesce(uri, F.lit("")), r"[\r\n]", " ")),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), digest),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), urn(refers))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), length.cast("string")),
    ]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF)).cast("binary")


def write(pages: DataFrame, path: str, key: str = "page_id", uri: str = "url", payload: str = "html", least: int = LEAST, date: str = "2024-01-01T00:00:00Z") -> None:
    body = F.coalesce(F.col(payload).cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(key).alias("key"), F.col(uri).cast("string").alias("uri"), body.alias("payload"))
    small = rows.select("key", "uri", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").cast("long").alias("length"))
    # of each digest its smallest key, and in how many rows it is: payload bytes are not shuffled for this
    pairs = small.groupBy("digest", "key").agg(F.count("*").alias("n"))
    first = pairs.groupBy("digest").agg(F.min("key").alias("first"), F.min_by("n", "key").alias("n"))
    refers = F.when((F.col("length") >= least) & ~F.col("key").eqNullSafe(F.col("first")), F.col("first"))
    head = _header(F.col("key"), F.col("uri"), F.col("digest"), F.col("length"), refers, date)
    small.join(first, "digest").select("key", "digest", head.alias("header")).write.parquet(f"{path}/headers")
    keyed = rows.select("key", "payload", F.sha2("payload", 256).alias("digest"))
    owned = keyed.join(first.select(F.col("first").alias("key"), F.col("digest").alias("owned"), "n"), "key").where("digest = owned")
    lone = keyed.where("key is null").join(first.where("first is null").select("digest"), "digest", "left_semi")  # payloads that only rows without a key have
    repeated = owned.where("n > 1").select("digest", "payload").union(lone.select("digest", "payload")).dropDuplicates(["digest"])
    owned.where("n = 1").select("digest", "payload").union(repeated).select("digest", F.octet_length("payload").cast("long").alias("length"), "payload").write.parquet(f"{path}/payloads")


def records(spark: SparkSession, path: str) -> DataFrame:
    """(key, digest, header, payload, record): every original record; one whose payload does not have its digest stops the job."""
    headers, payloads = spark.read.parquet(f"{path}/headers"), spark.read.parquet(f"{path}/payloads")
    right = F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("payload is damaged: "), "digest")).cast("binary"))
    verified = payloads.select("digest", right.alias("payload"))
    return headers.join(verified, "digest").select("key", "digest", "header", "payload", F.concat("header", "payload", F.lit(CRLF + CRLF).cast("binary")).alias("record"))


def field(header: Column, name: str) -> Column:
    """The value of a header field; null if it is absent."""
    return F.nullif(F.regexp_extract(header.cast("string"), rf"\r\n{name}: ([^\r\n]*)", 1), F.lit(""))


def export(spark: SparkSession, path: str, to: str, compression: str = "none") -> None:
    """Writes the records as WARC files, through Spark's text writer: payloads must be text in UTF-8."""
    out = records(spark, path).select(F.concat(F.col("header").cast("string"), F.col("payload").cast("string")).alias("value"))
    out.write.option("lineSep", CRLF + CRLF).option("compression", compression).text(to)
