"""Content-addressed web archive: each payload's bytes are stored once.

Layout of an archive folder:

``payloads/``  ``digest``, ``payload``: every distinct payload once, written by the row
               that holds it first.
``records/``   ``page_id``, ``header`` (the exact bytes of the record's header block with
               its blank line), ``digest``, ``record_type``, ``refers_to``, ``content_length``.

A WARC record is its header, its block and two line ends.  The block is an HTTP message: a
head that the payload's length determines, and in a ``response`` the payload.  A ``revisit``
(a payload of at least ``min_revisit`` bytes that a page with a smaller id holds too) has the
head alone; its header names the profile and the record it refers to.  The table holds no
time of capture: ``WARC-Date`` is the ``date`` given for the whole archive.  A record's id is
made of the page id, a digest of its address and payload, and the number of its copy, so it
is there for a null page id and differs between repeated rows.
``records`` rebuilds the exact records by a join on the digest, after every stored
payload's SHA-256 has been computed again and compared with its address.

Plan: one pass computes digests; the narrow rows (id, address, digest, length) are
counted per payload with map-side aggregation, so a payload that a third of the pages
hold does not meet in one task; payload bytes are shuffled once, by page id, and only
those of first holders are kept.  Defined cases: a null payload is empty; equal payloads
of repeated rows with one id make one response and revisits to that id; a null page id
sorts last, and a revisit to it has no ``refers_to``; an empty table makes an empty archive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EOL = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed by the format


def _pages(pages: DataFrame) -> DataFrame:
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    return pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("payload"),
                        F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("long").alias("payload_bytes"))


def http_head(payload_bytes: Column) -> Column:
    """The HTTP head of a page's block."""
    return F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "),
                    payload_bytes.cast("string"), F.lit(EOL + EOL)).cast("binary")


def record_id(page_id: Column, url: Column, digest: Column, copy: Column) -> Column:
    of = F.substring(F.sha2(F.concat_ws("\n", digest, url).cast("binary"), 256), 1, 32)
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(":"), of, F.lit(":"), copy.cast("string"), F.lit(">"))


def header(record_type: Column, url: Column, own_id: Column, refers_to: Column, digest: Column, length: Column, payload_bytes: Column,
           date: str) -> Column:
    """The header block of a record, from its version line to its blank line; ``refers_to``
    is the id of a revisit's response."""
    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(name + ": "), value, F.lit(EOL))

    clean = F.coalesce(F.regexp_replace(url, "[\r\n]+", " "), F.lit(""))  # a header line holds no line end
    return F.concat(
        F.lit("WARC/1.1" + EOL), line("WARC-Type", record_type), line("WARC-Record-ID", own_id), line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", clean), line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)),
        F.when(record_type == "revisit", F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", refers_to))).otherwise(""),
        line("X-Payload-Bytes", payload_bytes.cast("string")), line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", length.cast("string")), F.lit(EOL)).cast("binary")


def write(pages: DataFrame, path: str, min_revisit: int = 100, date: str = "1970-01-01T00:00:00Z") -> None:
    """Archive ``pages`` (``page_id``, ``url``, ``html``) in the folder ``path``."""
    spark = pages.sparkSession
    rows = _pages(pages)
    # one row per different page and payload, with how often it is there
    seen = rows.groupBy("digest", "payload_bytes", "page_id", "url").agg(F.count("*").alias("copies"))
    first = seen.groupBy("digest").agg(
        F.min("page_id").alias("holder"), F.min_by(F.coalesce("url", F.lit("")), F.struct(F.col("page_id").isNull(), "page_id", F.coalesce("url", F.lit("")))).alias("holder_url"))
    each = seen.join(first, "digest").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    holds = (F.col("page_id").eqNullSafe(F.col("holder")) & (F.coalesce("url", F.lit("")) == F.col("holder_url")) & (F.col("copy") == 1))
    response = (F.col("payload_bytes") < min_revisit) | holds
    kind = F.when(response, "response").otherwise("revisit")
    refers = F.when(~response, F.col("holder"))
    length = F.octet_length(http_head(F.col("payload_bytes"))) + F.when(response, F.col("payload_bytes")).otherwise(F.lit(0).cast("long"))
    own_id = record_id(F.col("page_id"), F.col("url"), F.col("digest"), F.col("copy"))
    first_id = record_id(F.col("holder"), F.col("holder_url"), F.col("digest"), F.lit(1))
    (each.select("page_id", "digest", kind.alias("record_type"), refers.alias("refers_to"), length.alias("content_length"), "url", "payload_bytes",
                 own_id.alias("own_id"), first_id.alias("first_id"))
     .select("page_id", "digest", "record_type", "refers_to", "content_length",
             header(F.col("record_type"), F.col("url"), F.col("own_id"), F.col("first_id"), F.col("digest"), F.col("content_length"),
                    F.col("payload_bytes"), date).alias("header"))
     .write.option("compression", "zstd").parquet(f"{path}/records"))
    # the bytes, of the first holder; one key for the join and for leaving out repeated
    # rows, so that payloads are shuffled once
    def holding(page_id: Column) -> Column:
        return F.concat_ws(":", "digest", page_id.cast("string")).alias("_key")

    wanted = spark.read.parquet(f"{path}/records").groupBy("digest").agg(F.min("page_id").alias("_holder")).select(holding(F.col("_holder")))
    kept = rows.select(holding(F.col("page_id")), "digest", "payload").join(wanted, "_key", "left_semi")
    kept.dropDuplicates(["_key"]).select("digest", "payload").write.option("compression", "zstd").parquet(f"{path}/payloads")


def stored_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Payloads with their digest computed again; a difference stops the read."""
    found = F.sha2("payload", 256)
    checked = F.when(F.col("digest") == found, found).otherwise(
        F.raise_error(F.concat(F.lit("payload does not match its address "), F.col("digest"))))
    return spark.read.parquet(f"{path}/payloads").select(
        checked.alias("digest"), F.octet_length("payload").cast("long").alias("payload_bytes"), "payload")


def records(spark: SparkSession, path: str) -> DataFrame:
    """Every record rebuilt: its fields, and ``record`` with its exact bytes."""
    block = F.concat(http_head(F.col("payload_bytes")), F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b"")))
    end = F.lit((EOL + EOL).encode())
    return spark.read.parquet(f"{path}/records").join(stored_payloads(spark, path), "digest").withColumn(
        "record", F.concat("header", block, end))


def field(name: str) -> Column:
    """A field of the header block."""
    return F.regexp_extract(F.col("header").cast("string"), rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
