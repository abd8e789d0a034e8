"""Content-addressed WARC archive.

A record of a page is its header block, an empty line, the payload and two line ends. The
archive keeps the parts apart: payload bytes once per content under their SHA-256, and the
exact header block of every record with the key of its payload. A join puts records together
again, byte for byte, and checks every payload against its key and its length.

Of records with equal payloads the one of the largest page_id is the response; the others are
revisits that refer to it. Only keys, never payloads, are grouped to decide that. Payloads are
shuffled once, by their key, after each task has dropped its own repetitions; they are stored
in buckets by that key, so reading them back shuffles headers only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from auditweave.llm.common import pick
from auditweave.sources.shelf import pin, shelf_of

#: Line end of the format, and its digits of base 32.
CRLF = "\r\n"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: WARC-Date of records whose pages carry no time of capture.
NO_DATE = "1970-01-01T00:00:00Z"
#: Records that one file takes in an export.
FILE_RECORDS = 5_000
#: Payload bytes of a bucket.
BUCKET_BYTES = 256 << 20
#: Field of a header that names the page, of the kind that the format leaves to its users.
PAGE_FIELD = "X-Page-ID"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in base 32: 40 bits, that is ten hex digits, make eight digits at a time."""
    digest = F.sha1(payload)
    parts = [
        F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)
    ]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", _BASE32)


def _record_id(page: Column, copy: Column) -> Column:
    """A name for the record, by its page, its number in the page's rows and its content."""
    parts = (F.coalesce(page.cast("string"), F.lit("-")), copy.cast("string"), F.col("sha256"))
    name = F.md5(F.concat_ws(":", *parts))
    cut = [F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _header_block() -> Column:
    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    response = F.col("record_type") == "response"
    # no line end may get into a header line
    target = F.translate(F.coalesce("url", F.lit("")), "\r\n", "")
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("copy"))),
        line("WARC-Date", F.lit(NO_DATE)),
        F.coalesce(line(PAGE_FIELD, F.col("page_id").cast("string")), F.lit("")),
        line("WARC-Target-URI", target),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(
            ~response,
            F.concat(
                line(
                    "WARC-Profile",
                    F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                ),
                line("WARC-Refers-To", _record_id(F.col("refers_to"), F.col("refers_copy"))),
            ),
        ).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        # a revisit holds no block of its own
        line(
            "Content-Length",
            F.when(response, F.col("payload_bytes")).otherwise(F.lit(0)).cast("string"),
        ),
    )


def write_archive(
    pages: DataFrame, path: str | None = None, least: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Writes ``pages`` (page_id, url, html) as ``headers`` and ``payloads``; returns both.

    ``payloads`` has one row per distinct content that is archived: sha256, payload.
    ``headers`` has one row per page: page_id, url, header (text, line ends included),
    sha256, payload_bytes, payload_digest, record_type, refers_to, carrier (whether it is the one
    response that names its payload). They go under ``path``, or to the session's folder for
    written tables if none is given.

    A null html is an empty payload, a null url an empty target. Of equal payloads of at least
    ``least`` bytes, one of the largest page_id is the response; smaller ones are all
    responses. Rows repeated under one page_id are one response and else revisits of it. Rows
    without a page_id revisit a page of equal payload, and are all responses if there is none.
    An empty table gives empty tables.
    """
    rows = pick(pages, "page_id", "url", "html").withColumn(
        "payload", F.coalesce(F.col("html"), F.lit("")).cast("binary")
    )
    keyed = pin(
        rows.select(
            "page_id",
            "url",
            F.sha2("payload", 256).alias("sha256"),
            base32_sha1(F.col("payload")).alias("payload_digest"),
            F.octet_length("payload").cast("long").alias("payload_bytes"),
        ),
        "keys",
    )
    # equal rows differ by their number alone; a page has few of them
    same = ["page_id", "url", "sha256", "payload_digest", "payload_bytes"]
    copies = keyed.groupBy(*same).count()
    copies = copies.withColumn("same", F.explode(F.sequence(F.lit(1).cast("long"), "count")))
    order = W.partitionBy("page_id").orderBy(F.col("url").asc_nulls_first(), "sha256", "same")
    copies = copies.where("page_id IS NOT NULL").withColumn("copy", F.row_number().over(order))
    nameless = keyed.where("page_id IS NULL").withColumn("copy", F.lit(0))
    copies = copies.select(*same, "copy").unionByName(nameless.select(*same, "copy"))
    # an aggregate joined back, as any number of pages may share one payload
    first = F.max(F.struct("page_id", (-F.col("copy")).alias("back")))
    chosen = copies.where("page_id IS NOT NULL").groupBy("sha256").agg(first.alias("first"))
    whole = copies.join(chosen, "sha256", "left")
    own = (F.col("page_id") == F.col("first.page_id")) & (F.col("copy") == -F.col("first.back"))
    small = F.col("payload_bytes") < least
    response = small | F.coalesce(own, F.lit(False)) | F.col("first").isNull()
    typed = whole.select(
        *same,
        "copy",
        F.when(response, "response").otherwise("revisit").alias("record_type"),
        F.when(~response, F.col("first.page_id")).alias("refers_to"),
        (-F.col("first.back")).alias("refers_copy"),
        (F.coalesce(own, F.lit(False)) & ~small).alias("carrier"),
    )
    headers = typed.withColumn("header", _header_block()).select(
        "page_id",
        "url",
        "header",
        "sha256",
        "payload_bytes",
        "payload_digest",
        "record_type",
        "refers_to",
        "carrier",
    )
    folder = shelf_of(pages.sparkSession).place("archive") if path is None else path
    headers.write.option("compression", "zstd").parquet(f"{folder}/headers")
    # any row of a key has the key's content; a task sends one of them
    payloads = rows.groupBy(F.sha2("payload", 256).alias("sha256")).agg(
        F.any_value("payload").alias("payload")
    )
    spark = pages.sparkSession
    size = payload_total(copies)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    (
        payloads.write.bucketBy(buckets, "sha256")
        .sortBy("sha256")
        .option("compression", "zstd")
        .option("path", f"{folder}/payloads")
        .saveAsTable(_table_name())
    )
    layout = spark.createDataFrame([(buckets,)], "buckets int")
    layout.coalesce(1).write.parquet(f"{folder}/layout")
    return read_archive(spark, folder)


def payload_total(keyed: DataFrame) -> int:
    """Bytes of all distinct payloads, from their keys."""
    sizes = keyed.groupBy("sha256").agg(F.max("payload_bytes").alias("size"))
    return sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).head()[0]


def _table_name() -> str:
    return f"warc_payloads_{uuid.uuid4().hex}"


def read_archive(spark, path: str) -> tuple[DataFrame, DataFrame]:
    """``headers`` and ``payloads`` of an archive, the latter with its buckets."""
    buckets = spark.read.parquet(f"{path}/layout").head().buckets
    name = _table_name()
    spark.sql(
        f"CREATE TABLE {name} (sha256 STRING, payload BINARY) USING parquet"
        f" CLUSTERED BY (sha256) SORTED BY (sha256) INTO {buckets} BUCKETS LOCATION '{path}/payloads'"
    )
    return spark.read.parquet(f"{path}/headers"), spark.table(name)


def records(
    headers: DataFrame, payloads: DataFrame, verify: bool = True, full: bool = True
) -> DataFrame:
    """Every record of the archive: the columns of ``headers``, payload and record (bytes).

    ``record`` is the WARC record, whose block is empty for a revisit. ``payload`` is the full
    content; without ``full`` a revisit's is null, and only responses meet the payloads. With
    ``verify`` the query fails on a payload that is missing or does not have the digests and
    the length that its header says.
    """
    response = F.col("record_type") == "response"
    found = headers.where("carrier").join(payloads, "sha256", "left")
    # all others may share a payload in any number: a key that the buckets do not know brings
    # both sides to a shuffle, whose large partitions Spark can split
    others = headers.where(~F.col("carrier") if full else ~F.col("carrier") & response)
    known = payloads.select(F.upper("sha256").alias("_key"), "payload")
    shared = others.join(known, F.upper("sha256") == F.col("_key"), "left").drop("_key")
    whole = found.unionByName(shared)
    if verify:
        right = (
            (F.sha2("payload", 256) == F.col("sha256"))
            & (F.octet_length("payload") == F.col("payload_bytes"))
            & (base32_sha1(F.col("payload")) == F.col("payload_digest"))
        )
        whole = whole.withColumn(
            "payload",
            F.when(F.coalesce(right, F.lit(False)), F.col("payload")).otherwise(
                F.raise_error(F.concat(F.lit("damaged payload "), F.col("sha256"))).cast("binary")
            ),
        )
    if not full:
        whole = whole.unionByName(
            headers.where(~response).withColumn("payload", F.lit(None).cast("binary"))
        )
    end = F.lit(CRLF).cast("binary")
    block = F.when(response, F.col("payload")).otherwise(F.lit("").cast("binary"))
    return whole.withColumn(
        "record", F.concat(F.col("header").cast("binary"), end, block, end, end)
    )


def header_field(header: Column, name: str) -> Column:
    """The value of a field in a header block, null if it has none."""
    value = F.regexp_extract(header, rf"(?:^|\r\n)\Q{name}\E: ([^\r\n]*)\r\n", 1)
    return F.when(F.contains(header, F.lit(f"{CRLF}{name}: ")), value)


def parse(found: DataFrame) -> DataFrame:
    """What records say, read from the bytes in column ``record`` and nothing else.

    Gives page_id (text, null if the record names none), record_id, record_type, refers_to_id,
    url, block_bytes, block_digest (base 32 SHA-1) and payload_digest (as the header says). Fails
    on a record that is not one: no header block, another length than it says, no end.
    """
    text = F.col("record").cast("string")
    # a header block has no empty line, so the first one ends it
    cut = found.select("record", F.substr(text, F.lit(1), F.locate(CRLF + CRLF, text) + 1).alias("head"))
    start = F.octet_length("head") + 3
    length = F.octet_length("record") - start + 1 - 4
    says = header_field(F.col("head"), "Content-Length").cast("long")
    end = F.substring(F.col("record"), F.octet_length("record") - 3, F.lit(4)).cast("string")
    whole = F.col("head").startswith("WARC/1.1" + CRLF) & (says == length) & (end == CRLF + CRLF)
    record = F.when(F.coalesce(whole, F.lit(False)), F.col("record")).otherwise(
        F.raise_error(F.concat(F.lit("not a record: "), F.col("head"))).cast("binary")
    )
    read = cut.select("head", F.substring(record, start, length).alias("block"))

    def says_(name: str) -> Column:
        return header_field(F.col("head"), name)

    return read.select(
        says_(PAGE_FIELD).alias("page_id"),
        says_("WARC-Record-ID").alias("record_id"),
        says_("WARC-Type").alias("record_type"),
        says_("WARC-Refers-To").alias("refers_to_id"),
        says_("WARC-Target-URI").alias("url"),
        F.octet_length("block").cast("long").alias("block_bytes"),
        base32_sha1(F.col("block")).alias("block_digest"),
        F.regexp_replace(says_("WARC-Payload-Digest"), "^sha1:", "").alias("payload_digest"),
    )


def resolve(parsed: DataFrame, page_type: str = "bigint") -> DataFrame:
    """Per record of ``parse``: page_id, url, payload_bytes, payload_digest, record_type, refers_to.

    A response has the payload in its block; a revisit's is in the record that it refers to,
    found by WARC-Record-ID, whose page is ``refers_to``. Fails where a payload has not the digest
    that the record says, or a revisit refers to nothing.
    """
    response = F.col("record_type") == "response"
    held = parsed.where(response).select(
        F.col("record_id").alias("refers_to_id"),
        F.col("page_id").alias("referred"),
        F.col("block_bytes").alias("held_bytes"),
        F.col("block_digest").alias("held_digest"),
    )
    # records of rows without a page_id may share a name, but none refers to these
    held = held.where("referred IS NOT NULL")
    revisits = parsed.where(~response).join(held, "refers_to_id", "left")
    own = parsed.where(response).select(
        "*",
        F.lit(None).cast("string").alias("referred"),
        F.col("block_bytes").alias("held_bytes"),
        F.col("block_digest").alias("held_digest"),
    )
    right = F.coalesce(F.col("held_digest") == F.col("payload_digest"), F.lit(False))
    digest = F.when(right, F.col("held_digest")).otherwise(
        F.raise_error(F.concat(F.lit("no such payload: "), F.col("record_id"))).cast("string")
    )
    return own.unionByName(revisits).select(
        F.col("page_id").cast(page_type).alias("page_id"),
        "url",
        F.col("held_bytes").alias("payload_bytes"),
        digest.alias("payload_digest"),
        "record_type",
        F.col("referred").cast(page_type).alias("refers_to"),
    )


def export(found: DataFrame, path: str, file_records: int = FILE_RECORDS) -> None:
    """Writes the records as plain .warc content: one after the other, each ended by CRLFs.

    Spark's text writer ends every row with the two line ends that end a record.
    """
    end = F.lit(CRLF).cast("binary")
    block = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(
        F.lit("").cast("binary")
    )
    value = F.concat(F.col("header").cast("binary"), end, block).cast("string")
    found.select(value.alias("value")).write.option("lineSep", CRLF + CRLF).option(
        "maxRecordsPerFile", file_records
    ).text(path)
