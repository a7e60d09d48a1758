"""Content-addressed web archive (operator 4).

``archive`` writes two tables in place of one file of records: *payloads* holds
the bytes of every distinct payload once, under their SHA-256; *headers* holds
the exact header of every record, its WARC lines and those of the HTTP message in
its block, with the SHA-256 of its payload.  ``records`` rebuilds the WARC records
byte for byte by joining the two, ``read_back`` parses the rebuilt records and
verifies their lengths and digests, and ``write_warc`` writes them as WARC files.

Of records with equal payloads of at least ``min_bytes`` bytes, the one with the
largest page id is the response and the others are revisits of it.  A revisit's
block is the HTTP header alone, whose Content-Length is that of the payload.

Payloads are grouped by digest with a map-side combine, so copies in one task
travel once and a payload that a third of the pages share makes no hot task.
Only responses are joined with payload bytes, revisits with the stored digests,
so a hot payload is moved once.

Defined results: a null html is the empty payload; very long ones are stored
whole; rows that repeat the largest page id with the same payload are all
responses; where every page id of a group is null, all are responses; line breaks
in a url are percent-encoded in the header; a null url gives no WARC-Target-URI;
repeated rows give repeated records; page ids may be of any type that has an
order and a text; an empty table gives an empty archive; other columns play no
role.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import shared_dir, staged

MIN_BYTES = 0
_EOL = "\r\n"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: 8 groups of 5 hex digits give 4 letters each."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def record_id(page: Column) -> Column:
    """The id as text, percent-encoded where it is no number or plain name."""
    return F.concat(F.lit("<urn:page:"), F.coalesce(F.url_encode(page.cast("string")), F.lit("none")), F.lit(">"))


def header(page: Column, url: Column, kind: Column, target: Column, sha1: Column, n_bytes: Column, date: str) -> Column:
    """The exact header of a record, up to its payload: its own lines, and those of the HTTP message in its block."""
    safe = F.regexp_replace(F.regexp_replace(url, "\r", "%0D"), "\n", "%0A")
    http = F.concat(F.lit(_EOL.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", "Content-Length: "])), n_bytes.cast("string"), F.lit(_EOL * 2))
    block = F.octet_length(http) + F.when(kind == "revisit", F.lit(0).cast("long")).otherwise(n_bytes)
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: "), record_id(page)),
        F.concat(F.lit("WARC-Target-URI: "), safe),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), sha1),
        F.when(kind == "revisit", F.concat(F.lit("WARC-Refers-To: "), record_id(target))),
        F.when(kind == "revisit", F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), block.cast("string")),
    ]
    return F.concat(F.concat_ws(_EOL, *lines), F.lit(_EOL * 2), http)


def archive(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = MIN_BYTES, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write ``pages`` as ``path/payloads`` and ``path/headers``."""
    payload = F.coalesce(F.col(html).cast("string"), F.lit(""))
    rows = pages.select(F.col(page_id).alias("page"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha256", F.unhex(F.sha2("payload", 256)))
    blobs = rows.groupBy("sha256").agg(F.first("payload").alias("payload"))
    blobs.withColumn("payload", F.encode("payload", "utf-8")).write.option("compression", "zstd").parquet(f"{path}/payloads")
    narrow = rows.select("page", "url", "sha256", F.octet_length("payload").cast("long").alias("n_bytes"), base32_sha1(F.col("payload")).alias("sha1"))
    shared = narrow.where(F.col("n_bytes") >= min_bytes).groupBy("sha256").agg(F.max("page").alias("best"), F.count("*").alias("n")).where("n > 1 and best is not null")
    joined = narrow.join(staged(shared.select("sha256", "best"), "warc-shared"), "sha256", "left")  # as a plain table, so that a hot digest's partition can be split
    kind = F.when(F.col("best").isNotNull() & ~F.col("page").eqNullSafe(F.col("best")), "revisit").otherwise("response")
    block = header(F.col("page"), F.col("url"), F.col("kind"), F.col("best"), F.col("sha1"), F.col("n_bytes"), date)
    joined.withColumn("kind", kind).select("page", "sha256", block.alias("header")).write.option("compression", "zstd").parquet(f"{path}/headers")


def _field(part: str, name: str) -> Column:
    return F.nullif(F.regexp_extract(part, rf"(?:^|\r\n){name}: ([^\r\n]*)(?:\r\n|\z)", 1), F.lit(""))


def records(spark: SparkSession, path: str) -> DataFrame:
    """Every record as the bytes that a WARC file has, rebuilt from the two tables: (page_id, record).

    Stored bytes that do not have their SHA-256, or a header whose payload
    is not stored or has another SHA-1, fail the query.
    """
    stored = spark.read.parquet(f"{path}/payloads").withColumn("actual", F.when(F.unhex(F.sha2("payload", 256)) == F.col("sha256"), base32_sha1(F.col("payload"))))
    heads = spark.read.parquet(f"{path}/headers")
    revisit = F.startswith("header", F.lit(f"WARC/1.1{_EOL}WARC-Type: revisit{_EOL}"))
    digests = staged(stored.select("sha256", "actual"), "warc-digests")
    responses = heads.where(~revisit).join(stored, "sha256", "left")
    revisits = heads.where(revisit).join(digests, "sha256", "left").withColumn("payload", F.encode(F.lit(""), "utf-8"))
    names = ["page", "header", "payload", "actual", "sha256"]
    digest = F.regexp_replace(_field("header", "WARC-Payload-Digest"), "^sha1:", "")
    whole = F.concat(F.encode("header", "utf-8"), F.col("payload"), F.encode(F.lit(_EOL * 2), "utf-8"))
    sound = F.when(F.col("actual") == digest, whole).otherwise(F.raise_error(F.concat(F.lit("payload does not match its digest: "), F.hex("sha256"))))
    return responses.select(names).unionByName(revisits.select(names)).select(F.col("page").alias("page_id"), sound.alias("record"))


def parsed(found: DataFrame) -> DataFrame:
    """The fields of WARC records (page_id, record): page_id, payload_bytes, payload_digest, record_type, refers_to.

    A record whose block is not as long as it says, or whose payload has not the
    stated length and digest, fails the query.
    """
    text = found.select("page_id", F.decode("record", "utf-8").alias("text"))
    own = text.withColumn("head", F.substring_index("text", _EOL * 2, 1))
    block = F.expr("substring(text, length(head) + 5, length(text) - length(head) - 8)")  # between the empty line and the two line ends
    own = own.withColumn("block", block).drop("text").withColumn("http", F.substring_index("block", _EOL * 2, 1))
    own = own.withColumn("payload", F.expr("substring(block, length(http) + 5)"))
    kind, stated = _field("head", "WARC-Type"), _field("http", "Content-Length").cast("long")
    digest = F.regexp_replace(_field("head", "WARC-Payload-Digest"), "^sha1:", "")
    whole = F.octet_length("block") == _field("head", "Content-Length").cast("long")
    same = (kind == "revisit") & (F.col("payload") == "") | (F.octet_length("payload") == stated) & (base32_sha1(F.col("payload")) == digest)
    checked = F.when(whole & same, digest).otherwise(F.raise_error(F.concat(F.lit("a record does not match its header: "), "head")))
    refers = F.url_decode(F.regexp_extract(_field("head", "WARC-Refers-To"), "^<urn:page:(.*)>$", 1)).cast(dict(found.dtypes)["page_id"])
    return own.select("page_id", stated.alias("payload_bytes"), checked.alias("payload_digest"), kind.alias("record_type"), F.when(kind == "revisit", refers).alias("refers_to"))


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """The fields of every rebuilt record."""
    return parsed(records(spark, path))


def write_warc(spark: SparkSession, path: str, target: str, compression: str = "none") -> None:
    """Write the rebuilt records as WARC files, one a task; a record ends in the two line ends that separate lines here."""
    text = F.decode("record", "utf-8")
    rows = records(spark, path).select(text.alias("text")).select(F.expr("substring(text, 1, length(text) - 4)").alias("record"))
    rows.write.option("lineSep", _EOL * 2).option("compression", compression).text(target)


def warc(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Archive ``pages``, rebuild the records and read them: one row per page."""
    spark = pages.sparkSession
    path = path or f"{shared_dir(spark)}/tidemark/warc-{uuid.uuid4().hex}"
    archive(pages, path, **options)
    return read_back(spark, path)
