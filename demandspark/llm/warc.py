"""Content-addressed web archive.

An archive is a folder of two tables. ``payloads`` holds every distinct payload
once, by its address, the SHA-256 of its bytes. ``headers`` holds one row per
record: the exact header bytes, as text, and the address of its payload. Records
are restored by joining the two: the header, an empty line, the HTTP header, and,
unless it is a revisit, the payload.

Writing: payloads get an address each; narrow rows (address, size, id) tell which
record of equal payloads is the response and how many there are. Only distinct
payloads are shuffled; rows that give one address for two sizes or second hashes end the
job. Reading verifies each payload
once more: bytes that don't give their address end the job.

Hot payloads: an address with many records is split into parts of about PART
records; its payload goes to each part, so that no join task gets all records
of an address. At most one payload copy is added per PART records.

``warc_files`` writes restored records as WARC files (compressed text parts):
every record ends with two line ends, which is the writer's line separator.

Defined cases: a null payload is an empty one; records under ``least`` bytes are
all responses, whatever equals them (they share a stored payload all the same);
of equal larger ones the record with the largest id is the response, also all
rows that repeat that id; rows with a null id are revisits of it, and responses
where no equal record has an id. A null url has no WARC-Target-URI; line ends
and other control characters in a url are percent-encoded, as a header field
ends there. An empty table gives an empty archive. Only id, url and payload are
read, so other names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.llm.common import discard_at_end, stash
from demandspark.session import scratch_path

LEAST = 1000
PART = 1000
WHEN = "1970-01-01T00:00:00Z"
END = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(x: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(x.cast("string"), F.lit("null")), F.lit(">"))


def field(name: str, value: Column) -> Column:
    """A header line; none where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(END)), F.lit(""))


def one_line(x: Column) -> Column:
    """Control characters as percent-encoded bytes."""
    clean = x
    for code in (*range(0x20), 0x7F):
        clean = F.replace(clean, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.when(F.rlike(x, F.lit("[\\x00-\\x1F\\x7F]")), clean).otherwise(x)


def http_header(size: Column) -> Column:
    return F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), size.cast("string"), F.lit(END * 2))


def addressed(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"").cast("binary"))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    return rows.withColumns({"address": F.sha2("payload", 256), "size": F.octet_length("payload").cast("long")})


def write_archive(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = LEAST, when: str = WHEN) -> None:
    """Writes the tables ``payloads`` and ``headers`` below ``folder``."""
    rows = addressed(pages, id_col, url_col, payload_col)
    sign = F.xxhash64("payload")
    groups = rows.groupBy("address").agg(
        F.max("id").alias("keeper"), F.count(F.lit(1)).alias("records"),
        F.min("size").alias("size"), F.max("size").alias("size2"), F.min(sign).alias("sign"), F.max(sign).alias("sign2"),
    )
    alike = (F.col("size") == F.col("size2")) & (F.col("sign") == F.col("sign2"))
    parts = F.floor((F.col("records") - 1) / PART + 1).cast("int")
    groups = groups.select("address", "keeper", parts.alias("parts"), F.assert_true(alike, F.concat(F.lit("different payloads have the address "), "address")).alias("checked"))
    groups = stash(groups.where("checked is null").drop("checked"), "warc-groups")

    # records of one address differ in nothing that tells which payload to keep: any of them
    kept = rows.groupBy("address").agg(F.first("payload").alias("payload"))
    kept.join(groups.select("address", "parts"), "address").write.parquet(f"{folder}/payloads")

    # an address with many records is a skewed key of narrow rows, which AQE splits
    told = rows.withColumn("digest", F.sha1("payload")).drop("payload").join(groups, "address")
    revisit = (F.col("size") >= least) & F.col("keeper").isNotNull() & ~F.col("id").eqNullSafe(F.col("keeper"))
    told = told.withColumn("kind", F.when(revisit, "revisit").otherwise("response"))
    http = http_header(F.col("size"))
    header = F.concat(
        F.lit(f"WARC/1.1{END}"), field("WARC-Type", F.col("kind")), field("WARC-Record-ID", record_id(F.col("id"))), field("WARC-Date", F.lit(when)),
        field("WARC-Target-URI", one_line(F.col("url"))), field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        field("WARC-Profile", F.when(revisit, F.lit(PROFILE))), field("WARC-Refers-To", F.when(revisit, record_id(F.col("keeper")))),
        field("Content-Type", F.lit("application/http; msgtype=response")),
        field("Content-Length", (F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("size"))).cast("string")),
    )
    part = F.pmod(F.xxhash64("id", "url", F.rand(7)), F.col("parts")).cast("int")
    told.select(header.alias("header"), http.alias("http"), "address", part.alias("part")).write.parquet(f"{folder}/headers")


def restored(spark: SparkSession, folder: str) -> DataFrame:
    """header, http, payload (also of revisits, by the record that they refer to), address of every record."""
    headers = spark.read.schema("header string, http string, address string, part int").parquet(f"{folder}/headers")
    payloads = spark.read.schema("address string, payload binary, parts int").parquet(f"{folder}/payloads")
    sound = F.assert_true(F.sha2("payload", 256) == F.col("address"), F.concat(F.lit("a stored payload differs from its address "), "address"))
    payloads = payloads.withColumn("checked", sound).where("checked is null")
    payloads = payloads.select("address", "payload", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    return headers.join(payloads, ["address", "part"]).select("header", "http", "payload", "address")


def header_field(name: str) -> Column:
    """A field's value, null if the header has none."""
    found = F.regexp_extract("header", rf"\r\n{name}: ([^\r]*)\r\n", 1)
    return F.when(found != "", found)


def record_number(name: str, kind: str) -> Column:
    """The id that a field names."""
    found = F.regexp_extract(header_field(name), "^<urn:x-page:(.*)>$", 1)
    return F.when((found != "") & (found != "null"), found).cast(kind)


def read_archive(spark: SparkSession, folder: str, kind: str = "long") -> DataFrame:
    """``page_id, url, payload, record_type, refers_to`` of every record, from its header and its payload."""
    rows = restored(spark, folder)
    return rows.select(record_number("WARC-Record-ID", kind).alias("page_id"), header_field("WARC-Target-URI").alias("url"), "payload", header_field("WARC-Type").alias("record_type"), record_number("WARC-Refers-To", kind).alias("refers_to"))


def warc_files(spark: SparkSession, folder: str, out: str, records: int = 100_000) -> None:
    """Writes the restored records as compressed WARC files of at most ``records`` each."""
    block = F.when(header_field("WARC-Type") == "revisit", F.lit(b"").cast("binary")).otherwise(F.col("payload"))
    whole = F.concat(F.concat("header", F.lit(END), "http").cast("binary"), block).cast("string")
    restored(spark, folder).select(whole.alias("value")).write.option("lineSep", END * 2).option("compression", "gzip").option("maxRecordsPerFile", records).text(out)


def archived(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = LEAST) -> DataFrame:
    """Archives the pages in the shared scratch folder and reads the archive back: ``id_col, payload_bytes, payload_digest, record_type, refers_to, url``."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "llm-warc")
    discard_at_end(spark, folder)
    write_archive(pages, folder, id_col, url_col, payload_col, least)
    rows = read_archive(spark, folder, dict(pages.dtypes)[id_col])
    return rows.select(F.col("page_id").alias(id_col), F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"), "record_type", "refers_to", "url")
