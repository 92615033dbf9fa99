"""Operator 10: WARC archives with identical payloads resolved to revisit records.

Headers (page, digest, size) are shuffled by payload digest, without the payloads: of
payloads of `least` bytes or more that are equal, the one with the largest page_id is the
original. The others are joined back to their pages as revisits, and the archives are
written with fresh headers: a response carries HTTP headers and payload, a revisit the
HTTP headers only and a reference to the original.

An archive is a text file whose rows are whole records and whose line separator is the
empty lines that end a record, so Spark's own writer makes it, on any file system and
with any of its compressions. Records are read back by their declared lengths, so a
payload may hold anything, record starts included.

Cases: null html is an empty payload; a null or broken url is written without its line
breaks or as an empty one; a repeated page is written once per repetition, and pages
that share the original's page_id and payload are all responses; of equal payloads
without any page_id all are responses; a null page_id otherwise revisits like any other;
an empty table gives archives without records; other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
LINE = "\r\n"

_ID = "urn:page:"
_READ = (
    "page_id bigint, url string, record_type string, payload_digest string, refers_to bigint, "
    "payload_bytes bigint, payload string, intact boolean"
)


def resolve(pages: DataFrame, least: int = 1000) -> DataFrame:
    """The pages with `payload`, `payload_bytes`, `payload_digest` and `refers_to`, the
    page_id of the original for what is a revisit and null for a response."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    pages = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("bigint").alias("payload_bytes"),
        F.sha1(payload.cast("binary")).alias("payload_digest"),
    )
    headers = pages.where(F.col("payload_bytes") >= least).select("page_id", "payload_digest")
    originals = (
        headers.groupBy("payload_digest")
        .agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
        .where((F.col("n") > 1) & F.col("refers_to").isNotNull())
        .drop("n")
    )
    revisits = (
        headers.join(originals, "payload_digest")
        .where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .groupBy(F.coalesce("page_id", F.lit(0)).alias("id"), F.col("page_id").isNull().alias("no_id"), "payload_digest")
        .agg(F.max("refers_to").alias("refers_to"))
        .withColumnRenamed("payload_digest", "digest")
    )
    same = (
        (F.coalesce(pages["page_id"], F.lit(0)) == revisits["id"])
        & (pages["page_id"].isNull() == revisits["no_id"])
        & (pages["payload_digest"] == revisits["digest"])
    )
    return pages.join(revisits, same, "left").drop("id", "no_id", "digest")


def _headers(*lines: Column) -> Column:
    return F.concat(*[F.concat(line, F.lit(LINE)) for line in lines])


def _named(name: str, value: Column | str) -> Column:
    return F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value)


def record(date: str) -> Column:
    """The text of a WARC record of a resolved page."""
    is_revisit = F.col("refers_to").isNotNull()
    number = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]", "")
    http = _headers(
        F.lit("HTTP/1.1 200 OK"),
        F.lit("Content-Type: text/html; charset=utf-8"),
        _named("Content-Length", F.col("payload_bytes").cast("string")),
        F.lit(""),
    )
    # The empty line ends the headers; `_headers` has put a break after it.
    block = F.when(is_revisit, http).otherwise(F.concat(http, F.col("payload")))
    ours = [
        F.lit(VERSION),
        _named("WARC-Type", F.when(is_revisit, "revisit").otherwise("response")),
        _named("WARC-Record-ID", F.concat(F.lit(f"<{_ID}"), number(F.col("page_id")), F.lit(">"))),
        _named("WARC-Date", date),
        _named("WARC-Target-URI", uri),
        _named("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
    ]
    about_original = F.when(
        is_revisit,
        _headers(
            _named("WARC-Refers-To", F.concat(F.lit(f"<{_ID}"), number(F.col("refers_to")), F.lit(">"))),
            _named("WARC-Profile", PROFILE),
        ),
    ).otherwise("")
    size = _named("Content-Length", F.octet_length(block).cast("string"))
    kind = F.lit("Content-Type: application/http; msgtype=response")
    return F.concat(_headers(*ours), about_original, _headers(kind, size, F.lit("")), block)


def write(
    resolved: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", compression: str = "gzip", per_file: int = 5000
) -> None:
    """Archives of at most `per_file` records each under `path`."""
    writer = resolved.select(record(date).alias("value")).write.option("lineSep", END)
    writer.option("maxRecordsPerFile", per_file).option("compression", compression).text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of archives, framed by their declared lengths. `intact` says whether a
    response's payload has the declared digest and size; a revisit has a null payload."""

    def run(batches):
        for batch in batches:
            for i, content in enumerate(batch.column(1)):
                raw = content.as_py()
                if batch.column(0)[i].as_py().endswith(".gz"):
                    raw = gzip.decompress(raw)
                yield from _parsed(raw)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(run, _READ)


def _parsed(raw: bytes, per_batch: int = 500):
    """The records of one archive, some at a time."""
    rows, at = [], 0
    while at < len(raw):
        stop = raw.index(END.encode(), at)
        first, *lines = raw[at:stop].decode().split(LINE)
        if first != VERSION:
            raise ValueError(f"no record at byte {at}")
        fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
        begin = stop + len(END)
        end = begin + int(fields["Content-Length"])
        rows.append(_row(fields, raw[begin:end]))
        at = end + len(END)
        if len(rows) == per_batch:
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
            rows = []
    yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)


def _row(fields: dict[str, str], block: bytes) -> dict:
    page = lambda name: None if (v := fields.get(name, "null").strip("<>").removeprefix(_ID)) == "null" else int(v)
    http, _, payload = block.partition(END.encode())
    length = int(next(x for x in http.decode().split(LINE) if x.startswith("Content-Length: ")).split(": ")[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    is_revisit = fields["WARC-Type"] == "revisit"
    return {
        "page_id": page("WARC-Record-ID"),
        "url": fields["WARC-Target-URI"],
        "record_type": fields["WARC-Type"],
        "payload_digest": digest,
        "refers_to": page("WARC-Refers-To"),
        "payload_bytes": length,
        "payload": None if is_revisit else payload.decode(),
        "intact": is_revisit or (hashlib.sha1(payload).hexdigest() == digest and len(payload) == length),
    }


_ARROW = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("payload_digest", pa.string()),
        ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload", pa.string()),
        ("intact", pa.bool_()),
    ]
)


def joined(records: DataFrame) -> DataFrame:
    """Read records with each revisit checked against its original: a revisit is intact
    if the archives hold an intact response of that page with the same digest and size."""
    key = ["refers_to", "payload_digest", "payload_bytes"]
    responses = (
        records.where((F.col("record_type") == "response") & F.col("intact"))
        .select(F.col("page_id").alias("refers_to"), "payload_digest", "payload_bytes")
        .groupBy(*key)
        .agg(F.lit(True).alias("found"))
    )
    checked = records.join(responses, key, "left")
    intact = F.when(F.col("record_type") == "revisit", F.coalesce("found", F.lit(False))).otherwise(F.col("intact"))
    return checked.withColumn("intact", intact).drop("found")
