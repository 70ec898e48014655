"""WARC archives with revisit records.

Headers (page id, url, payload digest and length; not the payloads) are written
once and shuffled by digest.  Of the rows of a digest with at least
``MIN_BYTES`` bytes one is the response: that with the largest page id, of
several with that id the one with the largest url, of equal ones any.  All
other rows become revisit records, which are made from headers alone and refer
to the response.  The pages are read again only for the responses: the digests
that occur more than once are few, and are broadcast behind a check of their
size (beyond it the join shuffles).  So payloads do not move.

Archives get fresh headers and are written gzip-compressed by Spark's text
writer, whose line separator is the record end, so any Hadoop file system holds
them.  A file has at most ``RECORDS`` records and, unless a single record is
larger, ``ARCHIVE_BYTES`` bytes before compression.  Reading parses a file as a
stream by Content-Length.

Edge cases: null html is an empty payload; payloads under ``MIN_BYTES`` are
always responses; a null page id is smaller than any other, has no page header
and is read back as null; of rows equal in id and payload one is the response
and the rest refer to it; a null url gives an empty target; line ends in urls
are percent-encoded; an empty table gives an empty archive; other columns are
ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.joins import checked_broadcast
from tidemark.operators.ordering import number_in_groups
from tidemark.session import materialize

MIN_BYTES = 1000
#: Fixed so that archives are reproducible; a parameter of ``write``.
DATE = "2024-01-01T00:00:00Z"
#: Records and bytes of one archive file at most.
RECORDS, ARCHIVE_BYTES = 2000, 64 << 20
#: Records that are read together.
ROWS = 256
END = "\r\n\r\n"
SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def digested(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    return (pages.select("page_id", "url", payload.alias("payload"))
            .select("page_id", "url", "payload", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest")))


def resolve(pages: DataFrame, min_bytes: int = MIN_BYTES) -> tuple[DataFrame, DataFrame]:
    """The revisit records (headers and refers_to) and the responses (with payloads)."""
    heads = materialize(digested(pages).drop("payload"), "warc-headers")
    owners = (heads.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest")
              .agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("page_id", "url")).alias("owner")).where("n > 1")
              .select("payload_digest", F.col("owner.page_id").alias("owner"), F.col("owner.url").alias("owner_url")))
    owners = checked_broadcast(materialize(owners, "warc-owners"))
    is_owner = F.col("page_id").eqNullSafe(F.col("owner")) & F.col("url").eqNullSafe(F.col("owner_url"))
    several = heads.join(owners, "payload_digest")
    columns = ["page_id", "url", "payload_bytes", "payload_digest", F.col("owner").alias("refers_to")]
    revisits = several.where(~is_owner).select(*columns)
    responses = (digested(pages).join(owners.withColumn("found", F.lit(True)), "payload_digest", "left")
                 .where(F.col("found").isNull() | is_owner).drop("owner", "owner_url", "found"))
    # rows equal in id, url and payload: one is the response, numbered by their headers
    again = several.where(is_owner).groupBy("payload_digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("payload_digest")
    again = materialize(again, "warc-repeated")
    if again.isEmpty():
        return revisits, responses
    again = checked_broadcast(again)
    equal = several.where(is_owner).join(again, "payload_digest", "left_semi").withColumn("_row", F.monotonically_increasing_id())
    more = number_in_groups(equal, ["payload_digest"], ["_row"], "_place").where("_place > 1").select(*columns)
    one = (responses.join(again, "payload_digest", "left_semi").groupBy("payload_digest")
           .agg(*[F.first(c).alias(c) for c in ("page_id", "url", "payload", "payload_bytes")]))
    return revisits.unionByName(more), responses.join(again, "payload_digest", "left_anti").unionByName(one)


def record_text(revisit: bool, date: str = DATE, min_bytes: int = MIN_BYTES):
    """One WARC record, without its end, as a string column over the rows of ``resolve``.

    A response of at least ``min_bytes`` is the only one of its digest, which
    names it; other records get an id of their own.
    """
    c = F.col
    text = lambda x: F.coalesce(x.cast("string"), F.lit(""))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    known = lambda name, value: F.when(value.isNotNull(), line(name, value.cast("string"))).otherwise(F.lit(""))
    uri = F.regexp_replace(F.regexp_replace(text(c("url")), "\r", "%0D"), "\n", "%0A")
    http = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n")
    body = http if revisit else F.concat(http, c("payload").cast("string"))
    owner, fresh = F.concat(F.lit("<urn:sha1:"), c("payload_digest"), F.lit(">")), F.concat(F.lit("<urn:uuid:"), F.expr("uuid()"), F.lit(">"))
    return F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.lit("revisit" if revisit else "response")), line("WARC-Date", F.lit(date)), line("WARC-Target-URI", uri),
        line("WARC-Record-ID", fresh if revisit else F.when(c("payload_bytes") >= min_bytes, owner).otherwise(fresh)), known("X-Page-ID", c("page_id")),
        *([line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), line("WARC-Refers-To", owner), known("X-Refers-To-Page", c("refers_to"))] if revisit else []),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), c("payload_digest"))), line("X-Payload-Length", c("payload_bytes").cast("string")),
        line("Content-Type", F.lit("application/http;msgtype=response")), line("Content-Length", F.octet_length(body).cast("string")),
        F.lit("\r\n"), body)


def write(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES, date: str = DATE) -> None:
    """Write the deduplicated archives below ``path``: revisits, responses, and large responses with fewer records a file."""
    revisits, responses = resolve(pages, min_bytes)

    def save(rows: DataFrame, kind: str, revisit: bool, records: int) -> None:
        (rows.select(record_text(revisit, date, min_bytes).alias("value")).write.option("lineSep", END).option("compression", "gzip")
         .option("maxRecordsPerFile", records).mode("errorifexists").text(f"{path.rstrip('/')}/{kind}"))

    large = ARCHIVE_BYTES // RECORDS
    save(revisits, "revisit", True, RECORDS)
    save(responses.where(F.col("payload_bytes") <= large), "response", False, RECORDS)
    if most := pages.agg(F.max(F.octet_length("html"))).first()[0] or 0:
        if most > large:
            save(responses.where(F.col("payload_bytes") > large), "large", False, max(1, ARCHIVE_BYTES // most))


def parse(raw: bytes) -> Iterator[tuple]:
    """Records of one archive, as a stream: one record is held at a time."""
    f = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(raw)))  # type: ignore[arg-type]
    while f.peek(1):
        if (line := f.readline()) in (b"\r\n", b"\n"):
            continue
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"no record begins with {line[:40]!r}")
        fields = {}
        while (line := f.readline()) != b"\r\n":
            name, value = line[:-2].decode("utf-8").split(": ", 1)
            fields[name] = value
        block = f.read(int(fields["Content-Length"]))
        payload = block[block.index(b"\r\n\r\n") + 4:]
        digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
        if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
        page = lambda name: int(fields[name]) if name in fields else None
        yield (page("X-Page-ID"), fields["WARC-Target-URI"], int(fields["X-Payload-Length"]), digest, kind, page("X-Refers-To-Page"), payload if kind == "response" else None)


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records below ``path``; each archive file is parsed by one task, in batches of at most ``ROWS`` records."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    types = {"page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "payload": pa.binary()}
    chosen = [(k, n) for k, n in enumerate(names) if payloads or n != "payload"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for raw in b.column("content"):
                records = parse(raw.as_py())
                while rows := [tuple(r[k] for k, _ in chosen) for r in itertools.islice(records, ROWS)]:
                    yield pa.RecordBatch.from_arrays([pa.array(list(v), type=types[n]) for (_, n), v in zip(chosen, zip(*rows))], names=[n for _, n in chosen])

    schema = ", ".join(x for x in SCHEMA.split(", ") if payloads or x.split()[0] != "payload")
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.txt.gz").option("recursiveFileLookup", "true").load(path).select("content")
            .mapInArrow(run, schema))
