"""Operator 1: WARC archives, written and read with boundary-chain verification.

Writing: one record per page, gathered in gzip files by Spark's text writer. A file takes as many
records as make FILE_BYTES of payload at the mean size of a page, and RECORDS_PER_FILE at most. Of records with equal payloads of 100 bytes or more, the one with the smallest page_id
is a response and the others are revisits that refer to it and carry no payload.

Reading: tasks look for the magic `WARC/1.0` anywhere in a file, payloads included, and emit each
candidate's offset with the offset at which its header says the next record starts. Pointer jumping
from offset 0 doubles the reach in every round, so that a file takes the logarithm of its number of
records in joins; candidates that no chain reaches (magic inside payloads, damaged records) are
rejected. A second pass parses the others. Files are bounded, and whole ones go to one task.

Defined results: a null html is an empty payload; a null url has no target header, control
characters and spaces in urls are percent-encoded; a null page_id has no id header and is null
again when read; a row that shares the smallest page_id of its payload is a response as well;
records after a damaged one in its file are not reachable; empty tables give an empty archive
and no rows; other columns are not written.
"""

from __future__ import annotations

import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskengine.llm.common import kept_as, whole_text
from riskengine.session import materialize, scratch_path

MAGIC = b"WARC/1.0\r\n"
MIN_SHARED_BYTES = 100
RECORDS_PER_FILE = 4096
# Payload of a file, unzipped; a task that reads it back holds it whole.
FILE_BYTES = 64 << 20
DATE = "1970-01-01T00:00:00Z"
_LENGTH = re.compile(rb"\r\nContent-Length: *([0-9]{1,18})\r\n", re.I)
_FIELD = re.compile(rb"\r\n([A-Za-z-]+): *([^\r\n]*)")


def record_roles(pages: DataFrame) -> DataFrame:
    """page_id, url, payload (string), digest, bytes and refers_to (null for responses)."""
    payload = whole_text("html")
    rows = kept_as(pages, page_id="page_id", url="url", html="html").select(
        "page_id",
        "url",
        payload.alias("payload"),
        F.sha2(payload.cast("binary"), 256).alias("digest"),
        F.octet_length(payload).cast("long").alias("bytes"),
    )
    # Digests that occur once need no partner. Written first, so that the join knows its true size
    # and does not shuffle payloads for a few rows.
    shared = (
        rows.where(F.col("bytes") >= MIN_SHARED_BYTES)
        .groupBy(F.col("digest").alias("f_digest"))
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    first = materialize(shared, "warc-shared")
    other = F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    return rows.join(first, F.col("digest") == F.col("f_digest"), "left").select(
        "page_id", "url", "payload", "digest", "bytes", other.alias("refers_to")
    )


def _header(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))


def records_per_file(pages: DataFrame) -> int:
    """How many records of the mean payload size make FILE_BYTES, RECORDS_PER_FILE at most."""
    mean = pages.agg(F.avg(F.octet_length(whole_text("html")))).first()[0] or 0.0
    return max(1, min(RECORDS_PER_FILE, int(FILE_BYTES // max(mean, 1.0))))


def write_warc(pages: DataFrame, path: str) -> None:
    """Write a record per page (page_id, url, html) to gzip archives under `path`."""
    rows = record_roles(pages)
    revisit = F.col("refers_to").isNotNull()
    url = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    block = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    record = F.concat(
        F.lit("WARC/1.0\r\n"),
        F.when(revisit, F.lit("WARC-Type: revisit\r\n")).otherwise(F.lit("WARC-Type: response\r\n")),
        F.lit(f"WARC-Date: {DATE}\r\n"),
        _header("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("page_id").cast("string"), F.lit(">"))),
        _header("WARC-Target-URI", url),
        _header("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.lit("Content-Type: text/html; charset=utf-8\r\n"),
        _header("Content-Length", F.octet_length(block)),
        F.lit("\r\n"),
        block,
        # The writer's line separator completes the closing pair of line ends.
        F.lit("\r\n\r"),
    )
    writer = rows.select(record.alias("value")).write.option("maxRecordsPerFile", records_per_file(pages))
    writer.option("compression", "gzip").option("lineSep", "\n").text(path)


def _records(data: bytes) -> Iterator[tuple[int, int, int, int]]:
    """(offset, end of header, start of payload, offset of the next record or -1) of each candidate."""
    at = data.find(MAGIC)
    while at >= 0:
        closed = data.find(b"\r\n\r\n", at)
        length = _LENGTH.search(data, at, closed + 2) if closed >= 0 else None
        following = -1
        if length:
            following = closed + 4 + int(length[1]) + 4
            if following > len(data) or data[following - 4 : following] != b"\r\n\r\n":
                following = -1
        yield at, closed, closed + 4, following
        at = data.find(MAGIC, at + 1)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """file, at, next of every place that looks like a record; next is null where none can follow.

    `file` is a 64-bit hash of the path, which is all that the joins need.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("file"), batch.column("content")):
                data = gzip.decompress(content.as_py())
                found = [(file.as_py(), a, n if n >= 0 else None) for a, _, _, n in _records(data)]
                columns = [pa.array([r[i] for r in found], pa.int64()) for i in range(3)]
                yield pa.RecordBatch.from_arrays(columns, ["file", "at", "next"])

    files = _files(spark, path).select(F.xxhash64("path").alias("file"), "content")
    return files.mapInArrow(work, "file long, at long, next long")


def reachable(links: DataFrame) -> DataFrame:
    """file, at of the candidates that the chain from the start of their file reaches."""
    valid = links.where("next is not null")
    now = materialize(
        links.select("file", "at", F.col("next").alias("jump"), (F.col("at") == 0).alias("reached")).where(
            "jump is not null"
        ),
        "warc-chain",
    )
    known, more = -1, now.where("reached").count()
    while more != known:
        ahead = now.select(F.col("file").alias("f"), F.col("at").alias("a"), F.col("jump").alias("j"))
        marked = now.where("reached and jump is not null").select(
            F.col("file").alias("mf"), F.col("jump").alias("ma")
        )
        step = (
            now.join(ahead, (F.col("file") == F.col("f")) & (F.col("jump") == F.col("a")), "left")
            .join(marked, (F.col("file") == F.col("mf")) & (F.col("at") == F.col("ma")), "left")
            .select("file", "at", F.col("j").alias("jump"), (F.col("reached") | F.col("ma").isNotNull()).alias("reached"))
        )
        now = materialize(step.groupBy("file", "at").agg(F.max("jump").alias("jump"), F.max("reached").alias("reached")), "warc-chain")
        known, more = more, now.where("reached").count()
    return now.where("reached").select("file", "at").join(valid.select("file", "at"), ["file", "at"], "left_semi")


def read_warc(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """Reachable records: file, at, record_type, page_id, refers_to, uri, payload_bytes,
    payload_digest and whether that is the recorded digest; with the payload if asked for.
    """
    links = materialize(candidates(spark, path), "warc-candidates")
    # What is rejected is the rare case and joins the files as a short list per file.
    unreached = links.join(reachable(links), ["file", "at"], "left_anti")
    rejected = materialize(unreached.groupBy("file").agg(F.collect_list("at").alias("skip")), "warc-rejected")
    files = _files(spark, path).join(rejected, F.xxhash64("path") == F.col("file"), "left").select("path", "content", "skip")
    names = ["file", "at", "record_type", "page_id", "refers_to", "uri", "payload_bytes", "payload_digest", "stated_digest", "intact", "payload"]
    types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.binary()]

    def fields_of(header: bytes) -> dict[str, str]:
        return {m[1].decode().lower(): m[2].decode() for m in _FIELD.finditer(header)}

    def page_of(value: str | None) -> int | None:
        return int(value[len("<urn:page:") : -1]) if value else None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content, skip in zip(*(batch.column(c) for c in ("path", "content", "skip"))):
                data, skipped = gzip.decompress(content.as_py()), set(skip.as_py() or ())
                rows = []
                for at, closed, start, following in _records(data):
                    if at in skipped:
                        continue
                    fields = fields_of(data[at:closed])
                    payload = data[start : following - 4]
                    digest = hashlib.sha256(payload).hexdigest()
                    kind = fields.get("warc-type")
                    rows.append(
                        (file.as_py(), at, kind, page_of(fields.get("warc-record-id")), page_of(fields.get("warc-refers-to")),
                         fields.get("warc-target-uri"), len(payload), digest,
                         fields.get("warc-payload-digest", "").removeprefix("sha256:"),
                         kind == "revisit" or fields.get("warc-payload-digest") == f"sha256:{digest}",
                         payload if with_payload else None)
                    )
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    schema = "file string, at long, record_type string, page_id long, refers_to long, uri string, payload_bytes long, payload_digest string, stated_digest string, intact boolean, payload binary"
    records = files.mapInArrow(work, schema)
    return records if with_payload else records.drop("payload")


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Write the pages to archives in the shared folder, read them back, and resolve the revisits.

    page_id, record_type, refers_to, payload_bytes and payload_digest of the full payload.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_warc(pages, path)
    records = materialize(read_warc(spark, path), "warc-records")
    stored = records.where("record_type = 'response'")
    # Responses may share a page_id, so a revisit is resolved by the digest that it states, too.
    referred = (
        stored.where(F.col("payload_bytes") >= MIN_SHARED_BYTES)
        .select(F.col("page_id").alias("r_id"), F.col("payload_bytes").alias("r_bytes"), F.col("payload_digest").alias("r_digest"))
        .dropDuplicates(["r_id", "r_digest"])
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    same = (F.col("refers_to") == F.col("r_id")) & (F.col("stated_digest") == F.col("r_digest"))
    revisits = records.where("record_type = 'revisit'").join(referred, same, "left")
    resolved = revisits.select(
        "page_id", F.col("r_bytes").alias("payload_bytes"), F.col("r_digest").alias("payload_digest"), "record_type", "refers_to"
    )
    return stored.select(columns).unionByName(resolved)
