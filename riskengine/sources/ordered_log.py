"""An ordered message log: messages with a global rank, read as a stream whose offset is a rank.

A log folder holds `slices`, Parquet files of messages range-sorted by the writer, and `manifest`,
the rank of the first message of each file. A reader's offset is the rank of the next message, so
order, first row, limit and records per batch are all part of it: a batch is the ranks between two
offsets, whatever the files look like and however often the query is restarted.

Files are opened with pyarrow on the executors; the folder's URI must be one that
`pyarrow.fs.FileSystem.from_uri` knows (file, hdfs, s3, gs).
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

FORMAT = "ordered_log"
# Messages that one task of a batch reads at most.
TASK_ROWS = 250_000
_OUT = pa.schema([("rank", pa.int64()), ("value", pa.string())])


def write_log(messages: DataFrame, order: tuple[str, ...], path: str, slices: int) -> int:
    """Write (value, order columns) as a log in the given order; returns the number of messages."""
    spark = messages.sparkSession
    ordered = messages.repartitionByRange(slices, *order).sortWithinPartitions(*order)
    ordered.select(F.col("value").cast("string").alias("value")).write.parquet(f"{path}/slices")
    # One row per file.
    counts = (
        spark.read.parquet(f"{path}/slices")
        .groupBy(F.col("_metadata.file_name").alias("file"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .collect()
    )
    entries, first = [], 0
    for r in sorted(counts, key=lambda r: (int(re.match(r"part-(\d+)", r["file"])[1]), r["file"])):
        entries.append((r["file"], first, r["rows"]))
        first += r["rows"]
    listed = spark.createDataFrame(entries, "file string, first long, rows long")
    listed.coalesce(1).write.json(f"{path}/manifest")
    return first


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The whole log as a table of (rank, value)."""
    manifest = spark.read.schema("file string, first long, rows long").json(f"{path}/manifest")
    rows = spark.read.parquet(f"{path}/slices").select(
        "value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at")
    )
    return rows.join(manifest, "file").select((F.col("first") + F.col("at")).alias("rank"), "value")


def _folder(path: str) -> tuple[pafs.FileSystem, str]:
    # Spark writes local URIs with one slash, which pyarrow does not read.
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def _manifest(path: str) -> list[dict]:
    files, root = _folder(path)
    found = []
    for info in files.get_file_info(pafs.FileSelector(f"{root}/manifest")):
        if info.base_name.endswith(".json"):
            with files.open_input_stream(info.path) as stream:
                found += [json.loads(line) for line in stream.read().decode().splitlines() if line]
    return sorted(found, key=lambda e: e["first"])


@dataclass
class RankRange(InputPartition):
    """Messages first <= rank < stop, all in one file that starts at rank `base`."""

    file: str
    base: int
    first: int
    stop: int


class OrderedLogReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.entries = _manifest(self.path)
        total = sum(e["rows"] for e in self.entries)
        self.start = min(int(options.get("start_row", 0)), total)
        self.end = min(self.start + int(options["limit"]), total) if "limit" in options else total
        self.per_trigger = int(options["per_trigger"]) if "per_trigger" in options else None
        self.rate = float(options["per_second"]) if "per_second" in options else None
        self.position = self.start
        self.clock: tuple[float, int] | None = None

    def initialOffset(self) -> dict:
        return {"rank": self.start}

    def latestOffset(self) -> dict:
        """The end of the next batch: everything, or as much as the limits a batch and a second allow."""
        stop = self.end
        if self.per_trigger is not None:
            stop = min(stop, self.position + self.per_trigger)
        if self.rate is not None:
            now = time.monotonic()
            self.clock = self.clock or (now, self.position)
            stop = min(stop, self.clock[1] + int((now - self.clock[0]) * self.rate))
        return {"rank": max(stop, self.position)}

    def partitions(self, start: dict, end: dict) -> list[RankRange]:
        # A restarted query states its last offset by an empty range before it asks for a new one.
        self.position = max(self.position, end["rank"])
        parts = []
        for e in self.entries:
            first, stop = max(e["first"], start["rank"]), min(e["first"] + e["rows"], end["rank"])
            for at in range(first, stop, TASK_ROWS):
                parts.append(RankRange(e["file"], e["first"], at, min(at + TASK_ROWS, stop)))
        return parts

    def read(self, partition: RankRange) -> Iterator[pa.RecordBatch]:
        files, root = _folder(self.path)
        with files.open_input_file(f"{root}/slices/{partition.file}") as stream:
            parquet = pq.ParquetFile(stream)
            base = partition.base
            for g in range(parquet.num_row_groups):
                rows = parquet.metadata.row_group(g).num_rows
                if base < partition.stop and base + rows > partition.first:
                    at = base
                    for batch in parquet.iter_batches(row_groups=[g], columns=["value"]):
                        skip, take = max(0, partition.first - at), min(batch.num_rows, partition.stop - at)
                        if skip < take:
                            ranks = pa.array(range(at + skip, at + take), pa.int64())
                            values = batch.column(0).slice(skip, take - skip)
                            yield pa.RecordBatch.from_arrays([ranks, pc.cast(values, pa.string())], schema=_OUT)
                        at += batch.num_rows
                base += rows


class OrderedLog(DataSource):
    """Options: path, start_row, limit, per_trigger (records a batch), per_second (pace)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "rank long, value string"

    def streamReader(self, schema) -> OrderedLogReader:
        return OrderedLogReader(dict(self.options))


def stream_log(spark: SparkSession, path: str, **options: int | float | None) -> DataFrame:
    """The log as a stream of (rank, value)."""
    spark.dataSource.register(OrderedLog)
    reader = spark.readStream.format(FORMAT).option("path", path)
    for name, value in options.items():
        if value is not None:
            reader = reader.option(name, str(value))
    return reader.load()
