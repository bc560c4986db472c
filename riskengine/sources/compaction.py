"""Merging the small files of closed hours; readers see all of a merge or nothing of it.

The files of a landed zone stay as its stream wrote them. Beside them, in `<zone>-merged`, every merge
has a folder of its own and a commit file that names the files it stands for. A reader takes the
landed files that no commit names and the folders of the commits, so a merge that has no commit yet,
or never gets one, is not seen, and a file that lands late in a merged hour is read as it is. Of two
merges at once over the same files one gets the commit and the other is dropped.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskengine.sources.commits import claim, write_text
from riskengine.sources.files import drop_folder, path_exists

TARGET_BYTES = 128 << 20
_COMMIT = (
    T.StructType()
    .add("version", T.LongType())
    .add("folder", T.StringType())
    .add("replaced", T.ArrayType(T.StringType()))
)


def _beside(zone: str) -> str:
    return f"{zone.rstrip('/')}-merged"


def _name(path: str) -> str:
    return path.rpartition("/")[2]


def _commits(spark: SparkSession, zone: str) -> list[dict]:
    """One entry per merge: its number, folder and the names of the files it stands for."""
    folder = f"{_beside(zone)}/commits"
    if not path_exists(spark, folder):
        return []
    return [r.asDict() for r in spark.read.schema(_COMMIT).json(folder).collect()]


def _loose(spark: SparkSession, zone: str, schema: T.StructType, commits: list[dict]) -> list[str]:
    """Landed files that no merge stands for; the stream's own log says which have landed."""
    merged = {name for c in commits for name in c["replaced"]}
    return sorted(f for f in spark.read.schema(schema).parquet(zone).inputFiles() if _name(f) not in merged)


def _files(spark: SparkSession, zone: str, schema: T.StructType, files: list[str]) -> DataFrame:
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", zone).parquet(*files)


def read_merged(spark: SparkSession, zone: str, schema: T.StructType) -> DataFrame:
    """All rows of a zone: from merged files where there are some, else from the landed ones."""
    commits = _commits(spark, zone)
    if not commits:
        return spark.read.schema(schema).parquet(zone)
    rows = _files(spark, zone, schema, _loose(spark, zone, schema, commits))
    merged = spark.read.schema(schema).option("basePath", f"{_beside(zone)}/data")
    return rows.unionByName(merged.parquet(*(c["folder"] for c in commits)).select(rows.columns))


def _bins(spark: SparkSession, files: list[str], before: datetime, target: int) -> list[tuple[str, int]]:
    """(file name, bin) of the files to merge: those of one closed hour, up to the target together."""
    limit = f"date={before:%Y-%m-%d}/hour={before:%H}"
    closed = [f for f in files if "/".join(unquote(f).split("/")[-3:-1]) < limit]
    if not closed:
        return []
    # Only names and lengths are read. A file of half the target is left as it is.
    sizes = spark.read.format("binaryFile").load(closed).select("path", "length")
    small = sorted(r for r in sizes.where(F.col("length") < target // 2).collect())
    bins, hour, filled = [], None, 0
    for r in small:
        parent = r["path"].rpartition("/")[0]
        if parent != hour or filled + r["length"] > target:
            bins.append([])
            hour, filled = parent, 0
        bins[-1].append(_name(r["path"]))
        filled += r["length"]
    worth = [names for names in bins if len(names) > 1]
    return [(name, i) for i, names in enumerate(worth) for name in names]


def compact(
    spark: SparkSession,
    zone: str,
    schema: T.StructType,
    before: datetime | None = None,
    target_bytes: int = TARGET_BYTES,
) -> int:
    """Merge the small files of the hours before `before` (UTC; default: the current hour).

    `schema` has the partition columns `date` and `hour` last. Returns how many files were merged;
    0 when there is nothing to gain or another merge of the same files was first. What goes to the
    driver are names and lengths of landed files that are not merged yet.
    """
    before = before or datetime.now(timezone.utc)
    commits = _commits(spark, zone)
    files = _loose(spark, zone, schema, commits)
    bins = _bins(spark, files, before, target_bytes)
    if not bins:
        return 0
    names = [name for name, _ in bins]
    chosen = set(names)
    rows = _files(spark, zone, schema, [f for f in files if _name(f) in chosen])
    number = spark.createDataFrame(bins, "name string, bin int")
    binned = rows.withColumn("name", F.col("_metadata.file_name")).join(number, "name").drop("name")
    token = uuid.uuid4().hex
    folder = f"{_beside(zone)}/data/merge=m{token}"
    # One task a bin, one file a task.
    count = max(b for _, b in bins) + 1
    binned.repartitionById(count, F.col("bin")).drop("bin").write.partitionBy("date", "hour").parquet(folder)
    written, read = spark.read.schema(schema).parquet(folder).count(), rows.count()
    if written != read:
        raise RuntimeError(f"merged {written} of {read} rows of {zone}")
    return len(names) if _commit(spark, zone, commits, token, folder, names) else 0


def _commit(spark: SparkSession, zone: str, seen: list[dict], token: str, folder: str, names: list[str]) -> bool:
    version = max((c["version"] for c in seen), default=0)
    root = f"{_beside(zone)}/commits"
    while True:
        version += 1
        # The name begins with a dot, so that readers pass over it.
        aside = f"{root}/.{token}-{version}"
        write_text(spark, aside, json.dumps({"version": version, "folder": folder, "replaced": names}))
        if claim(spark, aside, f"{root}/{version:012d}.json"):
            return True
        taken = {name for c in _commits(spark, zone) if c["version"] >= version for name in c["replaced"]}
        drop_folder(spark, aside)
        if taken & set(names):
            drop_folder(spark, folder)
            return False
