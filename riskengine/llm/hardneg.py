"""Operator 11: hard negatives by Four-Russians scoring of whole anchor sets.

Components become whole numbers, floor(scale * x). A candidate is stored as bit planes: for each
bit of the two's complement and each group of eight dimensions one byte. An anchor is stored as
tables: for each group the sums of all 256 subsets of its eight components, built by doubling. A
group's part of the inner product at one bit is then one lookup of the candidate's byte in the
anchor's table; planes are added from the highest bit down, doubling in between, the sign plane
being subtracted. Scores are full and exact; nothing is estimated or left out.

Candidates and anchors are sorted by label and packed into blocks of bounded size. A task scores one
block of candidates against one block of anchors, so neither a hot label nor a hot vector fills a
task. Positives need only blocks that share a label; then all pairs of blocks are scored for
negatives, within the interval each positive's score gives. Each pair of blocks returns a few rows
per anchor or positive, which are ranked over all blocks.

Defined results: rows with a null id, label or vector, or any null or non-finite component take no
part; an id that occurs more than once stands for its smallest (label, vector); vectors of unequal
length are filled up with zeros, so an empty one scores 0; equal scores are ordered by id; anchors
without positives, and positives without negatives in their interval, give no rows; whole
components are kept within 2^53 of zero, and a score beyond the longs is returned as the nearest
long but ranked as it is; an empty table gives no rows; other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskengine.llm.common import kept_as
from riskengine.session import materialize

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
# A negative's score lies between these percentages of its positive's.
LOW, HIGH = 50, 95
CANDIDATE_ROWS = 4096
ANCHOR_ROWS = 256
# Candidates whose sums are held at once, so that they stay in a core's cache.
SLICE_ROWS = 512

# Whole components stay within this distance of zero.
WIDEST = 1 << 53

_BLOCK = "block_id long, ids array<long>, labels array<long>, body binary"
_POSITIVE = "anchor_id long, positive_id long, score string"
_NEGATIVE = "anchor_id long, positive_id long, negative_id long, positive_score string, negative_score string"
_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def quantised(rows: DataFrame, is_anchor: Column, scale: int = SCALE) -> DataFrame:
    """vec_id, label, q (whole components) and is_anchor, one row for each usable vec_id."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("vector").cast("array<double>").alias("vector"),
    ).where("vec_id is not null and label is not null and vector is not null").where(finite)
    one = usable.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row"))
    least, most = F.lit(float(-WIDEST)), F.lit(float(WIDEST))
    whole = F.transform("row.vector", lambda x: F.floor(F.least(F.greatest(x * float(scale), least), most)).cast("long"))
    return one.select("vec_id", F.col("row.label").alias("label"), whole.alias("q"), is_anchor.alias("is_anchor"))


def bit_planes(values: np.ndarray, bits: int) -> np.ndarray:
    """(bits, groups, rows) bytes: bit b of eight neighbouring components of a row, lowest plane first."""
    rows, dims = values.shape
    padded = np.zeros((rows, -(-dims // 8) * 8), np.int64)
    padded[:, :dims] = values
    planes = [np.packbits((padded >> b & 1).astype(np.uint8), axis=1, bitorder="little").T for b in range(bits)]
    return np.ascontiguousarray(np.stack(planes))


def subset_sums(anchors: np.ndarray, dtype) -> np.ndarray:
    """(groups, 256, anchors): at s, the sum of the group's components at the set bits of s."""
    count, dims = anchors.shape
    groups = -(-dims // 8)
    padded = np.zeros((count, groups * 8), dtype)
    padded[:, :dims] = anchors
    by_dim = padded.reshape(count, groups, 8).transpose(1, 2, 0)
    sums = np.zeros((groups, 256, count), dtype)
    for j in range(8):
        sums[:, 1 << j : 2 << j] = sums[:, : 1 << j] + by_dim[:, j : j + 1]
    return sums


def scores(planes: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """Exact inner products (candidates, anchors) by lookup, shift and addition."""
    bits, groups, rows = planes.shape
    total = np.zeros((rows, tables.shape[2]), tables.dtype)
    part = np.empty((min(SLICE_ROWS, rows), tables.shape[2]), tables.dtype)
    for start in range(0, rows, SLICE_ROWS):
        sums = total[start : start + SLICE_ROWS]
        found = part[: len(sums)]
        for b in range(bits - 1, -1, -1):
            if b == bits - 1:
                add = np.subtract
            else:
                add = np.add
                sums *= 2
            for g in range(groups):
                np.take(tables[g], planes[b, g, start : start + SLICE_ROWS], axis=0, out=found, mode="clip")
                add(sums, found, out=sums)
    return total


def _matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    lengths = column.value_lengths().to_numpy()
    out = np.zeros((len(column), dims), np.int64)
    out[np.arange(dims) < lengths[:, None]] = column.flatten().to_numpy()
    return out


def _pack(rows_in_block: int, dims: int, bits: int | None):
    """Rows as blocks in order of id; the body holds bit planes, or plain components without `bits`."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, rows_in_block):
                batch = whole.slice(start, rows_in_block)
                ids = batch.column("vec_id").to_numpy()
                order = np.argsort(ids, kind="stable")
                labels = batch.column("label").to_numpy()[order]
                values = _matrix(batch.column("q"), dims)[order]
                body = values if bits is None else bit_planes(values, bits)
                yield pa.RecordBatch.from_pydict(
                    {
                        "block_id": pa.array([ids.min()], pa.int64()),
                        "ids": pa.array([ids[order]], pa.list_(pa.int64())),
                        "labels": pa.array([labels], pa.list_(pa.int64())),
                        "body": pa.array([body.tobytes()], pa.binary()),
                    }
                )

    return pack


def _blocks(rows: DataFrame, count: int, size: int, dims: int, bits: int | None, tag: str) -> DataFrame:
    """Blocks of rows of neighbouring labels, each named by its smallest id."""
    dealt = rows.repartitionByRange(max(1, -(-count // size)), "label", "vec_id").sortWithinPartitions("label", "vec_id")
    return materialize(dealt.select("vec_id", "label", "q").mapInArrow(_pack(size, dims, bits), _BLOCK), tag)


class _Scorer:
    """Scores of one pair of blocks, as one key per score: key order is score, then smaller id."""

    def __init__(self, dims: int, bits: int, limit: int):
        self.dims, self.bits = dims, bits
        self.kind = np.int32 if limit < 2**31 else np.int64 if limit < 2**63 else object
        self.key_kind = np.int64 if limit * CANDIDATE_ROWS < 2**62 else object

    def __call__(self, candidates: pd.Series, anchors: pd.Series) -> Iterator[tuple[int, int, np.ndarray]]:
        """For each anchor its id, its label, and a key for each candidate."""
        self.ids, self.labels = np.asarray(candidates["ids"]), np.asarray(candidates["labels"])
        rows = len(self.ids)
        planes = np.frombuffer(candidates["body"], np.uint8).reshape(self.bits, -1, rows)
        values = np.frombuffer(anchors["body"], np.int64).reshape(-1, self.dims)
        tables = subset_sums(values.astype(self.kind), self.kind)
        place = np.arange(rows - 1, -1, -1).astype(self.key_kind)
        keys = scores(planes, tables).T.astype(self.key_kind) * rows + place
        yield from zip(np.asarray(anchors["ids"]).tolist(), np.asarray(anchors["labels"]).tolist(), keys)

    def read(self, key) -> tuple[int, int]:
        """id and score of a key."""
        score, place = divmod(int(key), len(self.ids))
        return int(self.ids[len(self.ids) - 1 - place]), score


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])


def _positives(scorer: _Scorer, top: int):
    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for anchor, label, keys in scorer(left.iloc[0], right.iloc[0]):
            near = np.sort(keys[(scorer.labels == label) & (scorer.ids != anchor)])[::-1][:top]
            rows += [(anchor, i, str(score)) for i, score in map(scorer.read, near)]
        return _frame(rows, _POSITIVE)

    return best


def _negatives(scorer: _Scorer, top: int, low: int, high: int):
    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        wanted: dict[int, list] = {}
        for p in right.iloc[0]["positives"]:
            wanted.setdefault(p["anchor_id"], []).append((p["positive_id"], int(p["score"])))
        rows = []
        for anchor, label, keys in scorer(left.iloc[0], right.iloc[0]):
            if anchor not in wanted:
                continue
            rising = np.sort(keys[scorer.labels != label])
            for positive, score in wanted[anchor]:
                least, most = -(-low * score // 100), high * score // 100
                if least > most:
                    continue
                start, stop = np.searchsorted(rising, [least * len(scorer.ids), (most + 1) * len(scorer.ids)])
                for key in rising[max(start, stop - top) : stop][::-1]:
                    negative, found = scorer.read(key)
                    rows.append((anchor, positive, negative, str(score), str(found)))
        return _frame(rows, _NEGATIVE)

    return best


def _pair_up(candidates: DataFrame, anchors: DataFrame, pairs: DataFrame, work, schema: str) -> DataFrame:
    """`work` on each pair of blocks in `pairs` (block_id, anchor_block), one pair in memory at a time."""
    pairs = materialize(pairs, "block-pairs")
    left = candidates.join(pairs, "block_id").withColumnsRenamed({"block_id": "row_of", "anchor_block": "column_of"})
    right = anchors.join(pairs, "anchor_block").withColumnsRenamed({"block_id": "of_row", "anchor_block": "of_column"})
    left, right = left.groupBy("row_of", "column_of"), right.groupBy("of_row", "of_column")
    return left.cogroup(right).applyInPandas(work, schema)


def _ranked(rows: DataFrame, group: list[str], score: str, tie: str, top: int) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.col(score).cast("decimal(38,0)").desc(), F.col(tie))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _long(score: str) -> Column:
    wide = F.col(score).cast("decimal(38,0)")
    least, most = (F.lit(str(x)).cast("decimal(38,0)") for x in (-(2**63), 2**63 - 1))
    return F.least(F.greatest(wide, least), most).cast("long").alias(score)


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `rows` has vec_id, label and vector; `is_anchor` is a condition on vec_id. An anchor's positives
    are its best rows of the same label, a positive's negatives the best of other labels whose score
    is between `low` and `high` percent of the positive's.
    """
    spark = rows.sparkSession
    named = kept_as(rows, vec_id="vec_id", label="label", vector="vector")
    whole = materialize(quantised(named, is_anchor, scale), "vectors")
    widest = F.max(F.greatest(F.array_max("q"), -F.array_min("q") - 1))
    shape = whole.agg(
        F.count("*").alias("rows"),
        F.count_if("is_anchor").alias("anchors"),
        F.max(F.size("q")).alias("dims"),
        widest.alias("widest"),
    ).first()
    if not shape["anchors"]:
        return spark.createDataFrame([], _RESULT)
    dims, most = max(1, shape["dims"]), shape["widest"] or 0
    bits = most.bit_length() + 1
    candidates = _blocks(whole, shape["rows"], CANDIDATE_ROWS, dims, bits, "candidate-blocks")
    anchors = _blocks(whole.where("is_anchor"), shape["anchors"], ANCHOR_ROWS, dims, None, "anchor-blocks")
    anchors = anchors.withColumnRenamed("block_id", "anchor_block")
    scorer = _Scorer(dims, bits, dims * (most + 1) ** 2)

    labels = F.explode(F.array_distinct("labels")).alias("label")
    same = candidates.select("block_id", labels).join(anchors.select("anchor_block", labels), "label")
    pairs = same.select("block_id", "anchor_block").distinct()
    found = _pair_up(candidates, anchors, pairs, _positives(scorer, positives), _POSITIVE)
    best = _ranked(found, ["anchor_id"], "score", "positive_id", positives)

    members = anchors.select("anchor_block", F.explode("ids").alias("anchor_id"))
    listed = best.join(members, "anchor_id").groupBy("anchor_block").agg(
        F.collect_list(F.struct("anchor_id", "positive_id", "score")).alias("positives")
    )
    anchors = materialize(anchors.join(listed, "anchor_block"), "anchors-positives")
    # Every block of candidates meets every block of anchors; lanes only spread the pairing.
    lanes = -(-shape["anchors"] // ANCHOR_ROWS)
    lane = F.pmod(F.xxhash64("anchor_block"), F.lit(lanes).cast("long"))
    each = candidates.select("block_id", F.explode(F.expr(f"sequence(0L, {lanes - 1}L)")).alias("lane"))
    pairs = each.join(anchors.select("anchor_block", lane.alias("lane")), "lane").select("block_id", "anchor_block")
    found = _pair_up(candidates, anchors, pairs, _negatives(scorer, negatives, low, high), _NEGATIVE)
    ranked = _ranked(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)
    return ranked.select(
        "anchor_id", "positive_id", "rank", "negative_id", _long("positive_score"), _long("negative_score")
    )
