"""Summaries and exact quantiles of many columns, by group, in few passes.

Every (group, column) first gets its count, any other aggregates, and a sketch with two points
around each wanted quantile. Another pass counts the values below, on and between these points
and keeps, collapsed to distinct ones, only those that a quantile can be. A group too small for its
points to be apart is kept whole. Only kept values are ordered, in pieces of bounded size, and only
the pieces that hold a wanted rank.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskengine.operators.ordered import BUCKET, melt
from riskengine.session import materialize

# A quantile lies this share of the rows from its points, at most; the sketch is five times as exact.
REACH = 0.0005
ACCURACY = 10_000
# Kept rows of one piece, where values are spread evenly between two points.
PIECE_ROWS = 5_000_000


@dataclass
class _Column:
    """What is known of a (group, column): the points around its quantiles, the slots to keep, and pieces a slot."""

    group: tuple
    feature: str
    n: int
    around: list[tuple[float, float]]
    wanted: set[int] = field(default_factory=set)
    pieces: int = 1

    def bracket(self, points: list[float]) -> None:
        """Choose slots by the column's points, which all groups share.

        Slots are numbered along the line: 0 below the first point, 1 on it, 2 between it and the next.
        """
        if self.n * REACH < 2:
            self.wanted = set(range(2 * len(points) + 1))
            return
        self.pieces = math.ceil(2 * REACH * self.n / PIECE_ROWS)
        at = {v: 2 * i + 1 for i, v in enumerate(points)} | {-math.inf: 0, math.inf: 2 * len(points)}
        self.wanted = {s for lo, hi in self.around for s in range(at[lo], at[hi] + 1)}


def _group_type(df: DataFrame, by: list[str]) -> list[T.StructField]:
    return [T.StructField(f"{c}__g", df.schema[c].dataType) for c in by]


def _slots(df: DataFrame, by: list[str], found: list[_Column], points: dict[str, list[float]]) -> DataFrame:
    """(by, feature, slot, piece, value, at): how often each kept value occurs, and all others by slot."""
    kind = T.StructType(
        [
            *_group_type(df, by),
            T.StructField("feature__g", T.StringType()),
            T.StructField("points", T.ArrayType(T.DoubleType())),
            T.StructField("wanted", T.ArrayType(T.IntegerType())),
            T.StructField("pieces", T.IntegerType()),
        ]
    )
    rows = [(*c.group, c.feature, points[c.feature], sorted(c.wanted), c.pieces) for c in found]
    # One row for each group and column.
    known = F.broadcast(df.sparkSession.createDataFrame(rows, kind))
    # Bucket i begins with point i - 1; a column without points is one bucket in two parts.
    edges = {f: [-math.inf, *(v or [0.0]), math.inf] for f, v in points.items()}
    long = melt(df, list(points), keep=by, edges=edges)
    same = F.col("feature") == F.col("feature__g")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}__g"))
    lo, hi = F.get("points", F.col(BUCKET) - 1), F.get("points", F.col(BUCKET))
    on_point = F.coalesce((F.col("value") == lo).cast("int"), F.lit(0))
    slot = F.when(F.size("points") == 0, 0).otherwise(2 * F.col(BUCKET) - on_point)
    share = (F.col("value") - lo) / (hi - lo)
    piece = F.when(
        (F.col("pieces") > 1) & (share >= 0) & (share < 1), F.floor(share * F.col("pieces")).cast("int")
    ).otherwise(0)
    placed = long.join(known, same).select(*by, "feature", "value", "wanted", slot.alias("slot"), piece.alias("piece"))
    kept = F.when(F.array_contains("wanted", F.col("slot")), F.col("value"))
    return (
        placed.select(*by, "feature", "slot", "piece", kept.alias("value"))
        .groupBy(*by, "feature", "slot", "piece", "value")
        .agg(F.count(F.lit(1)).alias("at"))
    )


def summarize(
    df: DataFrame,
    cols: list[str],
    probs: dict[str, float],
    by: list[str] | None = None,
    aggregates: dict[str, Column] | None = None,
) -> DataFrame:
    """(by, feature, n, aggregates of `value`, interpolated quantiles), missing values left out.

    A (group, column) without values has no row. The driver learns one row for each of the others,
    and the number of rows in each slot.
    """
    by, spark = by or [], df.sparkSession
    aggs = [c.alias(name) for name, c in (aggregates or {}).items()]
    long = melt(df, cols, keep=by)
    seen = long.groupBy(*by, "feature").agg(F.count(F.lit(1)).alias("n"), *aggs)
    rows = seen.collect()
    summary = spark.createDataFrame(rows, seen.schema)
    if not probs or not rows:
        return summary.select("*", *[F.lit(None).cast("double").alias(t) for t in probs])
    # Sketches are a scan of their own: beside them the other aggregates would leave generated code.
    ends = [min(max(q + side * REACH, 0.0), 1.0) for q in probs.values() for side in (-1, 1)]
    sketch = F.expr(f"percentile_approx(value, array({', '.join(map(repr, ends))}), {ACCURACY})").alias("ends__")
    around = {
        (*(r[g] for g in by), r["feature"]): list(zip(r["ends__"][::2], r["ends__"][1::2]))
        for r in long.groupBy(*by, "feature").agg(sketch).collect()
    }
    found = []
    for r in rows:
        key = tuple(r[g] for g in by)
        found.append(_Column(key, r["feature"], r["n"], around[*key, r["feature"]]))
    points = {
        f: sorted({v for c in found if c.feature == f and c.n * REACH >= 2 for pair in c.around for v in pair if math.isfinite(v)})
        for f in sorted({c.feature for c in found})
    }
    for c in found:
        c.bracket(points[c.feature])

    while True:
        kept = materialize(_slots(df, by, found, points), "kept-values")
        sizes: dict[tuple, dict[tuple[int, int], int]] = {}
        for r in kept.groupBy(*by, "feature", "slot", "piece").agg(F.sum("at").alias("n")).collect():
            sizes.setdefault((*(r[g] for g in by), r["feature"]), {})[r["slot"], r["piece"]] = r["n"]
        located, off = _locate(found, sizes, probs)
        if not off:
            break
        for c, slot in off:  # the sketch missed: keep that slot, too
            c.wanted.add(slot)
    picked = _pick(df, by, kept, located)
    quantiles = picked.groupBy(*[f"{g}__g" for g in by], "feature__g").agg(
        *[F.sum(F.when(F.col("tag") == tag, F.col("weight") * F.col("value"))).alias(tag) for tag in probs]
    )
    same = F.col("feature") == F.col("feature__g")
    for g in by:
        same = same & F.col(g).eqNullSafe(F.col(f"{g}__g"))
    # Both sides hold one row for each group and column.
    return summary.join(quantiles, same, "left").select(*summary.columns, *probs)


def _locate(found, sizes, probs):
    """The slot and piece of each wanted rank with the rows before it; slots that were not kept."""
    located, off = [], []
    for c in found:
        counts = sizes[(*c.group, c.feature)]
        todo = sorted(
            (rank, tag, weight)
            for tag, q in probs.items()
            for lo in [math.floor(q * (c.n - 1))]
            for rank, weight in ((lo, 1.0 - (q * (c.n - 1) - lo)), (lo + 1, q * (c.n - 1) - lo))
            if weight > 0
        )
        base = i = 0
        for slot, piece in sorted(counts):
            here = []
            while i < len(todo) and todo[i][0] < base + counts[slot, piece]:
                here.append(todo[i])
                i += 1
            if here and slot not in c.wanted:
                off.append((c, slot))
            if here:
                located.append((*c.group, c.feature, slot, piece, base, here))
            base += counts[slot, piece]
    return located, off


def _pick(df: DataFrame, by: list[str], kept: DataFrame, located: list[tuple]) -> DataFrame:
    """(by, feature, tag, weight, value) of the ranks in their pieces."""
    want = T.StructType(
        [T.StructField("rank", T.LongType()), T.StructField("tag", T.StringType()), T.StructField("weight", T.DoubleType())]
    )
    kind = T.StructType(
        [
            *_group_type(df, by),
            T.StructField("feature__g", T.StringType()),
            T.StructField("slot__g", T.IntegerType()),
            T.StructField("piece__g", T.IntegerType()),
            T.StructField("base", T.LongType()),
            T.StructField("want", T.ArrayType(want)),
        ]
    )
    # Bounded by the number of quantiles asked for.
    targets = F.broadcast(df.sparkSession.createDataFrame(located, kind))
    same = F.lit(True)
    for c in ("feature", "slot", "piece", *by):
        same = same & F.col(c).eqNullSafe(F.col(f"{c}__g"))
    part = [*[f"{g}__g" for g in by], "feature__g", "slot__g", "piece__g"]
    inside = Window.partitionBy(*part).orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = F.col("base") + F.sum("at").over(inside)
    hits = kept.join(targets, same).withColumn("upto", upto).withColumn(
        "hit", F.filter("want", lambda w: (w["rank"] >= F.col("upto") - F.col("at")) & (w["rank"] < F.col("upto")))
    )
    return hits.select(*part, "value", F.explode("hit").alias("w")).select("*", "w.tag", "w.weight")


def exact_quantiles(df: DataFrame, cols: list[str], probs: dict[str, float]) -> DataFrame:
    """Interpolated quantiles, one row per column: (feature, <tag>...)."""
    return summarize(df, cols, probs).drop("n")
