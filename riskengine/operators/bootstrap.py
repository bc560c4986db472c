"""Paired bootstrap comparison of two scores by average precision.

A resample only matters through how often each distinct (score a, score b, label) cell is drawn.
Rows are collapsed to cells, cells get ranks, and `functions.resampling` gives every rank its weight
in every resample: exactly as many draws as there are rows, the same for any layout, partition
setting or table size.

Cells are put in score ranges once for each score. A range first returns the sums of its weights,
one number per resample; running totals over this small table give every range the sums it starts
from, and a second look at the range's cells adds up its part of each curve. The shuffles carry
cells, ranges x resamples, and the few draws that the weights leave over, never cells x resamples.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskengine.functions import resampling
from riskengine.functions.draws import hash_int
from riskengine.functions.values import is_missing, plain
from riskengine.operators.ordered import BUCKET, bucket_number, bucketed, find_edges
from riskengine.schema import LABEL
from riskengine.session import materialize

# A score is spelled by its integer part and twice 52 bits of its fraction.
KEY_SCALE = float(2**52)
KEY_DIGITS = 13
# Cells are cut at multiples of this rank, so that no piece has more rows.
PIECE_BITS = 12
# A score with more rows is a range of its own, whose pieces are summed in several tasks.
HOT_ROWS = 1 << 20
# Random numbers that a task holds at once.
CHUNK = 1 << 20
# The reported percentiles.
REPORT_PERCENTILES = (2.5, 10, 20, 30, 40, 50, 60, 70, 80, 90, 97.5)
SUMMARY_PERCENTILES = {"median": 50.0, "ci_lower": 2.5, "ci_upper": 97.5, "q25": 25.0, "q75": 75.0}

_SUMS = "which string, bucket int, rep int, pos long, n long"
_EXTRA = "rep int, a double, b double, y int, n long"


def _spelled(score: str) -> list[Column]:
    """Integers that tell scores apart; every step is exact in a double."""
    parts, left = [], F.col(score)
    for _ in range(3):
        parts.append(F.floor(left))
        left = (left - F.floor(left)) * F.lit(KEY_SCALE)
    return parts


def _cells(df: DataFrame, a: str, b: str, label: str) -> DataFrame:
    return (
        df.select(plain(a).alias("a"), plain(b).alias("b"), F.col(label).cast("int").alias("y"))
        .groupBy("a", "b", "y")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("cell", F.concat_ws(":", *_spelled("a"), *_spelled("b"), "y"))
    )


def ranked_pieces(cells: DataFrame, seed: int) -> DataFrame:
    """(a, b, y, first, rows): the rows `first` <= rank < `first` + `rows` of a cell.

    Ranks go by a hash of the cell, so every bucket of hashes has its share of the cells.
    """
    bits = 4 * KEY_DIGITS
    wide = (bucket_number(cells.sparkSession, cells.count()) - 1).bit_length()
    keyed = cells.withColumn("key", hash_int(seed, F.col("cell"), digits=KEY_DIGITS))
    keyed = keyed.withColumn(BUCKET, F.shiftright("key", bits - wide).cast("int"))
    inside = Window.partitionBy(BUCKET).orderBy("key", "a", "b", "y").rowsBetween(Window.unboundedPreceding, -1)
    # One row per bucket.
    across = Window.partitionBy(F.lit(0)).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    totals = keyed.groupBy(BUCKET).agg(F.sum("rows").alias("all"))
    totals = totals.select(BUCKET, F.coalesce(F.sum("all").over(across), F.lit(0)).alias("base"))
    placed = keyed.withColumn("before", F.coalesce(F.sum("rows").over(inside), F.lit(0))).join(totals, BUCKET)
    start = F.col("base") + F.col("before")
    cut = F.sequence(F.shiftright("start", PIECE_BITS), F.shiftright(F.col("start") + F.col("rows") - 1, PIECE_BITS))
    pieces = placed.withColumn("start", start).withColumn("block", F.explode(cut))
    first = F.greatest("start", F.shiftleft("block", PIECE_BITS))
    stop = F.least(F.col("start") + F.col("rows"), F.shiftleft(F.col("block") + 1, PIECE_BITS))
    return pieces.select("a", "b", "y", "block", first.alias("first"), (stop - first).alias("rows"))


class _Draw:
    """The weights of one attempt at some resamples of `n_rows` rows."""

    def __init__(self, seed: int, attempt: int, reps: list[int], n_rows: int):
        self.reps, self.n_rows = np.array(reps), n_rows
        self.piece_bits, self.chunk = PIECE_BITS, CHUNK
        self.start = resampling.stream(seed, 0, attempt)
        self.extra_start = resampling.stream(seed, 1, attempt)
        self.cdf = np.array(resampling.poisson_cdf(resampling.mean_of(n_rows)))

    def by_group(self, first: np.ndarray, rows: np.ndarray, group: np.ndarray, n_groups: int) -> Iterator[tuple[slice, np.ndarray]]:
        """For slices of the resamples, the weights (resamples, groups) of pieces; no group is empty."""
        ranks = np.repeat(first - np.concatenate([[0], rows.cumsum()[:-1]]), rows) + np.arange(rows.sum())
        starts = np.concatenate([[0], rows.cumsum()[:-1]])
        order = np.argsort(group, kind="stable")
        heads = np.searchsorted(group[order], np.arange(n_groups))
        step = max(1, self.chunk // max(1, len(ranks)))
        for k in range(0, len(self.reps), step):
            drawn = resampling.counts(self.start, self.cdf, self.reps[k : k + step], ranks)
            by_piece = np.add.reduceat(drawn, starts, axis=1)
            yield slice(k, k + step), np.add.reduceat(by_piece[:, order], heads, axis=1)

    def missing(self, need: Iterable[tuple[int, int]]) -> Iterator[pd.DataFrame]:
        """(rep, rank) of the draws that the weights leave over, in frames of bounded size."""
        for rep, extra in need:
            for at in range(0, extra, self.chunk):
                k = np.arange(at, min(at + self.chunk, extra))
                u = resampling.uniforms(self.extra_start, np.array([rep]), k)[0]
                rank = np.floor(u * self.n_rows).astype(np.int64)
                yield pd.DataFrame({"block": rank >> self.piece_bits, "rep": np.int32(rep), "rank": rank})


def _slices(frame: pd.DataFrame, most: int) -> Iterator[pd.DataFrame]:
    """The frame in runs of about `most` rows of the table, cut between scores."""
    run = frame["rows"].cumsum().to_numpy() // most
    cut = np.flatnonzero((np.diff(run) != 0))
    score = frame["score"].to_numpy()
    at = 0
    for c in cut:
        stop = int(np.searchsorted(-score, -score[c], side="right"))
        if stop > at:
            yield frame.iloc[at:stop]
            at = stop
    if at < len(frame):
        yield frame.iloc[at:]


def _range_sums(draw: _Draw):
    def sums(pieces: pd.DataFrame) -> pd.DataFrame:
        pos, n = np.zeros(len(draw.reps), np.int64), np.zeros(len(draw.reps), np.int64)
        most = max(1, draw.chunk >> draw.piece_bits)
        for at in range(0, len(pieces), most):
            part = pieces.iloc[at : at + most]
            labels, group = np.unique((part["y"] == 1).to_numpy(), return_inverse=True)
            for reps, w in draw.by_group(part["first"].to_numpy(), part["rows"].to_numpy(), group, len(labels)):
                pos[reps] += w[:, labels].sum(1)
                n[reps] += w.sum(1)
        top = pieces.iloc[0]
        return pd.DataFrame({"which": top["which"], "bucket": top[BUCKET], "rep": draw.reps, "pos": pos, "n": n})

    return sums


def _find_extra(pieces: pd.DataFrame, draws: pd.DataFrame) -> pd.DataFrame:
    """The cells of drawn ranks of one block, with the number of draws."""
    if not len(pieces) or not len(draws):
        return pd.DataFrame({c.split()[0]: [] for c in _EXTRA.split(", ")})
    pieces = pieces.sort_values("first")
    at = np.searchsorted(pieces["first"].to_numpy(), draws["rank"].to_numpy(), side="right") - 1
    pairs, n = np.unique(draws["rep"].to_numpy(np.int64) * len(pieces) + at, return_counts=True)
    rep, at = np.divmod(pairs, len(pieces))
    hit = pieces.iloc[at]
    return pd.DataFrame({"rep": rep, "a": hit["a"].array, "b": hit["b"].array, "y": hit["y"].array, "n": n})


def _range_areas(draw: _Draw):
    def areas(rows: pd.DataFrame, before: pd.DataFrame) -> pd.DataFrame:
        """Parts of the areas of one range; `before` has the sums above it."""
        top = rows.iloc[0]
        before = before.set_index("rep").reindex(draw.reps).fillna(0)
        tp, n = (before[c].to_numpy(np.float64) for c in ("pos_before", "n_before"))
        area = np.zeros(len(draw.reps))
        place = pd.Series(np.arange(len(draw.reps)), index=draw.reps)
        rows = rows.sort_values("score", ascending=False, kind="stable")
        for part in _slices(rows, draw.chunk):
            scores, group = np.unique(-part["score"].to_numpy(), return_inverse=True)
            label, m = (part["y"] == 1).to_numpy(), len(scores)
            pos, every = np.zeros((len(draw.reps), m)), np.zeros((len(draw.reps), m))
            extra = part["rep"].notna().to_numpy()
            for out, held in ((every, ~extra), (pos, ~extra & label)):
                if held.any():
                    present, inner = np.unique(group[held], return_inverse=True)
                    chosen = part[held]
                    for reps, w in draw.by_group(chosen["first"].to_numpy(), chosen["rows"].to_numpy(), inner, len(present)):
                        out[reps, present] = w
            for out, held in ((every, extra), (pos, extra & label)):
                chosen = part[held]
                np.add.at(out, (place[chosen["rep"].astype(int)].to_numpy(), group[held]), chosen["rows"].to_numpy())
            upto, all_rows = tp[:, None] + pos.cumsum(1), n[:, None] + every.cumsum(1)
            area += np.where(pos > 0, pos * upto / np.maximum(all_rows, 1), 0).sum(1)
            tp, n = upto[:, -1], all_rows[:, -1]
        return pd.DataFrame({"which": top["which"], "rep": draw.reps, "area": area})

    return areas


def _by_score(table: DataFrame, *keep: str) -> DataFrame:
    pair = F.array(
        F.struct(F.lit("a").alias("which"), F.col("a").alias("score")),
        F.struct(F.lit("b").alias("which"), F.col("b").alias("score")),
    )
    return table.select(*keep, F.inline(pair))


class _Ranges:
    """Score ranges: by the cells' scores, every hot score alone in its range, -1 for missing scores."""

    def __init__(self, pieces: DataFrame):
        long = _by_score(pieces, "rows").where(~is_missing("score"))
        held = long.groupBy("which", "score").agg(F.sum("rows").alias("n"))
        # At most two hot scores for every HOT_ROWS rows.
        hot = held.where(F.col("n") > HOT_ROWS).select("which", "score").collect()
        alone = [v for r in hot for v in (r["score"], float(np.nextafter(r["score"], np.inf)))]
        self.edges = sorted({*find_edges(long, ["score"])["score"], *alone})
        spark = pieces.sparkSession
        named = spark.createDataFrame([(r["which"], r["score"]) for r in hot], "which string, score double")
        self.hot = self._placed(named).select("which", BUCKET, F.lit(True).alias("is_hot"))

    def _placed(self, long: DataFrame) -> DataFrame:
        placed = bucketed(long, {"score": self.edges})
        number = F.when(is_missing("score"), -1).otherwise(F.col("score__b").cast("int"))
        return placed.withColumn(BUCKET, number).drop("score__b")

    def of(self, table: DataFrame, *keep: str) -> DataFrame:
        """(which, score, bucket, hot, keep...), two rows for each of (a, b, keep...)."""
        placed = self._placed(_by_score(table, *keep)).join(self.hot, ["which", BUCKET], "left")
        return placed.withColumn("hot", F.col("is_hot").isNotNull()).drop("is_hot")


def _areas(pieces: DataFrame, ranged: DataFrame, ranges: _Ranges, draw: _Draw) -> tuple[DataFrame, list[int]]:
    """(rep, which, area, n_pos) of the resamples that stand, and those that must be drawn again."""
    # The pieces of a hot score, or without one, are dealt over several tasks; others stay together.
    tasks = bucket_number(pieces.sparkSession, draw.n_rows)
    spread = F.col("hot") | (F.col(BUCKET) < 0)
    lane = F.when(spread, F.pmod("block", F.lit(tasks))).otherwise(F.lit(0).cast("long"))
    sums = ranged.withColumn("lane", lane).groupBy("which", BUCKET, "lane").applyInPandas(_range_sums(draw), _SUMS)
    sums = materialize(sums, "range-sums")
    need = sums.where("which = 'a'").groupBy("rep").agg((F.lit(draw.n_rows) - F.sum("n")).alias("need"))

    def missing(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield from draw.missing(zip(frame["rep"].tolist(), frame["need"].tolist()))

    ranks = need.where("need > 0").mapInPandas(missing, "block long, rep int, rank long")
    found = pieces.groupBy("block").cogroup(ranks.groupBy("block")).applyInPandas(_find_extra, _EXTRA)
    extra = materialize(ranges.of(found, "rep", "y", "n"), "extra-draws")

    of_extra = extra.groupBy("which", BUCKET, "rep").agg(
        F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("pos"), F.sum("n").alias("n")
    )
    every = sums.unionByName(of_extra).groupBy("which", BUCKET, "rep").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    every = materialize(every, "range-totals")
    # One row per resample.
    drawn = every.where("which = 'a'").groupBy("rep").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos")).collect()
    again = [r["rep"] for r in drawn if r["n"] != draw.n_rows or not r["pos"]]

    above = Window.partitionBy("which", "rep").orderBy(F.desc(BUCKET)).rowsBetween(Window.unboundedPreceding, -1)
    whole = every.where(F.col(BUCKET) >= 0)
    before = whole.select(
        "*", *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_before") for c in ("pos", "n")]
    ).join(ranges.hot, ["which", BUCKET], "left")
    upto, rows = F.col("pos_before") + F.col("pos"), F.col("n_before") + F.col("n")
    of_hot = before.where("is_hot").select(
        "which", "rep", F.when(F.col("pos") > 0, F.col("pos") * upto.cast("double") / rows).otherwise(0.0).alias("area")
    )
    ordinary = ~F.col("hot") & (F.col(BUCKET) >= 0)
    members = ranged.where(ordinary).select("which", BUCKET, "score", "y", "first", "rows", F.lit(None).cast("int").alias("rep"))
    late = extra.where(ordinary).select(
        "which", BUCKET, "score", "y", F.lit(0).cast("long").alias("first"), F.col("n").alias("rows"), "rep"
    )
    start = before.where("is_hot IS NULL").select(
        F.col("which").alias("side"), F.col(BUCKET).alias("range"), "rep", "pos_before", "n_before"
    )
    parts = (
        members.unionByName(late)
        .groupBy("which", BUCKET)
        .cogroup(start.groupBy("side", "range"))
        .applyInPandas(_range_areas(draw), "which string, rep int, area double")
    )
    totals = whole.groupBy("which", "rep").agg(F.sum("pos").alias("n_pos"))
    areas = parts.unionByName(of_hot).groupBy("which", "rep").agg(F.sum("area").alias("area")).join(totals, ["which", "rep"])
    return areas.where(~F.col("rep").isin(again)) if again else areas, again


def bootstrap_samples(
    df: DataFrame,
    a: str = "p",
    b: str = "p_b",
    label: str = LABEL,
    n_bootstraps: int = 1000,
    seed: int = 42,
) -> DataFrame:
    """(iteration, auc_pr_a, auc_pr_b, diff) for each paired resample of all rows.

    A resample without a positive is drawn again, as is one whose weights alone pass the number of
    rows; the driver learns at most `n_bootstraps` numbers.
    """
    cells = materialize(_cells(df, a, b, label), "cells")
    if cells.where("y = 1").isEmpty():
        raise ValueError("no positive row to resample")
    n_rows = cells.agg(F.sum("rows").alias("n")).first()["n"]
    pieces = materialize(ranked_pieces(cells, seed), "pieces")
    ranges = _Ranges(pieces)
    ranged = materialize(ranges.of(pieces, "y", "block", "first", "rows"), "score-ranges")
    todo, attempt, areas = list(range(n_bootstraps)), 0, None
    while todo:
        part, again = _areas(pieces, ranged, ranges, _Draw(seed, attempt, todo, n_rows))
        areas = part if areas is None else areas.unionByName(part)
        todo, attempt = again, attempt + 1
    precision = F.when(F.col("n_pos") > 0, F.col("area") / F.col("n_pos")).otherwise(0.0)
    side = {w: F.coalesce(F.max(F.when(F.col("which") == w, precision)), F.lit(0.0)) for w in "ab"}
    return (
        areas.groupBy("rep")
        .agg(*[c.alias(f"auc_pr_{w}") for w, c in side.items()])
        .select(
            (F.col("rep") + 1).cast("long").alias("iteration"),
            "auc_pr_a",
            "auc_pr_b",
            (F.col("auc_pr_a") - F.col("auc_pr_b")).alias("diff"),
        )
    )


def _pct(col: Column | str, q: float) -> Column:
    return F.percentile(col, F.lit(q / 100.0))


def bootstrap_summary(samples: DataFrame) -> DataFrame:
    """One row: mean, population std and percentiles of both scores and their difference."""
    aggs = [F.count(F.lit(1)).alias("n_bootstraps")]
    for name, col in (("a", "auc_pr_a"), ("b", "auc_pr_b"), ("diff", "diff")):
        aggs.append(F.avg(col).alias(f"{name}_mean"))
        aggs.append(F.stddev_pop(col).alias(f"{name}_std"))
        # One value per resample, so the exact percentile keeps a short list.
        aggs += [_pct(col, q).alias(f"{name}_{k}") for k, q in SUMMARY_PERCENTILES.items()]
    for name, cond in (
        ("prob_a_superior", F.col("diff") > 0),
        ("prob_b_superior", F.col("diff") < 0),
        ("prob_tie", F.col("diff") == 0),
    ):
        aggs.append(F.avg(cond.cast("double")).alias(name))
    low, high = F.col("diff_ci_lower"), F.col("diff_ci_upper")
    significant = ((low > 0) & (high > 0)) | ((low < 0) & (high < 0))
    return samples.agg(*aggs).withColumn("significant", significant)


def bootstrap_percentiles(samples: DataFrame) -> DataFrame:
    """(percentile, a, b, diff) at the reported percentiles."""
    probs = F.array(*[F.lit(q / 100.0) for q in REPORT_PERCENTILES])
    one = samples.agg(
        *[F.percentile(c, probs).alias(c) for c in ("auc_pr_a", "auc_pr_b", "diff")]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(float(q)).alias("percentile"),
                *[F.col(c)[i].alias(c) for c in ("auc_pr_a", "auc_pr_b", "diff")],
            )
            for i, q in enumerate(REPORT_PERCENTILES)
        ]
    )
    return one.select(F.inline(rows))


def model_choice(summary: DataFrame, name_a: str = "baseline", name_b: str = "ensemble") -> DataFrame:
    """Pick the significantly better model, and the simpler first one when neither is."""
    low = F.col("diff_ci_lower")
    better_a = F.col("significant") & (low > 0)
    better_b = F.col("significant") & (low < 0)
    return summary.select(
        F.when(better_b, F.lit(name_b)).otherwise(F.lit(name_a)).alias("chosen"),
        F.when(better_a, F.lit("a_superior"))
        .when(better_b, F.lit("b_superior"))
        .otherwise(F.lit("indistinguishable"))
        .alias("reason"),
        "significant",
    )
