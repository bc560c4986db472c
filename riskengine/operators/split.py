"""Chronological splits, replay slices, exact-size samples and top-k."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskengine.functions.draws import hash_int
from riskengine.functions.values import count_where, ratio
from riskengine.operators.ranks import SELECT_ROWS, before_rank, before_ranks, before_small_rank
from riskengine.schema import LABEL, ROW_ID

CHRONOLOGICAL = ("Time", ROW_ID)
# Fixed value: fewer positives than this in the hold-out raise the low-count flag.
MIN_TEST_POSITIVES = 80
# 13 hex digits: the longest prefix a double holds exactly.
SAMPLE_HASH_DIGITS = 13


def in_train(df: DataFrame, fraction: float = 0.8) -> Column:
    """Predicate for the first int(n * fraction) rows in time order."""
    return before_rank(df.select(*CHRONOLOGICAL), lambda n: int(n * fraction), CHRONOLOGICAL)


def time_split(df: DataFrame, fraction: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Train on the past, test on the future: (first int(n * fraction) rows, the rest)."""
    train = in_train(df, fraction)
    return df.where(train), df.where(~train)


def label_split(df: DataFrame, fraction: float = 0.8) -> DataFrame:
    """Both sides in one table, told apart by `split`."""
    return df.withColumn("split", F.when(in_train(df, fraction), "train").otherwise("test"))


def first_rows(df: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """The first n rows in time order, and the remainder."""
    head = before_rank(df.select(*CHRONOLOGICAL), n, CHRONOLOGICAL)
    return df.where(head), df.where(~head)


def replay_slice(df: DataFrame, start_row: int = 0, limit: int | None = None) -> DataFrame:
    """Rows start_row < rank <= start_row + limit in time order."""
    ranks = [max(0, start_row), *([] if limit is None else [start_row + limit])]
    start, *stop = before_ranks(df.select(*CHRONOLOGICAL), ranks, CHRONOLOGICAL)
    return df.where(~start).where(stop[0]) if stop else df.where(~start)


def split_stats(df: DataFrame) -> DataFrame:
    """Size, class balance and time range of each side of a label_split table."""
    fraud, legit = count_where(F.col(LABEL) == 1), count_where(F.col(LABEL) == 0)
    stats = df.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        legit.alias("n_legit"),
        fraud.alias("n_fraud"),
        F.min("Time").alias("time_min"),
        F.max("Time").alias("time_max"),
    )
    return stats.select(
        "*",
        (ratio(F.col("n_fraud"), F.col("n_rows")) * 100).alias("fraud_pct"),
        ratio(F.col("n_legit"), F.col("n_fraud")).alias("legit_per_fraud"),
        ((F.col("split") == "test") & (F.col("n_fraud") < MIN_TEST_POSITIVES)).alias(
            "low_fraud_warning"
        ),
    )


def sample_n(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """Exactly min(n, rows) rows without replacement, chosen by a hash of (seed, txn_id).

    Only rows whose draw is under a bound are looked at. The bound lets through n + 8 sqrt(n) + 32
    rows on average; fewer than n come with a chance of less than e^-30 (Chernoff), and then the
    bound is raised.
    """
    total = df.count()
    if n <= 0 or n >= total:
        return df.where(F.lit(n > 0))
    order = ("draw__", ROW_ID)
    drawn = df.withColumn("draw__", hash_int(seed, F.col(ROW_ID), digits=SAMPLE_HASH_DIGITS))
    wanted = n + 8 * math.isqrt(n) + 40
    keep = None
    while keep is None:
        bound = min(1.0, wanted / total) * 16.0**SAMPLE_HASH_DIGITS
        near = drawn.where(F.col("draw__") < F.lit(math.ceil(bound)))
        if n <= SELECT_ROWS:
            keep = before_small_rank(near, n, order)
        else:
            keep = before_rank(near, n, order) if near.count() > n else None
        wanted *= 2
    return near.where(keep).drop("draw__")


def top_effects(effects: DataFrame, k: int = 10, weakest: bool = False) -> DataFrame:
    """The k features with the largest (or smallest) absolute effect size; undefined ones last."""
    size = F.abs("effect_size")
    size = F.when(F.isnan(size), F.lit(None)).otherwise(size)
    # The weakest are the tail of the descending order, where undefined effects sit.
    order = size.asc_nulls_first() if weakest else size.desc_nulls_last()
    return effects.orderBy(order, "feature").limit(k)
