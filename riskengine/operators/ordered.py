"""Ordered work (buckets, running totals) without a single-task window.

A window with only an ORDER BY puts every row in one task. Here rows are first put in buckets
by value; a bucket is a pure function of the value, so recomputed tasks agree and equal values
stay together. Work inside buckets runs in parallel and one small table of bucket totals links
them. Bucket edges shape the load, never the result.

One value may be held by a third of all rows. Equal values are therefore collapsed on the map side
before any shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BUCKET = "bucket"
MIN_BUCKETS, MAX_BUCKETS = 16, 16_384
BUCKET_ROWS = 10_000_000
# Rows looked at to place the edges, and sketch points per bucket: an edge is off by a small part
# of a bucket.
EDGE_ROWS = 1_000_000
EDGE_ROWS_PER_BUCKET = 1_000
SKETCH_POINTS = 20


def bucket_number(spark: SparkSession, n_rows: int) -> int:
    """A few buckets per shuffle partition, more when buckets would grow past BUCKET_ROWS."""
    wanted = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), n_rows // BUCKET_ROWS)
    return max(MIN_BUCKETS, min(MAX_BUCKETS, wanted))


def find_edges(df: DataFrame, cols: list[str], n_buckets: int | None = None) -> dict[str, list[float]]:
    """Bucket edges per column, from n_buckets - 1 approximate quantiles.

    On a long table they come from a random part of its rows. That is only a guess at an even
    load: every row is put in a bucket afterwards, and results are the same for any edges.
    """
    n_rows = df.count()
    n_buckets = n_buckets or bucket_number(df.sparkSession, n_rows)
    enough = max(EDGE_ROWS, EDGE_ROWS_PER_BUCKET * n_buckets)
    looked_at = df.sample(enough / n_rows, seed=17) if n_rows > enough else df
    probs = ", ".join(repr(i / n_buckets) for i in range(1, n_buckets))
    points = max(1000, SKETCH_POINTS * n_buckets)
    sketch = F.expr(f"percentile_approx(value, array({probs}), {points})").alias("q")
    found = {
        r["feature"]: sorted({v for v in r["q"] if math.isfinite(v)})
        for r in melt(looked_at, cols).groupBy("feature").agg(sketch).collect()
    }
    # Infinite values need no edge; a column without values gets two buckets.
    return {c: [-math.inf, *(found.get(c) or [0.0]), math.inf] for c in cols}


def bucketed(df: DataFrame, edges: dict[str, list[float]], suffix: str = "__b") -> DataFrame:
    """Add a bucket column `<col><suffix>` per column (binary search on the JVM)."""
    cols = list(edges)
    return Bucketizer(
        splitsArray=[edges[c] for c in cols],
        inputCols=cols,
        outputCols=[c + suffix for c in cols],
        handleInvalid="keep",
    ).transform(df)


def melt(
    df: DataFrame,
    cols: list[str],
    keep: Iterable[str] = (),
    edges: dict[str, list[float]] | None = None,
    by_number: bool = False,
) -> DataFrame:
    """Long form (keep..., feature, value[, bucket]) of the given columns, missing values dropped.

    `by_number` puts the position of the column in `feature` instead of its name: less to shuffle.
    """
    keep = list(keep)
    name = {c: str(i) if by_number else f"'{c}'" for i, c in enumerate(cols)}
    # -0.0 is folded into 0.0, so that equal values share a bucket.
    folded = [f"CASE WHEN `{c}` = 0 THEN 0D ELSE CAST(`{c}` AS DOUBLE) END AS `{c}`" for c in cols]
    wide = df.selectExpr(*[f"`{k}`" for k in keep], *folded)
    if edges:
        wide = bucketed(wide, {c: edges[c] for c in cols})
        items = ", ".join(f"{name[c]}, `{c}`, CAST(`{c}__b` AS INT)" for c in cols)
        names = f"(feature, value, {BUCKET})"
    else:
        items = ", ".join(f"{name[c]}, `{c}`" for c in cols)
        names = "(feature, value)"
    long = wide.select(*keep, F.expr(f"stack({len(cols)}, {items}) as {names}"))
    return long.where("value IS NOT NULL AND NOT isnan(value)")


def running_totals(
    groups: DataFrame,
    keys: list[str],
    value: str,
    sums: list[str],
    descending: bool = False,
    next_value: bool = False,
) -> DataFrame:
    """Running sums by value, per key.

    `groups` holds rows of (keys, bucket, value, sums). Adds `<s>_cum` (all rows of the key up to
    and including this value), `<s>_all` (whole key) and, on request, `next_value` (the value of
    the next row of the key).
    """
    part = [*keys, BUCKET]
    # Stated here, so that both uses below keep the same plan and share one shuffle.
    for c in part:
        groups = groups.where(F.col(c).isNotNull())
    per_key = keys or [F.lit(0)]
    order = F.desc if descending else F.asc
    inside = Window.partitionBy(*part).orderBy(order(value))
    upto = inside.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    across = Window.partitionBy(*per_key).orderBy(order(BUCKET))
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*per_key)

    # One row per (key, bucket): the only table that is ordered without buckets.
    edge = F.max(value) if descending else F.min(value)
    totals = groups.groupBy(*part).agg(
        *[F.sum(s).alias(f"{s}__t") for s in sums], edge.alias("edge__t")
    )
    totals = totals.select(
        *part,
        *[F.coalesce(F.sum(f"{s}__t").over(earlier), F.lit(0)).alias(f"{s}__base") for s in sums],
        *[F.sum(f"{s}__t").over(whole).alias(f"{s}_all") for s in sums],
        *([F.lead("edge__t").over(across).alias("edge__next")] if next_value else []),
    )
    local = groups.select(
        "*",
        *[F.sum(s).over(upto).alias(f"{s}__in") for s in sums],
        *([F.lead(value).over(inside).alias("lead__in")] if next_value else []),
    )
    out = local.join(totals, part)
    return out.select(
        *groups.columns,
        *[(F.col(f"{s}__in") + F.col(f"{s}__base")).alias(f"{s}_cum") for s in sums],
        *[f"{s}_all" for s in sums],
        *([F.coalesce("lead__in", "edge__next").alias("next_value")] if next_value else []),
    )


def hot_key_buckets(
    df: DataFrame, keys: list[str], order: str, hot_rows: int, n_buckets: int | None = None
) -> tuple[DataFrame, bool]:
    """Add `bucket`: value buckets for keys with more than `hot_rows` rows, 0 for all others.

    Ordered work per (key, bucket) then costs ordinary keys nothing and splits the hot ones. The
    flag tells whether any key was split.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("key_rows"))
    hot = counts.where(F.col("key_rows") > hot_rows).select(*keys, F.lit(True).alias("is_hot"))
    if hot.isEmpty():
        return df.withColumn(BUCKET, F.lit(0)), False
    # Edges divide the rows of the hot keys; the others are not split and would shift them.
    edges = find_edges(df.join(hot, keys, "left_semi"), [order], n_buckets)
    # No forced broadcast: there can be as many hot keys as rows / hot_rows.
    split = (
        bucketed(df.join(hot, keys, "left"), edges)
        .withColumn(BUCKET, F.when(F.col("is_hot"), F.col(f"{order}__b").cast("int")).otherwise(F.lit(0)))
        .drop("is_hot", f"{order}__b")
    )
    return split, True


def running_max(
    df: DataFrame, keys: list[str], order: str, what: Column, out: str, split: bool
) -> DataFrame:
    """Maximum of `what` over the earlier rows of the key, in a table with `bucket`."""
    return _carry(df, keys, order, what, out, -1, F.max, F.greatest, split)


def running_count(df: DataFrame, keys: list[str], order: str, out: str, split: bool) -> DataFrame:
    """1-based row number of the key by `order` (unique per key), in a table with `bucket`."""
    return _carry(
        df,
        keys,
        order,
        F.lit(1),
        out,
        Window.currentRow,
        F.sum,
        lambda carry, local: F.coalesce(carry, F.lit(0)) + local,
        split,
    )


def _carry(df, keys, order, what, out, end, agg, merge, split) -> DataFrame:
    """Aggregate inside each bucket, then merge in what the earlier buckets of the key add up to."""
    part = [*keys, BUCKET]
    inside = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, end)
    local = df.withColumn(out, agg(what).over(inside))
    if not split:
        return local
    earlier = (
        Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = (
        df.groupBy(*part)
        .agg(agg(what).alias("total__c"))
        .select(*part, agg("total__c").over(earlier).alias("carry__c"))
    )
    return (
        local.join(carry, part)
        .withColumn(out, merge(F.col("carry__c"), F.col(out)))
        .drop("carry__c")
    )
