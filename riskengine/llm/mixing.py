"""Operator 8: interleave sources at target weights with a Pfair schedule.

Every source has an integer number of parts of a period of Q slots. Its k-th block of the period
is released at floor(k * Q / parts) and due at ceil((k + 1) * Q / parts); in each slot the released
block with the earliest deadline is taken. At total weight one this keeps every source within less
than one block of its weight after every slot. The schedule repeats after Q slots, so it is worked
out once for one period (a native fold over Q slots, whatever the size of the corpus), and each
document finds its slot from its number within its source.

Numbering is distributed: documents are put in 4,096 hash buckets per source, numbered inside
buckets, and moved on by the counts of the earlier buckets, so that a hot source is no hot task.

Defined results: a null source is a source of its own; null or repeated ids take places like any
other (repeated ids in an order fixed by all their columns); texts are never read by the schedule;
an empty table gives an empty schedule; other columns are carried unless they clash with the
result's own names, which replace them. No document is dropped. A source's last block may be partial
and counts like any other; once a source has none left, its slots stay empty, so that the others go
on in the proportion of their weights, each within one block of its weight at every slot. `phase` is
the number of sources used up by a document's slot. `in_mix` marks phase 0, in which all target
weights hold; a reader who can do without the sources that ended reads on to a later phase.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskengine.llm.common import carrying
from riskengine.session import materialize

BLOCK_DOCS = 8
PERIOD = 1000
SLOTS_PER_SOURCE = 20
RESULT = ("block", "in_block", "slot", "release", "deadline", "phase", "in_mix")


def temperature_parts(counts: DataFrame, period: int = PERIOD) -> DataFrame:
    """Integer parts of the period per source, in proportion to the root of its document count.

    `counts` has `source` and `n`, one row per source (a catalogue, not corpus rows). Parts are
    rounded by largest remainder, each source has one at least, and the period is widened to 20
    slots per source where there are very many. Ties go by source name, null first.
    """
    everything = Window.partitionBy(F.lit(1))
    by_remainder = everything.orderBy(
        F.col("rest").desc(), F.col("source").asc_nulls_first()
    )
    raw = (
        counts.withColumn(
            "period",
            F.greatest(F.lit(period), F.lit(SLOTS_PER_SOURCE) * F.count("*").over(everything)).cast("long"),
        )
        .withColumn("root", F.sqrt(F.col("n").cast("double")))
        .withColumn("raw", F.round(F.col("period") * F.col("root") / F.sum("root").over(everything), 6))
    )
    # One part is given to each source first, the others are shared by the raw quota beyond it.
    share = (
        raw.withColumn("over", F.greatest(F.col("raw") - 1, F.lit(0.0)))
        .withColumn("free", (F.col("period") - F.count("*").over(everything)).cast("double"))
        .withColumn("quota", F.round(F.col("free") * F.col("over") / F.sum("over").over(everything), 6))
        .withColumn("quota", F.coalesce("quota", F.lit(0.0)))
        .withColumn("whole", F.floor("quota"))
        .withColumn("rest", F.col("quota") - F.col("whole"))
        .withColumn("left", F.col("free").cast("long") - F.sum("whole").over(everything))
        .withColumn("place", F.row_number().over(by_remainder))
    )
    return share.select(
        "source",
        "period",
        (1 + F.col("whole") + (F.col("place") <= F.col("left")).cast("long")).alias("parts"),
    )


def _released(done: Column, parts: Column, period: Column) -> Column:
    return F.floor(done * period / parts)


def _due(done: Column, parts: Column, period: Column) -> Column:
    return F.ceil((done + 1) * period / parts)


def period_schedule(parts: DataFrame) -> DataFrame:
    """One period of the earliest-deadline-first schedule: source, parts, period, k, place.

    `parts` has `source`, `parts` and `period`, where the parts add up to the period.
    """
    ordered = parts.agg(
        F.array_sort(F.collect_list(F.struct(F.col("source").isNotNull().alias("named"), "source", "parts"))).alias("src"),
        F.max("period").alias("period"),
    ).where("period is not null")
    w, period = F.col("src.parts"), F.col("period")

    def step(state: Column, slot: Column) -> Column:
        ready = F.transform(
            state["done"],
            lambda d, i: F.when(
                (d < F.get(w, i)) & (_released(d, F.get(w, i), period) <= slot),
                F.struct(_due(d, F.get(w, i), period).alias("due"), i.alias("i")),
            ),
        )
        first = F.array_min(F.filter(ready, lambda x: x.isNotNull()))["i"]
        return F.get(
            F.transform(
                F.array(first),
                lambda b: F.struct(
                    F.transform(state["done"], lambda d, i: d + F.when(i == b, F.lit(1)).otherwise(F.lit(0)).cast("long")).alias("done"),
                    F.concat(state["taken"], F.array(b)).alias("taken"),
                ),
            ),
            0,
        )

    start = F.struct(
        F.transform(w, lambda _: F.lit(0).cast("long")).alias("done"),
        F.array().cast("array<int>").alias("taken"),
    )
    taken = F.aggregate(F.sequence(F.lit(0).cast("long"), period - 1), start, step, lambda s: s["taken"])
    slots = ordered.select("src", "period", taken.alias("taken")).select(
        "src", "period", F.posexplode("taken").alias("place", "i")
    )
    return slots.select(
        F.get("src", F.col("i"))["source"].alias("source"),
        F.get("src", F.col("i"))["parts"].alias("parts"),
        "period",
        (F.row_number().over(Window.partitionBy("i").orderBy("place")) - 1).cast("long").alias("k"),
        F.col("place").cast("long").alias("place"),
    )


def numbered(docs: DataFrame, doc_id: str, source: str) -> DataFrame:
    """`docs` with `_mix_n`: 0, 1, ... within each source, in an order scattered by hash."""
    carried = docs.columns
    key = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    keyed = docs.withColumn("_mix_key", key).withColumn("_mix_bucket", F.substring("_mix_key", 1, 3))
    counts = keyed.groupBy(F.col(source).alias("_s"), F.col("_mix_bucket").alias("_b")).count()
    before = Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_s", "_b", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_mix_before"))
    inside = Window.partitionBy(source, "_mix_bucket").orderBy(
        "_mix_key", doc_id, F.xxhash64(*(F.col(f"`{c}`") for c in carried))
    )
    ranked = keyed.withColumn("_mix_in", F.row_number().over(inside) - 1)
    return ranked.join(
        offsets, F.col(source).eqNullSafe(F.col("_s")) & (F.col("_mix_bucket") == F.col("_b"))
    ).select(*(F.col(f"`{c}`") for c in carried), (F.col("_mix_before") + F.col("_mix_in")).cast("long").alias("_mix_n"))


def pfair_mix(
    docs: DataFrame,
    parts: DataFrame | None = None,
    doc_id: str = "doc_id",
    source: str = "source",
    block_docs: int = BLOCK_DOCS,
) -> DataFrame:
    """`docs` with block, in_block, slot, release, deadline, phase and in_mix; order by slot, in_block.

    `parts` (source, parts, period) are target weights as integer parts of a period; by default
    they follow the root of the source's size.
    """
    return carrying(docs.drop(*RESULT), (doc_id, source), lambda named: _mixed(named, parts, doc_id, source, block_docs))


def _mixed(docs: DataFrame, parts: DataFrame | None, doc_id: str, source: str, block_docs: int) -> DataFrame:
    counts = docs.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("n"))
    counts = materialize(counts, "mix-counts")
    plan = materialize(period_schedule(temperature_parts(counts) if parts is None else parts), "mix-plan")
    plan = plan.withColumnsRenamed({"source": "_p_source", "k": "_p_k"})

    # A source ends at the slot that would need the block after its last one.
    ends = counts.withColumn("_blocks", F.ceil(F.col("n") / block_docs)).join(
        plan,
        F.col("source").eqNullSafe(F.col("_p_source")) & (F.col("_p_k") == F.col("_blocks") % F.col("parts")),
    )
    end = F.floor(F.col("_blocks") / F.col("parts")) * F.col("period") + F.col("place")
    everything = Window.partitionBy(F.lit(1))
    per_source = ends.select(F.col("source").alias("_s"), F.col("parts").alias("_parts"), end.alias("_end"))
    per_source = per_source.withColumn("_ends", F.collect_list("_end").over(everything)).drop("_end")
    per_source = materialize(per_source, "mix-ends")

    blocks = (
        numbered(docs, doc_id, source)
        .withColumn("block", F.floor(F.col("_mix_n") / block_docs))
        .withColumn("in_block", (F.col("_mix_n") % block_docs).cast("int"))
    )
    # k depends on the source's parts, so these come first; both tables have a row per part at most.
    with_k = blocks.join(per_source, F.col(source).eqNullSafe(F.col("_s"))).withColumn(
        "_k", F.col("block") % F.col("_parts")
    )
    cycle = F.floor(F.col("block") / F.col("parts")) * F.col("period")
    placed = with_k.join(plan, F.col(source).eqNullSafe(F.col("_p_source")) & (F.col("_k") == F.col("_p_k")))
    result = placed.select(
        *(F.col(f"`{c}`") for c in docs.columns),
        "block",
        "in_block",
        (cycle + F.col("place")).alias("slot"),
        (cycle + _released(F.col("_k"), F.col("parts"), F.col("period"))).alias("release"),
        (cycle + _due(F.col("_k"), F.col("parts"), F.col("period"))).alias("deadline"),
        "_ends",
    )
    over = F.size(F.filter("_ends", lambda e: e <= F.col("slot"))).cast("long")
    return result.withColumn("phase", over).drop("_ends").withColumn("in_mix", F.col("phase") == 0)
