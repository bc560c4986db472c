"""Operator 5: near duplicates by HyperMinHash bands, estimates and exact verification.

1. Each text gives its number of distinct shingles, a digest of its shingle set and a HyperMinHash
   sketch. Texts with equal sets are one class, represented by its smallest doc_id.
2. The sketch's 48 bands of 6 registers are bucket keys. In each bucket every class is paired with
   the bucket's smallest id only, so a large group gives as many pairs as it has members.
3. Pairs pass the collision-corrected estimate with a margin of over five standard deviations and
   are then verified on full shingle sets. Verified links are joined into components.
4. Links that do not go through a bucket's smallest id are found next: classes that are not yet in
   the component of their bucket's smallest id are paired with the bucket's other components, and
   verified as before. Within that join a 256-bit part of the sketch is compared, and parities of
   hash cells, which bound the elements in which two sets differ from below and lose no pair.

A pair at similarity 0.8 shares no band with a chance of 5e-7 (less above), which is the only way
to miss a link. Only ids, band keys and sketches are shuffled for all texts; full shingle sets are
built again for the classes that share a bucket with others. A 64-bit hash stands for a shingle.

Defined results: null, empty and blank texts have no shingles, are linked with nothing and kept;
fewer words than a shingle are one shingle; repeated rows get equal results; different texts under
one doc_id count as linked; a row with null doc_id is compared with nothing, has a null component
and is kept; empty tables give no rows; other columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskengine.llm.common import carrying, kept_as
from riskengine.llm.components import components
from riskengine.llm.hyperminhash import (
    BUCKETS,
    PARITY_BITS,
    band_keys,
    estimated_jaccard,
    low_bits,
    parity_words,
    sketch,
)
from riskengine.llm.shingles import batch_shingles, runs
from riskengine.session import materialize

SHINGLE_WORDS = 5
PERCENT = 80
# Standard deviations that an estimate may fall short of the threshold.
MARGIN = 5.5

_SKETCHED = "doc_id long, n_shingles long, set_key binary, bands array<long>, bits array<long>, parity array<long>, sketch binary"


def _sketch_rows(batch: pa.RecordBatch, words: int) -> pa.RecordBatch:
    names = ["doc_id", "n_shingles", "set_key", "bands", "bits", "parity", "sketch"]
    sizes, keys, bands, bits, parities, sketches = [], [], [], [], [], []
    for found in batch_shingles(batch.column("text"), words):
        sizes.append(len(found))
        if len(found):
            registers = sketch(found)
            keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
            bands.append(band_keys(registers))
            bits.append(low_bits(registers))
            parities.append(parity_words(found))
            sketches.append(registers.tobytes())
        else:
            for column in (keys, bands, bits, parities, sketches):
                column.append(None)
    longs = pa.list_(pa.int64())
    columns = [
        batch.column("doc_id"),
        pa.array(sizes, pa.int64()),
        pa.array(keys, pa.binary()),
        pa.array(bands, longs),
        pa.array(bits, longs),
        pa.array(parities, longs),
        pa.array(sketches, pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names)


def _set_rows(batch: pa.RecordBatch, words: int) -> pa.RecordBatch:
    found = [s.view(np.int64) for s in batch_shingles(batch.column("text"), words)]
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(pa.int64()))], ["id", "shingles"])


def sketched(docs: DataFrame, words: int) -> DataFrame:
    """Size, digest and sketch of the shingle set of each text (doc_id, text)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from map(partial(_sketch_rows, words=words), runs(batch))

    return docs.mapInArrow(work, _SKETCHED)


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """id and the full set of shingle hashes of each text (doc_id, text)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from map(partial(_set_rows, words=words), runs(batch))

    return docs.mapInArrow(work, "id long, shingles array<long>")


def _estimated(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose estimated similarity is not clearly under the threshold."""
    one = sketches.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"))
    two = sketches.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b"))
    joined = pairs.join(one, "a").join(two, "b")
    share = percent / 100
    least = share - MARGIN * float(np.sqrt(share * (1 - share) / BUCKETS))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint16) for c in ("s_a", "s_b"))
            n_a, n_b = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            near = estimated_jaccard(a.reshape(-1, BUCKETS), b.reshape(-1, BUCKETS), n_a, n_b) >= least
            yield batch.select(["a", "b"]).filter(pa.array(near))

    return joined.select("a", "b", "n_a", "n_b", "s_a", "s_b").mapInArrow(work, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs that reach the threshold on full sets, as links u, v."""
    one = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    two = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(one, "a").join(two, "b")
    counted = both.select(
        "a", "b", F.size(F.array_intersect("x", "y")).alias("common"), (F.size("x") + F.size("y")).alias("all")
    )
    near = 100 * F.col("common") >= percent * (F.col("all") - F.col("common"))
    return counted.where(near).select(F.col("a").alias("u"), F.col("b").alias("v")).distinct()


def _sizes_allow(percent: int) -> Column:
    return 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")


def _differing(x: str, y: str, words: int) -> Column:
    """How many bits of two arrays of 64-bit words differ."""
    return sum(
        (F.bit_count(F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i)))) for i in range(1, words)),
        F.bit_count(F.get(x, F.lit(0)).bitwiseXOR(F.get(y, F.lit(0)))),
    )


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links and kept for documents (doc_id, text).

    `n_links` is the number of verified links of the row's class with other classes.
    """
    texts = kept_as(docs, doc_id="doc_id", text="text")
    sketches = materialize(sketched(texts, words), "dedup-sketches")
    usable = sketches.where("n_shingles > 0 and doc_id is not null")
    classes = usable.groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    members = materialize(
        usable.select("doc_id", "n_shingles", "set_key").join(classes, "set_key").select("doc_id", "n_shingles", "rep"),
        "dedup-classes",
        narrow=True,
    )
    of_rep = (F.col("set_key") == F.col("k")) & (F.col("doc_id") == F.col("rep"))
    reps = (
        usable.select("doc_id", "set_key", "bands")
        .join(classes.select(F.col("set_key").alias("k"), "rep"), of_rep)
        .select(F.col("doc_id").alias("id"), "bands")
    )
    reps = materialize(reps, "dedup-reps")

    # Only buckets that several classes share go on.
    buckets = reps.select("id", F.explode("bands").alias("bucket"))
    hubs = buckets.groupBy("bucket").agg(F.min("id").alias("hub"), F.max("id").alias("last")).where("hub <> last")
    shared = materialize(buckets.join(hubs.drop("last"), "bucket"), "dedup-buckets")
    met = shared.select("id").distinct()
    sketch_of = usable.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "bits", "parity", "sketch")
    near_reps = materialize(sketch_of.join(met, "id", "left_semi").dropDuplicates(["id", "sketch"]), "dedup-met")
    sets = materialize(
        shingle_sets(texts.join(met.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi"), words), "dedup-sets"
    )

    def links_of(pairs: DataFrame, tag: str) -> DataFrame:
        close = materialize(_estimated(pairs, near_reps, percent), f"{tag}-pairs", narrow=True)
        return materialize(_verified(close, sets, percent), f"{tag}-links", narrow=True)

    star = shared.where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    # Different texts under one doc_id belong together.
    same_id = members.groupBy("doc_id").agg(F.min("rep").alias("v"), F.max("rep").alias("u")).where("u <> v").select("u", "v")
    first = links_of(star, "dedup-star").unionByName(same_id).distinct()
    labels = components(first, "dedup-components")

    of_id = labels.select(F.col("id").alias("l_id"), "component")
    of_hub = labels.select(F.col("id").alias("h_id"), F.col("component").alias("h_component"))
    placed = (
        shared.join(of_id, F.col("id") == F.col("l_id"), "left")
        .join(of_hub, F.col("hub") == F.col("h_id"), "left")
        .select("bucket", "id", F.coalesce("component", "id").alias("c"), F.coalesce("h_component", "hub").alias("hub_c"))
    )
    strangers = placed.where("c <> hub_c")
    narrow = near_reps.select("id", "n", "bits", "parity")
    mixed = strangers.select("bucket").distinct()
    left = strangers.join(narrow, "id").select("bucket", F.col("id").alias("a"), F.col("c").alias("c_a"), F.col("n").alias("n_a"), F.col("bits").alias("x"), F.col("parity").alias("p"))
    right = (
        placed.join(mixed, "bucket", "left_semi")
        .join(narrow, "id")
        .select("bucket", F.col("id").alias("b"), F.col("c").alias("c_b"), F.col("n").alias("n_b"), F.col("bits").alias("y"), F.col("parity").alias("q"))
    )
    # The bits of registers that agree are equal, those of others are by half.
    agree = F.lit(256) - _differing("x", "y", 4)
    chance = 0.5 + percent / 200
    least = 256 * chance - MARGIN * float(np.sqrt(256 * chance * (1 - chance)))
    pairs = (
        left.join(right, "bucket")
        .where((F.col("c_a") != F.col("c_b")) & _sizes_allow(percent) & (agree >= F.lit(least)))
        .where((100 + percent) * _differing("p", "q", PARITY_BITS // 64) <= (100 - percent) * (F.col("n_a") + F.col("n_b")))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
        .join(star, ["a", "b"], "left_anti")
    )
    second = links_of(pairs, "dedup-rest")
    links = materialize(first.unionByName(second).distinct(), "dedup-all-links", narrow=True)
    labels = components(links, "dedup-components")

    ends = links.select(F.col("u").alias("e")).union(links.select(F.col("v").alias("e"))).groupBy("e").agg(F.count("*").alias("n_links"))
    linked = members.join(labels, F.col("rep") == F.col("id"), "left").join(ends, F.col("rep") == F.col("e"), "left")
    found = linked.select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    alone = sketches.where("n_shingles = 0 or doc_id is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links")
    )
    return found.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one_of_each(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each group of near duplicates, with all columns.

    Of rows that share a kept doc_id the one with the smallest text hash stays; rows without a
    doc_id all stay.
    """
    return carrying(docs, ("doc_id", "text"), lambda named: _one_of_each(named, words, percent))


def _one_of_each(docs: DataFrame, words: int, percent: int) -> DataFrame:
    found = materialize(near_duplicates(docs, words, percent).select("doc_id", "kept"), "dedup-kept", narrow=True)
    # Written first: where few documents go, these are known to be small and texts are not shuffled.
    gone = materialize(found.where("not kept").select("doc_id").distinct(), "dedup-gone", narrow=True)
    counts = found.where("kept and doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("_n"))
    repeated = materialize(counts.where("_n > 1").select("doc_id"), "dedup-repeated", narrow=True)
    single = docs.join(gone, "doc_id", "left_anti").join(repeated, "doc_id", "left_anti").select(docs.columns)
    copies = Window.partitionBy("doc_id").orderBy(F.xxhash64(F.coalesce("text", F.lit(""))))
    numbered = docs.join(repeated, "doc_id", "left_semi").withColumn("_copy", F.row_number().over(copies))
    return single.unionByName(numbered.where("_copy = 1").select(docs.columns))
