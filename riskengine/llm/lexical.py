"""Operator 12: the best documents for each item, by NRA over impact-sorted posting lists.

One scan turns every whole text into its number of words and the counts of the words that items
use; the corpus' statistics come from that table. Documents are then dealt into shards of bounded
size. In a shard each word has a posting list sorted by impact (the part of the score that the word
gives a document). For an item, its lists are read from the top, a slice at a time and without
looking anything up in between. Every document met has a lower bound, the impacts read so far, and
an upper one, which adds for each list that it wasn't met in the impact where that list now stands.
Reading goes on until

* no document outside the best k, met or not, can reach the k-th lower bound (membership and ties),
* both bounds of each document that still can are equal (final scores).

Lists in which every such document was met are not read on. A task carries each item's k-th score
from one shard to the next and returns its best k alone, with all ties of the last place resolved
by id; these few rows are ranked over all tasks at the end. No postings are shuffled.

Items are worked through in blocks of bounded text size, whose words and weights go with the tasks;
a small table of items is one block. All arithmetic after the weights is on whole numbers.

Defined results: null texts have no words; a document without words isn't counted; an item without
words, or whose words stand nowhere, gets no row; a row that repeats an item's id and text is the
same item, another text under the same id is ranked on its own, as is a null item_id; repeated
doc_ids are documents of their own, null ones come last among equal scores; empty tables give no
rows; other columns are not carried.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskengine.llm.common import kept_as, whole_text
from riskengine.session import materialize

TOP = 20
# Bytes of item texts that go with the tasks at once.
BLOCK_BYTES = 4 << 20
# Postings that a task holds at once.
SHARD_POSTINGS = 1 << 20
# Bytes of a text that are cut into words at once.
PIECE_BYTES = 1 << 20
# Postings read from each list at first; each further slice is twice as long.
FIRST_SLICE = 64
# The constants of the score.
LENGTH_SHARE = 25
TF_SCALE = 1_000_000_000
TF_UNIT = 1_000
M_UNIT = 12

# Fixed value: bytes of words are ASCII letters and digits, and all of non-ASCII characters.
_WORD_BYTES = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100))
_TO_WORDS = bytes(c if c in _WORD_BYTES else 0x20 for c in bytes(range(256)).lower())

_INDEX = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32()))]
)
_FOUND = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])


def words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a UTF-8 text in order, A-Z lower-cased, in lists of bounded size."""
    spaced, start = text.translate(_TO_WORDS), 0
    while start < len(spaced):
        end = spaced.find(b" ", start + PIECE_BYTES)
        end = len(spaced) if end < 0 else end
        yield spaced[start:end].split()
        start = end


def _count_terms(vocabulary: dict[bytes, int]):
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, terms, tfs = [], [], []
            for text in batch.column("text").cast(pa.binary()):
                held: Counter = Counter()
                for found in words(text.as_py()):
                    held.update(map(vocabulary.get, found))
                lengths.append(held.total())
                held.pop(None, None)
                terms.append(list(held))
                tfs.append(list(held.values()))
            columns = [batch.column("doc_id"), *(pa.array(c, kind.type) for c, kind in zip((lengths, terms, tfs), list(_INDEX)[1:]))]
            yield pa.RecordBatch.from_arrays(columns, schema=_INDEX)

    return count


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """(10^9 tf) div (1000 tf + 12 m) with m = 75 + (25 n N) div L, all in whole numbers."""
    if int(n.max(initial=0)) * LENGTH_SHARE * documents >= 2**63 or int(tf.max(initial=0)) * TF_SCALE >= 2**63:
        tf, n = tf.astype(object), n.astype(object)
    m = 100 - LENGTH_SHARE + (LENGTH_SHARE * n * documents) // length
    return ((TF_SCALE * tf) // (TF_UNIT * tf + M_UNIT * m)).astype(np.int64)


def nra(
    lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int, top: int, floor: int = 0, first: int = FIRST_SLICE
) -> tuple[np.ndarray, np.ndarray]:
    """Documents that can be among the best `top`, with their exact scores, ties of the last place included.

    `lists` are (documents, impacts) with falling impacts, every document once in a list. `floor` is
    a score that is known to be reached by `top` other documents: lower ones are left out.
    """
    lower = np.zeros(n_docs, np.int64)
    met = np.zeros((len(lists), n_docs), bool)
    at = np.zeros(len(lists), np.int64)
    ends = np.array([len(docs) for docs, _ in lists])
    frontier = np.array([weights[0] if len(weights) else 0 for _, weights in lists], np.int64)
    needed = ends > 0
    alive, open_to_new, step = np.arange(0), True, first
    bound = floor
    while needed.any():
        for t in np.flatnonzero(needed):
            docs, weights = lists[t]
            stop = min(at[t] + step, ends[t])
            read = docs[at[t] : stop]
            lower[read] += weights[at[t] : stop]
            met[t, read] = True
            at[t] = stop
            frontier[t] = weights[stop] if stop < ends[t] else 0
        step *= 2
        if open_to_new:
            alive = np.flatnonzero(lower)
        if len(alive) >= top:
            bound = max(bound, int(np.partition(lower[alive], len(alive) - top)[len(alive) - top]))
        # The first test spares the sum over lists for documents that are out in any case.
        alive = alive[lower[alive] + frontier.sum() >= bound]
        missing = ~met[:, alive] & (frontier > 0)[:, None]
        upper = lower[alive] + (frontier[:, None] * missing).sum(0)
        still = upper >= bound
        alive, missing = alive[still], missing[:, still]
        # Bounds only tighten, so once no unmet document can get in, none ever will.
        open_to_new = open_to_new and frontier.sum() >= max(bound, 1)
        needed = frontier > 0 if open_to_new else missing.any(1)
    return alive, lower[alive]


def _best(found: list[tuple[np.ndarray, np.ndarray]], top: int) -> tuple[np.ndarray, np.ndarray]:
    """The best `top` by score, then by id; null ids (the largest long) last."""
    ids, scores = (np.concatenate(parts) for parts in zip(*found))
    order = np.lexsort((ids, -scores))[:top]
    return ids[order], scores[order]


_NO_ID = np.iinfo(np.int64).max


def _search(items: list[list[tuple[int, int]]], weights: np.ndarray, documents: int, length: int, top: int):
    """A task: the best `top` documents of each item among the task's documents."""

    def shard(parts: list[pa.RecordBatch], best: list) -> None:
        ids = np.concatenate([p.column("doc_id").fill_null(_NO_ID).to_numpy(zero_copy_only=False) for p in parts])
        n = np.concatenate([p.column("n").to_numpy() for p in parts])
        sizes = np.concatenate([p.column("terms").value_lengths().to_numpy() for p in parts])
        term = np.concatenate([p.column("terms").flatten().to_numpy() for p in parts])
        tf = np.concatenate([p.column("tfs").flatten().to_numpy() for p in parts]).astype(np.int64)
        doc = np.repeat(np.arange(len(ids)), sizes)
        part = impacts(tf, n[doc], documents, length)
        order = np.lexsort((-part, term))
        doc, part = doc[order], part[order]
        starts = np.searchsorted(term[order], np.arange(len(weights) + 1))
        for k, item in enumerate(items):
            lists = [
                (doc[starts[t] : starts[t + 1]], part[starts[t] : starts[t + 1]] * (weights[t] * times))
                for t, times in item
                if weights[t] > 0 and starts[t] < starts[t + 1]
            ]
            if not lists:
                continue
            full = best[k] is not None and len(best[k][1]) == top
            docs, scores = nra(lists, len(ids), top, int(best[k][1][-1]) if full else 0, FIRST_SLICE)
            if len(docs):
                best[k] = _best([(ids[docs], scores), *([best[k]] if best[k] is not None else [])], top)

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list = [None] * len(items)
        held, postings = [], 0
        for batch in batches:
            lengths = batch.column("terms").value_lengths().to_numpy().cumsum()
            start = 0
            while start < batch.num_rows:
                before = int(lengths[start - 1]) if start else 0
                stop = int(np.searchsorted(lengths, before + SHARD_POSTINGS - postings)) + 1
                piece = batch.slice(start, stop - start)
                held.append(piece)
                postings += int(lengths[min(stop, batch.num_rows) - 1]) - before
                start = stop
                if postings >= SHARD_POSTINGS:
                    shard(held, best)
                    held, postings = [], 0
        if held:
            shard(held, best)
        for k, found in enumerate(best):
            if found is not None:
                ids = pa.array(found[0], mask=found[0] == _NO_ID)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), k, np.int32)), ids, pa.array(found[1])], schema=_FOUND)

    return search


def _weight(df: int, documents: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def _search_block(docs: DataFrame, items: list, top: int) -> DataFrame | None:
    """item (place in `items`), doc_id and score of the best documents in each task."""
    texts = [[w for found in words(item["text"].encode()) for w in found] for item in items]
    vocabulary = {w: k for k, w in enumerate(sorted({w for text in texts for w in text}))}
    index = materialize(docs.mapInArrow(_count_terms(vocabulary), "doc_id long, n long, terms array<int>, tfs array<int>").where("n > 0"), "term-counts")
    total = index.agg(F.count("*").alias("docs"), F.sum("n").alias("length")).first()
    if not total["docs"]:
        return None
    # One row a word of the items: bounded by their block.
    frequency = index.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    weights = np.zeros(len(vocabulary), np.int64)
    for row in frequency:
        weights[row["term"]] = _weight(row["count"], total["docs"])
    queries = [sorted(Counter(vocabulary[w] for w in text).items()) for text in texts]
    held = index.where(F.size("terms") > 0)
    return held.mapInArrow(_search(queries, weights, total["docs"], total["length"], top), "item int, doc_id long, score long")


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id and score of the best `top` documents (doc_id, text) for each item (item_id, text)."""
    spark = docs.sparkSession
    texts = kept_as(docs, doc_id="doc_id", text="text").select(F.col("doc_id").cast("long").alias("doc_id"), whole_text("text").alias("text"))
    queries = kept_as(items, item_id="item_id", text="text").where("text is not null").distinct()
    size = queries.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0)).alias("b")).first()["b"]
    blocks = -(-size // block_bytes)
    numbered = queries.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, blocks))))
    id_type = queries.schema["item_id"].dataType.simpleString()
    found = spark.createDataFrame([], f"item int, doc_id long, score long, item_key long, item_id {id_type}")
    for b in range(blocks):
        block = numbered.where(F.col("block") == b).select("item_id", "text").collect()
        part = _search_block(texts, block, top)
        if part is None:
            continue
        names = spark.createDataFrame(
            [(k, (b << 32) + k, item["item_id"]) for k, item in enumerate(block)],
            f"item int, item_key long, item_id {id_type}",
        )
        found = found.unionByName(part.join(names, "item"))
    order = Window.partitionBy("item_key").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.select("item_id", "item_key", "doc_id", "score", F.row_number().over(order).alias("rank"))
    return ranked.where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")
