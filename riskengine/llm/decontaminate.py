"""Operator 6: exact benchmark windows in documents, by a prefix-filtered set join.

Every item is cut into windows of its consecutive words. Containment must be complete, so one word
of a window is a sufficient prefix, and the rarest by document frequency over the whole corpus is
taken. Documents are exploded into word positions and joined with these rare words alone; the
word's place in the window fixes where the window must start (positional bound), which must leave
room for all of it (length bound), and the words there are compared one by one.

Explode, join, bounds and comparison are one stage, so no text is shuffled: only the words'
document frequencies and the occurrences found move. The window table is worked through in blocks
of proven size, each small enough to be broadcast; a small benchmark is one block.

Defined results: null texts have no words; items without words have no windows; documents without
words or hits get zeros and the digest of an empty list; repeated items count once per item_id, a
null item_id is never listed nor counted though its windows hit; rows that share a doc_id and a
text are one document for the counts and each get a row; empty tables give no rows, or rows
without hits; other columns are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskengine.llm.common import carrying, document_frequency, kept_as, symbol_words, whole_text
from riskengine.session import materialize

WINDOW_WORDS = 10
# Bytes of window words in one broadcast block.
BLOCK_BYTES = 16 << 20


def item_windows(items: DataFrame, words: int = WINDOW_WORDS) -> DataFrame:
    """item_id and each `window` of its consecutive words; shorter items are one window."""
    tokens = kept_as(items, item_id="item_id", text="text").select(
        "item_id", symbol_words(whole_text("text")).alias("tokens")
    )
    starts = F.sequence(F.lit(1), F.greatest(F.size("tokens") - words + 1, F.lit(1)))
    return (
        tokens.where(F.size("tokens") > 0)
        .select("item_id", "tokens", F.explode(starts).alias("s"))
        .select("item_id", F.slice("tokens", F.col("s"), words).alias("window"))
        .distinct()
    )


def anchored(windows: DataFrame, frequency: DataFrame) -> DataFrame:
    """Distinct windows with the items they belong to, their rarest word and its place."""
    distinct = windows.groupBy("window").agg(F.collect_set("item_id").alias("items"))
    placed = distinct.select("window", "items", F.posexplode("window").alias("offset", "word"))
    ranked = placed.join(frequency, "word").groupBy("window").agg(
        F.min(F.struct("df", "word", "offset")).alias("rarest"), F.first("items").alias("items")
    )
    return ranked.select("window", "items", F.col("rarest.word").alias("anchor"), F.col("rarest.offset").alias("offset"))


def _occurrences(tokens: DataFrame, block: DataFrame) -> DataFrame:
    """(key, start, length, items) for every place where a window of the block stands.

    A place beyond a document's last word joins with the empty anchor, so that the scan also
    returns each document once, with its number of words.
    """
    words = F.col("tokens")
    exploded = tokens.withColumn("n_words", F.size("tokens")).select(
        "doc_id", "text_key", "n_words", "tokens", F.posexplode(F.concat(words, F.array(F.lit("")))).alias("pos", "word")
    )
    start = F.col("pos") - F.col("offset")
    stands = (
        (start >= 0)
        & (start + F.size("window") <= F.col("n_words"))
        & (F.slice("tokens", F.greatest(start, F.lit(0)) + 1, F.size("window")) == F.col("window"))
    )
    # The block's bytes are bounded by BLOCK_BYTES.
    joined = exploded.join(F.broadcast(block), F.col("word") == F.col("anchor"))
    return joined.where((F.col("word") == "") | stands).select(
        "doc_id",
        "text_key",
        F.when(F.col("word") == "", F.col("n_words")).alias("n_words"),
        F.when(F.col("word") != "", start).alias("start"),
        F.size("window").alias("length"),
        "items",
    )


def _digest(items: Column) -> Column:
    return F.sha2(F.array_join(F.array_sort(items), ","), 256)


def _documents(docs: DataFrame) -> DataFrame:
    text = whole_text("text")
    return kept_as(docs, doc_id="doc_id", text="text").select(
        "doc_id", F.xxhash64(text).alias("text_key"), symbol_words(text).alias("tokens")
    )


def decontaminate(docs: DataFrame, items: DataFrame, words: int = WINDOW_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated for documents (doc_id, text)."""
    tokens = _documents(docs)
    windows = materialize(item_windows(items, words), "windows")
    vocabulary = windows.select(F.explode("window").alias("word"))
    frequency = materialize(document_frequency(tokens, vocabulary), "window-words")
    anchors = materialize(anchored(windows, frequency), "window-anchors")

    size = F.sum(F.length(F.array_join("window", " ")) + 8 * F.size("items") + 64)
    total = anchors.agg(F.coalesce(size, F.lit(0)).alias("b")).first()["b"]
    blocks = max(1, -(-total // BLOCK_BYTES))
    numbered = anchors.withColumn("block", F.pmod(F.xxhash64("window"), F.lit(blocks)))
    marker = anchors.sparkSession.range(1).select(
        F.array().cast("array<string>").alias("window"),
        F.array().cast(anchors.schema["items"].dataType).alias("items"),
        F.lit("").alias("anchor"),
        F.lit(0).alias("offset"),
    )
    found = None
    for b in range(blocks):
        block = numbered.where(F.col("block") == b).drop("block")
        part = _occurrences(tokens, block.unionByName(marker) if b == 0 else block)
        found = part if found is None else found.unionByName(part)
    found = materialize(found, "window-places")

    # Copies of a row (same id and text) give the same places; they are counted here and returned below.
    documents = found.where("n_words is not null").groupBy("doc_id", "text_key").agg(
        F.max("n_words").cast("long").alias("n_words"), F.count("*").alias("copies")
    )
    places = found.where("start is not null").select("doc_id", "text_key", "start", "length", "items").distinct()
    hit = (
        places.select("doc_id", "text_key", F.explode(F.expr("sequence(start, start + length - 1)")).alias("p"))
        .distinct()
        .groupBy("doc_id", "text_key")
        .agg(F.count("*").alias("n_hit"))
    )
    listed = (
        places.select("doc_id", "text_key", F.explode("items").alias("item"))
        .distinct()
        .groupBy("doc_id", "text_key")
        .agg(F.count("*").alias("n_items"), _digest(F.collect_set(F.col("item").cast("string"))).alias("items_sha256"))
    )
    hits = hit.join(listed, hit["doc_id"].eqNullSafe(listed["doc_id"]) & (hit["text_key"] == listed["text_key"]), "left").select(
        hit["doc_id"].alias("h_id"), hit["text_key"].alias("h_key"), "n_hit", "n_items", "items_sha256"
    )
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return (
        documents.join(hits, F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("text_key") == F.col("h_key")), "left")
        .withColumn("copy", F.explode(F.expr("sequence(1, copies)")))
        .select(
            "doc_id",
            "text_key",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
            F.coalesce("items_sha256", nothing).alias("items_sha256"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        )
    )


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents in which no benchmark window occurs, with all their columns."""
    return carrying(docs, ("doc_id", "text"), lambda named: _without_contaminated(named, items))


def _without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    bad = (
        decontaminate(docs, items)
        .where("contaminated")
        .select(F.col("doc_id").alias("_bad_id"), F.col("text_key").alias("_bad_key"))
        .distinct()
    )
    same = docs["doc_id"].eqNullSafe(F.col("_bad_id")) & (F.xxhash64(whole_text(docs["text"])) == F.col("_bad_key"))
    return docs.join(bad, same, "left_anti")
