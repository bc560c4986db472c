"""Operator 13: lines that many documents share, dropped everywhere but in one document.

Texts are exploded into lines; a line's key is the line without ASCII white space at its ends and
with A-Z lower-cased. Keys of at least `min_chars` code points are hashed (128 bits), the distinct
documents of each hash are counted, and lines whose hash reaches `min_docs` documents go, except in
the document of the largest id. What is kept is put together again by position.

Only hashes and positions move in the count and in the join; the texts move once, to meet their
dropped positions. Documents are counted over (hash, document) first, so a line that a third of all
rows hold is spread over many tasks. The hashes found are written, so that the join knows how many
there are.

Defined results: a null or empty text is one empty line; a repeated row, or another text under the
same id, is part of the same document for the counts and gets a row of its own; a row without an
id belongs to no document: its lines are neither counted nor dropped; a text whose lines all go is
empty; a line that ends with a carriage return has the key without it and keeps it if it stays;
an empty table gives no rows; other columns are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskengine.llm.common import ascii_lower, kept_as, whole_text
from riskengine.session import materialize

MIN_CHARS = 20
MIN_DOCS = 3
# Fixed value: the white space that a key loses at its ends, \x20 and \x09 to \x0D.
WHITE_SPACE = " \t\n\v\f\r"


def line_key(line: Column) -> Column:
    """The normal form under which lines are equal."""
    return ascii_lower(F.btrim(line, F.lit(WHITE_SPACE)))


def _texts(docs: DataFrame) -> DataFrame:
    text = whole_text("text")
    return kept_as(docs, doc_id="doc_id", text="text").select(
        "doc_id", F.xxhash64(text).alias("text_key"), F.split(text, "\n").alias("lines")
    )


def hashed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, text_key, pos and key_hash of every line whose key is long enough to be counted."""
    lines = _texts(docs).where("doc_id is not null").select("doc_id", "text_key", F.posexplode("lines").alias("pos", "line"))
    key = lines.select("doc_id", "text_key", "pos", line_key(F.col("line")).alias("key"))
    return key.where(F.char_length("key") >= min_chars).select(
        "doc_id", "text_key", "pos", F.unhex(F.md5("key")).alias("key_hash")
    )


def shared_lines(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """key_hash, n_docs and last_doc of the hashes that stand in enough documents."""
    held = lines.groupBy("key_hash", "doc_id").agg(F.lit(1).alias("held"))
    counts = held.groupBy("key_hash").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc"))
    return counts.where(F.col("n_docs") >= min_docs)


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, n_lines, n_dropped and the kept text of every document (doc_id, text)."""
    lines = materialize(hashed_lines(docs, min_chars), "line-hashes")
    shared = materialize(shared_lines(lines, min_docs), "shared-lines")
    drops = (
        lines.join(shared, "key_hash")
        .where(F.col("doc_id") != F.col("last_doc"))
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set("pos").alias("dropped"))
    )
    joined = _texts(docs).join(drops, ["doc_id", "text_key"], "left")
    dropped = F.coalesce("dropped", F.array().cast("array<int>"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), dropped)
    return joined.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.size(dropped).cast("long").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), F.array_join("lines", "\n"))
        .otherwise(F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n"))
        .alias("text"),
    )
