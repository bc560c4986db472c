"""Tokenizers and small helpers that several corpus operators share."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskengine.session import materialize

# The two word definitions of the query contracts, as gaps between words.
SPACE_GAP = r"[\x20\x09-\x0D]+"
SYMBOL_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(col: str | Column) -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased; every other character stays as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def space_words(text: Column) -> Column:
    """Words between ASCII white space, in order; an empty array for an empty text."""
    return F.array_remove(F.split(text, SPACE_GAP), "")


def symbol_words(text: Column) -> Column:
    """Lower-cased words of ASCII letters, digits and any non-ASCII characters."""
    return F.array_remove(F.split(ascii_lower(text), SYMBOL_GAP), "")


def kept_as(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under names of the operator, so that others cannot clash."""
    return df.select(*(F.col(f"`{old}`").alias(new) for new, old in columns.items()))


def carrying(docs: DataFrame, needed: tuple[str, ...], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`work` on `docs`, whose columns that are not `needed` go through it under names of no one else.

    No helper column has a space in its name, so none can clash with a column of the caller's.
    """
    aside = {c: f"carried {i}" for i, c in enumerate(docs.columns) if c not in needed}
    done = work(docs.select(*(F.col(f"`{c}`").alias(aside.get(c, c)) for c in docs.columns)))
    back = {v: k for k, v in aside.items()}
    return done.select(*(F.col(f"`{c}`").alias(back.get(c, c)) for c in done.columns))


def document_frequency(tokens: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """word, df: how many rows of the whole corpus (column `tokens`) hold each word of `vocabulary`.

    The vocabulary is written first, so that the join knows its size: a small one is broadcast by
    the optimizer and the corpus' words are counted without being shuffled.
    """
    wanted = materialize(vocabulary.select("word").distinct(), "vocabulary")
    held = tokens.select(F.explode(F.array_distinct("tokens")).alias("word"))
    counts = held.join(wanted, "word", "left_semi").groupBy("word").agg(F.count("*").alias("df"))
    return wanted.join(counts, "word", "left").select("word", F.coalesce("df", F.lit(0)).alias("df"))
