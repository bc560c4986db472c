"""Operator 9: license phrases, and license templates by an exact set-similarity join.

Blocks are windows of consecutive words, across the ends of lines: up to |words of T| / THRESHOLD of
them, so that a wrapped notice is one block and a long line is not. A template is found in a block
that holds at least THRESHOLD of its distinct words. Template words are put in order of their
document frequency over the whole corpus; a block that reaches the threshold must hold one of the
first |T| - need + 1 of them (prefix), must have `need` words itself (length), and if that word is
the first one in common, the block must hold `need` of the template's words from it on (position).
A block is thus a candidate of its first common word, and of later ones only where enough follow. Candidates are compared
in full.

Templates are a fixed list, so the join's other side is of fixed size and is broadcast. A text's
prefix words are found in its row; each is taken with as many words around it as a block can have,
joined, filtered and compared in one stage without a shuffle of texts.

Defined results: a null text is empty and has no words, labels or places; labels are distinct and
sorted; ties between templates all count; rows that share a doc_id and a text each get a row;
empty tables give no rows; other columns are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskengine.llm.common import (
    document_frequency,
    kept_as,
    symbol_words,
    whole_text,
)
from riskengine.session import materialize

THRESHOLD = 0.8
# The phrases of the base rule and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Opening sentences of common license notices.
TEMPLATES = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0",
    "bsd-notice": "Redistribution and use in source and binary forms, with or without modification, "
    "are permitted provided that the following conditions are met",
    "cc-by-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3",
    "gpl-program-notice": "This program is free software: you can redistribute it and/or modify it under the "
    "terms of the GNU General Public License as published by the Free Software Foundation",
    "isc-notice": "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
    "without fee is hereby granted",
    "mit-notice": "Released under the MIT License",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
    "software and associated documentation files",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}


def template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """label, text: the fixed list as literals of a plan."""
    pairs = F.create_map(*(F.lit(x) for pair in sorted(templates.items()) for x in pair))
    return spark.range(1).select(F.explode(pairs.cast("map<string,string>")).alias("label", "text"))


def template_prefixes(spark: SparkSession, frequency: DataFrame, templates: dict[str, str], threshold: float) -> DataFrame:
    """One row per template and prefix word: word, label, template, place, need, longest (block in words)."""
    words = symbol_words(F.col("text"))
    longest = F.ceil(F.round(F.size(words) / F.lit(threshold), 6)).cast("int")
    sets = template_table(spark, templates).select("label", longest.alias("longest"), F.array_distinct(words).alias("words"))
    ranked = (
        sets.select("label", "longest", F.explode("words").alias("word"))
        .join(frequency, "word")
        .groupBy("label", "longest")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("df", "word"))), lambda x: x["word"]).alias("template"))
        # Rounded first: 0.8 * 5 must not become 5 by a last binary digit.
        .withColumn("need", F.ceil(F.round(F.lit(threshold) * F.size("template"), 6)).cast("int"))
    )
    prefix = F.slice("template", F.lit(1), F.size("template") - F.col("need") + 1)
    return ranked.select("label", "template", "need", "longest", F.posexplode(prefix).alias("place", "word"))


def _phrase_places(words: Column, phrase: str) -> Column:
    """Where the phrase's words stand; only documents with its first word are searched."""
    parts = phrase.split()

    def stands(i: Column) -> Column:
        test = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            test = test & (F.get(words, i + k) == part)
        return F.coalesce(test, F.lit(False))

    found = F.filter(F.sequence(F.lit(0), F.size(words) - 1), stands)
    return F.when(F.array_contains(words, parts[0]), found).otherwise(F.array().cast("array<int>"))


def _surroundings(words: Column, wanted: list[str], reach: int) -> Column:
    """(at, word, near) of each wanted word; near has the reach - 1 words on either side of it."""
    at = F.array_compact(F.transform(words, lambda w, i: F.when(w.isin(wanted), i)))
    first = lambda i: F.greatest(i - (reach - 1), F.lit(0))
    return F.transform(
        at,
        lambda i: F.struct(
            i.alias("at"), F.get(words, i).alias("word"), F.slice(words, first(i) + 1, i + reach - first(i)).alias("near")
        ),
    )


def _enough_follow(near: Column, template: Column, place: Column, need: Column) -> Column:
    """Positional filter: `need` of the template's words from `place` on, rarest first, are near."""
    rest = F.slice(template, place + 1, F.size(template))
    return F.size(F.array_intersect(near, rest)) >= need


def scan_licenses(
    docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """doc_id, n_words, base places and labels, all labels, and score for documents (doc_id, text).

    `score` is the largest share of a template's words that a block holds where it reaches the
    threshold, else 0. `blocks` lists the finds as (first word from 0, label, share).
    """
    templates = TEMPLATES if templates is None else templates
    spark = docs.sparkSession
    text = whole_text("text")
    phrased = kept_as(docs, doc_id="doc_id", text="text").select(
        "doc_id", F.xxhash64(text).alias("text_key"), symbol_words(text).alias("words")
    )
    vocabulary = template_table(spark, templates).select(F.explode(symbol_words(F.col("text"))).alias("word"))
    frequency = document_frequency(phrased.select(F.col("words").alias("tokens")), vocabulary)
    prefixes = materialize(
        template_prefixes(spark, materialize(frequency, "license-words"), templates, threshold), "license-prefixes"
    )

    # A fixed list as well: the prefix words and the longest block of any template.
    listed = prefixes.select("word", "longest").collect()
    wanted, reach = sorted({r["word"] for r in listed}), max((r["longest"] for r in listed), default=1)
    phrased = phrased.select(
        "doc_id",
        "text_key",
        _surroundings(F.col("words"), wanted, reach).alias("places"),
        F.size("words").cast("long").alias("n_words"),
        *(_phrase_places(F.col("words"), p).alias(f"at_{i}") for i, p in enumerate(PHRASES)),
    )
    at = [F.col(f"at_{i}") for i in range(len(PHRASES))]
    based = phrased.select(
        "doc_id",
        "text_key",
        "places",
        F.struct(
            "n_words",
            F.size(F.concat(*at)).cast("long").alias("n_base"),
            F.array_min(F.concat(*at)).cast("long").alias("first_word"),
            F.array_max(F.concat(*at)).cast("long").alias("last_word"),
            F.filter(
                F.array(*(F.when(F.size(a) > 0, F.lit(label)) for a, label in zip(at, PHRASES.values()))),
                lambda x: x.isNotNull(),
            ).alias("base"),
        ).alias("facts"),
    )
    # One more place with the empty word: it joins with the marker and returns each document once.
    own = F.struct(F.lit(0).alias("at"), F.lit("").alias("word"), F.array(F.lit("")).alias("near"))
    by_word = based.select(
        "doc_id", "text_key", "facts", F.explode(F.concat("places", F.array(own))).alias("p")
    ).select("doc_id", "text_key", "facts", "p.*")
    marker = spark.range(1).select(
        F.lit("").alias("label"),
        F.array(F.lit("")).alias("template"),
        F.lit(1).alias("need"),
        F.lit(1).alias("longest"),
        F.lit(0).alias("place"),
        F.lit("").alias("word"),
    )
    # Of the words around, only those that a block of this template can reach.
    before = F.least("at", F.lit(reach - 1))
    skip = F.greatest(before - F.col("longest") + 1, F.lit(0))
    # Templates are a fixed list: the broadcast side is a few hundred words.
    close = (
        by_word.join(F.broadcast(prefixes.unionByName(marker)), "word")
        .withColumn("before", before - skip)
        .withColumn("near", F.slice("near", skip + 1, before - skip + F.col("longest")))
        .where(F.size("near") >= F.col("need"))
        .where(_enough_follow(F.col("near"), F.col("template"), F.col("place"), F.col("need")))
    )
    # Every block with the prefix word in it; of the best ones the last to start.
    blocks = F.transform(
        F.sequence(F.lit(0), F.col("before")),
        lambda i: F.struct(
            F.size(F.array_intersect(F.slice("near", i + 1, F.col("longest")), "template")).alias("common"), i.alias("start")
        ),
    )
    found = (
        close.withColumn("best", F.array_max(blocks))
        .where(F.col("best.common") >= F.col("need"))
        .select(
            "doc_id",
            "text_key",
            F.when(F.col("label") == "", F.col("facts")).alias("facts"),
            F.when(
                F.col("label") != "",
                F.struct(
                    (F.col("at") - F.col("before") + F.col("best.start")).alias("at"),
                    "label",
                    (F.col("best.common") / F.size("template")).alias("share"),
                ),
            ).alias("find"),
        )
    )
    per_doc = found.groupBy("doc_id", "text_key").agg(
        F.first("facts", ignorenulls=True).alias("facts"),
        F.count("facts").alias("copies"),
        F.array_sort(F.collect_set("find")).alias("blocks"),
    )
    base = F.col("facts.base")
    added = F.transform("blocks", lambda b: b["label"])
    return per_doc.withColumn("copy", F.explode(F.expr("sequence(1, copies)"))).select(
        "doc_id",
        *(F.col(f"facts.{c}").alias(c) for c in ("n_words", "n_base", "first_word", "last_word")),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, added)), ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("blocks", lambda b: b["share"])), F.lit(0.0)).alias("score"),
        "blocks",
    )
