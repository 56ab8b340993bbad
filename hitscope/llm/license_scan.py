"""License scans: an exact set-similarity join of text blocks with license
templates, beside the places of fixed phrases.

A block (a line of the lower-cased text) meets a template if it holds at
least ``threshold`` of the template's distinct words.  The words of all
templates are ordered by their frequency over all documents, rarest first.
Then, as in prefix-filtered joins:

* prefix: with ``need = ceil(threshold * size)``, a block that meets the
  template has one of its ``size - need + 1`` rarest words; the index holds
  only those, and texts without any of them are not cut into blocks at all;
* length: the block has at least ``need`` distinct words;
* position: at a common word in place i of the template and place j of the
  block's template words, ``1 + min(what is left of either) >= need``.

Notices that are wrapped over lines are found with ``wrapped=True``: around
each end of a line stands one more block, of the words that a span as long as
the longest template can reach over it (ends of lines next to each other, and
prefixes of comments, are no words).  It passes the same filters; then some
span of as many words as the template has must hold ``need`` of its words.
The words of a line that is one block are not held to a span.

What passes is verified on the full sets.  The index and the templates are a
parameter of bounded size (``MAX_WORDS``), so they are broadcast; blocks are
never compared with each other, and nothing is grouped by a frequent word.

Defined cases: null or empty text has no words, no places, no labels and
score 0.  Rows that repeat an id are scanned each for itself.  The score is 1
if a phrase stands in the text, else the best share of a template's words in
one block among the templates met, else 0.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitscope.llm.runtime import lower_ascii, prepare

THRESHOLD = 0.8
MAX_WORDS = 100_000
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SEPARATORS_BUT_LINES = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"

PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: Opening sentences of common license notices, with the label they give.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("cc-by-4.0", "Licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)


def _spaced(text: Column) -> Column:
    """The words of a text with one space before, between and after them."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(lower_ascii(text), SEPARATORS, " ")), F.lit(" "))


def _words(spaced: Column) -> Column:
    return F.split(F.trim(spaced), " ")


def _places(words: Column, phrase: str) -> Column:
    """Places in an array of words, from 0, where a phrase's words start."""
    parts = phrase.split(" ")
    return F.filter(
        F.transform(words, lambda w, i: F.when(w == parts[0], i)),
        lambda i: i.isNotNull() & (F.array_join(F.slice(words, i + 1, len(parts)), " ") == phrase),
    )


def _line_ends(text: Column) -> Column:
    """For each end of a line between words, the number of words before it."""
    marked = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(lower_ascii(text), SEPARATORS_BUT_LINES, " "), r" *\n[ \n]*", " \n "), r"^ \n | \n $", ""))
    ends = F.filter(F.transform(F.split(marked, " "), lambda w, i: F.when(w == "\n", i)), lambda i: i.isNotNull())
    return F.transform(ends, lambda p, j: p - j)


def _span_share(words: Column, sentence: Column, n: Column) -> Column:
    """The most of ``sentence``'s distinct words that ``n`` words in a row hold."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - n, F.lit(0)))
    return F.array_max(F.transform(starts, lambda i: F.size(F.array_intersect(F.slice(words, i + 1, n), sentence))))


def _sentence_words(sentence: str) -> list[str]:
    low = sentence.translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def _template_words(sentence: str) -> list[str]:
    return sorted(set(_sentence_words(sentence)))


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: Sequence[tuple[str, str]] = PHRASES,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
    wrapped: bool = False,
) -> DataFrame:
    """(id, n_words, places: struct per phrase, base_labels, found_labels,
    score) for every row."""
    spark = prepare(docs.sparkSession)
    sets = [(label, _template_words(s)) for label, s in templates]
    spans = [len(_sentence_words(s)) for _, s in templates]
    vocabulary = sorted({w for _, ws in sets for w in ws})
    if len(vocabulary) > MAX_WORDS:
        raise ValueError("too many template words to broadcast")
    text = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))

    # 1. frequency over all documents of the words that templates use
    known = F.array(*map(F.lit, vocabulary)) if vocabulary else F.array().cast("array<string>")
    counted = (
        text.select(F.explode(F.array_intersect(_words(_spaced(F.col("text"))), known)).alias("word"))
        .groupBy("word").count().collect()  # as many rows as template words at most
    )
    often = {r["word"]: r["count"] for r in counted}
    rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (often.get(w, 0), w)))}
    ordered = sorted(vocabulary, key=rank.get)

    # 2. prefix index: the rarest words of each template
    index, rows = [], []
    for t, (label, words) in enumerate(sets):
        words = sorted(words, key=rank.get)
        need = max(1, ceil(threshold * len(words) - 1e-9))
        rows.append((t, label, words, need, spans[t]))
        index += [(w, t, i, len(words), need) for i, w in enumerate(words[: len(words) - need + 1])]
    prefixes = spark.createDataFrame(index, "word string, template int, i int, size int, need int")
    full = spark.createDataFrame(rows, "template int, label string, words array<string>, need int, span int")
    rare = sorted({w for w, *_ in index})

    # 3. blocks of the texts that hold an indexed word
    spaced = text.select("id", F.xxhash64("text").alias("key"), "text", _spaced(F.col("text")).alias("spaced"))
    order = F.array(*map(F.lit, ordered)) if ordered else F.array().cast("array<string>")
    rare = F.array(*map(F.lit, rare)) if rare else F.array().cast("array<string>")
    near = spaced.where(F.arrays_overlap(_words(F.col("spaced")), rare))
    none = F.array().cast("array<string>")
    blocks = (
        near.select("id", "key", F.explode(F.split("text", "\n")).alias("line"))
        .select("id", "key", F.array_distinct(_words(_spaced(F.col("line")))).alias("set"), none.alias("run"))
    )
    if wrapped and spans:
        reach = max(spans) - 1
        around = lambda e: F.slice("ws", F.greatest(e - reach, F.lit(0)) + 1, F.least(e, F.lit(reach)) + reach)
        blocks = blocks.unionByName(
            near.select("id", "key", _words(F.col("spaced")).alias("ws"), _line_ends(F.col("text")).alias("ends"))
            .select("id", "key", F.explode(F.transform("ends", around)).alias("run"))
            .where(F.arrays_overlap("run", rare))
            .select("id", "key", F.array_distinct("run").alias("set"), "run")
        )
    blocks = blocks.select("id", "key", "run", F.size("set").alias("length"), F.array_intersect(order, F.col("set")).alias("own"))
    candidates = (
        blocks.select("id", "key", "run", "length", "own", F.posexplode("own").alias("j", "word"))
        .join(F.broadcast(prefixes), "word")
        .where("length >= need and 1 + least(size - 1 - i, size(own) - 1 - j) >= need")
        .select("id", "key", "run", "own", "template").distinct()
    )
    # 4. full sets; only template words can be in both
    both = F.when(F.size("run") > 0, _span_share(F.col("run"), F.col("words"), F.col("span"))).otherwise(F.size(F.array_intersect("own", "words")))
    met = (
        candidates.join(F.broadcast(full), "template")
        .select("id", "key", "label", "need", F.size("words").alias("size"), both.alias("both"))
        .where("both >= need")
        .groupBy("id", "key").agg(F.sort_array(F.collect_set("label")).alias("found"), F.max(F.col("both") / F.col("size")).alias("best"))
        .select(F.col("id").alias("met_id"), F.col("key").alias("met_key"), "found", "best")
    )

    # only texts that hold a phrase are cut into words
    holds = [F.contains(F.col("spaced"), F.lit(f" {p} ")) for p, _ in phrases]
    some = F.when(reduce(lambda a, b: a | b, holds, F.lit(False)), _words(F.col("spaced"))).otherwise(F.array().cast("array<string>"))
    places = F.struct(*(_places(F.col("words"), p).alias(f"p{i}") for i, (p, _) in enumerate(phrases)))
    base = spaced.withColumn("words", some).select(
        "id", "key",
        (F.length("spaced") - F.length(F.replace(F.col("spaced"), F.lit(" "), F.lit(""))) - 1).alias("spaces"),
        places.alias("places"),
        (F.trim("spaced") == "").alias("blank"),
    )
    own = F.array_compact(F.array(*(F.when(F.size(f"places.p{i}") > 0, label) for i, (_, label) in enumerate(phrases)))) if phrases else F.array().cast("array<string>")
    return (
        base.join(met, F.col("id").eqNullSafe(F.col("met_id")) & (F.col("key") == F.col("met_key")), "left")
        .select(
            F.col("id").alias(id_col),
            F.when(F.col("blank"), 0).otherwise(F.col("spaces")).cast("long").alias("n_words"),
            "places",
            F.array_sort(F.array_distinct(own)).alias("base_labels"),
            F.coalesce("found", none).alias("found_labels"),
            F.when(F.size(own) > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
        )
    )
