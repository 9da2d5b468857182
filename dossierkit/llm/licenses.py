"""Licence notices in texts: phrase places, and text blocks that contain a notice template.

Blocks are found by an exact set-similarity join: a block (a line of a text, as the set of its
words) is joined with every template of which it holds at least ``threshold`` of the distinct
words. Words are ordered from rare to frequent over all blocks. A block that reaches the
threshold must hold one of a template's first ``size - needed + 1`` words in that order (prefix
filter), must have ``needed`` words at all (length filter), and what follows the first common
word on either side must suffice (positional filter). What passes is counted in full.

Notices that are wrapped over lines are found by the same join and filters with whole texts as
blocks. What passes is counted window by window: a notice is a run of words, at most ``SPREAD``
times as long as the template and wherever its lines end, that reaches the threshold and holds the
words of the label that the template has, which tell it from its neighbours.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossierkit.llm.shared import quoted, string_array, without

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Usual wordings of notices. A template's label is what stands before the slash.
TEMPLATES = {
    "gpl-3.0/work": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0/program": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version."
    ),
    "apache-2.0/short": "Licensed under the Apache License, Version 2.0.",
    "cc-by-nc-4.0/short": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0/work": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "mit/short": "Released under the MIT License.",
    "mit/grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files"
    ),
    "bsd/grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"
    ),
    "mpl-2.0/form": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
    ),
}
THRESHOLD = 0.8
MOST_TEMPLATE_WORDS = 10_000
# Words of a window over words of its template.
SPREAD = 2

# Fixed value: what stands between words, with A to Z counted as letters.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def spaced_words(text: str) -> str:
    """SQL: the words of a text, letters as they are, with one space between; null is empty."""
    return f"trim(regexp_replace(coalesce({text}, ''), {quoted(BETWEEN)}, ' '))"


def word_list(spaced: str) -> str:
    """SQL: array of words with A to Z in lower case; no words, no elements."""
    return f"if({spaced} = '', cast(array() as array<string>), split(translate({spaced}, '{UPPER}', '{LOWER}'), ' '))"


def words_of(text: str) -> list[str]:
    """The same in Python, for templates and phrases."""
    return re.sub(BETWEEN, " ", text).strip().translate(str.maketrans(UPPER, LOWER)).split(" ")


def phrase_places(df: DataFrame, text: str, phrases: Mapping[str, str] = PHRASES) -> DataFrame:
    """All rows with ``n_words`` and ``places``: (start, label) of every phrase, by start.

    Starts count words from 0. Row by row, without a shuffle; only a text that holds the rarest
    (longest) word of a phrase as a piece of text is cut into words. Null and empty texts have 0
    words and no places. Columns of ``df`` that have a result's name are replaced.
    """
    kept = without(df.withColumn("_spaced", F.expr(spaced_words(f"`{text}`"))), "n_words", "places", "_words")
    lengths = "length(_spaced) - length(replace(_spaced, ' ', '')) + 1"
    rows = kept.withColumn("n_words", F.expr(f"cast(if(_spaced = '', 0, {lengths}) as bigint)"))
    cut = [(words_of(p), label) for p, label in phrases.items()]
    guards = sorted({max(words, key=len) for words, _ in cut if len(max(words, key=len)) > 3})
    guards += sorted({" ".join(words) for words, _ in cut if len(max(words, key=len)) <= 3})
    guard = " OR ".join(f"contains(lower(_spaced), {quoted(g)})" for g in guards)
    rows = rows.withColumn("_words", F.expr(f"if({guard}, {word_list('_spaced')}, cast(array() as array<string>))"))
    found = []
    for words, label in cut:
        same = " AND ".join(f"get(_words, i + {k}) = {quoted(w)}" for k, w in enumerate(words))
        starts = f"filter(sequence(0, size(_words) - 1), i -> {same})"
        found.append(
            f"if(array_contains(_words, {quoted(words[0])}), "
            f"transform({starts}, i -> struct(cast(i as bigint) AS start, {quoted(label)} AS label)), "
            "cast(array() as array<struct<start: bigint, label: string>>))"
        )
    return rows.withColumn("places", F.expr(f"array_sort(concat({', '.join(found)}))")).drop("_spaced", "_words")


def _lines(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(f"`{key}`").alias("_key"), F.posexplode(F.split(F.col(f"`{text}`"), "\n")).alias("block", "line"))


def _whole(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(f"`{key}`").alias("_key"), F.lit(0).alias("block"), F.col(f"`{text}`").alias("line"))


def _blocks(parts: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """Blocks that hold a template word: key, block number, text, number of distinct words, template words."""
    # An outer explode, as filters on its result are not pushed down: they would work the words out again.
    known = f"array_intersect(w, {string_array(vocabulary)})"
    seen = f"transform(transform(array({spaced_words('line')}), s -> {word_list('s')}), w -> struct({known} AS known, size(array_distinct(w)) AS n_distinct))"
    return parts.select("*", F.explode_outer(F.expr(seen)).alias("_seen")).select("_key", "block", "line", "_seen.*").filter("size(known) > 0")


def _order(blocks: DataFrame, vocabulary: Sequence[str]) -> list[str]:
    """Template words from rare to frequent by the number of blocks that hold them.

    Counted over all blocks; one row per template word comes back, which the templates bound.
    """
    counts = blocks.select(F.explode("known").alias("word")).groupBy("word").count().collect()
    by_word = {r["word"]: r["count"] for r in counts}
    return sorted(vocabulary, key=lambda w: (by_word.get(w, 0), w))


def _containing(parts: DataFrame, templates: Mapping[str, str], threshold: float) -> DataFrame:
    """Pairs of a part (``_key, block, line``) and a ``template``, with ``words, size, needed, _common``."""
    sets = {name: sorted(set(words_of(t)) - {""}) for name, t in templates.items()}
    vocabulary = sorted({w for words in sets.values() for w in words})
    if not 0 < threshold <= 1 or not all(sets.values()) or len(vocabulary) > MOST_TEMPLATE_WORDS:
        raise ValueError("0 < threshold <= 1, and templates of 1 to 10,000 words altogether")
    blocks = _blocks(parts, vocabulary)
    order = _order(blocks, vocabulary)
    rank = {w: i for i, w in enumerate(order)}
    spark = parts.sparkSession
    prefixes = []
    for name, words in sets.items():
        ordered = sorted(words, key=rank.__getitem__)
        needed = math.ceil(round(threshold * len(ordered), 9))
        for place, word in enumerate(ordered[: len(ordered) - needed + 1]):
            prefixes.append((word, name, place, len(ordered), needed, ordered))
    schema = "word string, template string, place int, size int, needed int, words array<string>"
    index = spark.createDataFrame(prefixes, schema)
    starters = string_array(sorted({p[0] for p in prefixes}))
    ranked = f"filter({string_array(order)}, w -> array_contains(known, w))"
    entries = (
        blocks.filter(F.expr(f"arrays_overlap(known, {starters})"))
        .withColumn("known", F.expr(ranked))
        .select("_key", "block", "line", "n_distinct", "known", F.explode(F.expr(f"array_intersect(known, {starters})")).alias("word"))
    )
    # One row per prefix word, at most the number of template words.
    pairs = entries.join(F.broadcast(index), "word").filter("n_distinct >= needed")
    at = "array_position(known, word) - 1"
    room = f"place = 0 OR NOT arrays_overlap(slice(words, 1, place), known)"
    pairs = pairs.filter(room)  # the template's first common word stands for the pair
    pairs = pairs.filter(f"1 + least(size - place - 1, size(known) - ({at}) - 1) >= needed")
    common = F.expr("size(array_intersect(known, words))")
    return pairs.withColumn("_common", common).filter("_common >= needed")


def license_blocks(
    df: DataFrame, key: str, text: str, templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """Every block that contains a template: ``key, block, line, template, containment``.

    ``containment`` is the number of common distinct words over the template's distinct words. One
    row per block and template that reach ``threshold``. Null and empty texts and blocks without
    words have none; repeated rows give repeated results. No shuffle of texts.
    """
    verified = _containing(_lines(df, key, text), templates, threshold)
    return verified.select(
        F.col("_key").alias(key), "block", "line", "template", (F.col("_common") / F.col("size")).alias("containment")
    )


def license_notices(
    df: DataFrame, key: str, text: str, templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """Every text and template of which it holds a notice: ``key, template, containment``.

    A notice is a run of words of the text, wherever its lines end, of at most ``SPREAD`` times the
    template's words, that holds ``threshold`` of its distinct words, among them those of the label
    that the template has. ``containment`` is that of the best run. Null and empty texts have none;
    repeated rows give repeated results. No shuffle of texts.
    """
    verified = _containing(_whole(df, key, text), templates, threshold)
    spans = {name: SPREAD * len([w for w in words_of(t) if w]) for name, t in templates.items()}
    names = {name: sorted(set(words_of(name.split("/")[0])) & set(words_of(t))) for name, t in templates.items()}
    span = "CASE template " + " ".join(f"WHEN {quoted(n)} THEN {w}" for n, w in spans.items()) + " END"
    own = "CASE template " + " ".join(f"WHEN {quoted(n)} THEN {string_array(w)}" for n, w in names.items()) + " END"
    placed = verified.withColumn("_span", F.expr(span)).withColumn("_own", F.expr(own))
    placed = placed.withColumn("_spaced", F.expr(spaced_words("line"))).withColumn("_words", F.expr(word_list("_spaced")))
    # One pass over the words: where each word of the template stood last tells what the window that
    # ends here holds. Besides the words themselves nothing grows with the text.
    last = "transform(s.last, (x, k) -> if(k = p - 1, s.i, x))"
    held = "size(filter(last, x -> x > s.i - _span))"
    owned = "forall(_own, o -> get(last, cast(array_position(words, o) as int) - 1) > s.i - _span)"
    seen = f"transform(array({last}), last -> struct(s.i + 1L AS i, last, greatest(s.best, if({owned}, {held}, 0)) AS best))"
    step = f"if(p = 0, struct(s.i + 1L AS i, s.last AS last, s.best AS best), get({seen}, 0))"
    start = f"struct(0L AS i, array_repeat({-(1 << 40)}L, size(words)) AS last, 0 AS best)"
    at = "transform(_words, w -> array_position(words, w))"
    best = f"nullif(aggregate({at}, {start}, (s, p) -> {step}, s -> if(s.best >= needed, s.best, 0)), 0)"
    # A filter on the best window itself would be pushed down and work it out twice.
    found = placed.select("_key", "template", "size", F.explode_outer(F.expr(f"array({best})")).alias("_best"))
    found = found.filter("_best IS NOT NULL")
    return found.select(F.col("_key").alias(key), "template", (F.col("_best") / F.col("size")).alias("containment"))


def label_of(template: Column) -> Column:
    """A template's label: its name up to the slash."""
    return F.substring_index(template, "/", 1)
