"""License scans: an exact set-similarity join of text blocks with license templates, and fixed phrases."""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from article_warehouse.llm.common import stored, text_of

# A word: no ASCII character but digits and letters. Fixed value.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Sentences that licenses are stated with, and the labels of the method.
TEMPLATES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "this work is licensed under a creative commons attribution license": "creative-commons",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "this program is free software you can redistribute it and or modify it": "gpl-notice",
    "no part of this publication may be reproduced without permission": "no-reproduction",
}
# A character that is not in a word.
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
# Two line ends without a word in between.
BREAKS = rf"\n{_GAP}*\n"
# Stands for a line without words among the words of a text. No text is meant to hold this code point.
BREAK = "\ufdd0"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: Column) -> Column:
    """``text`` with A-Z as lower case.

    Letters beyond ASCII may change to others beyond ASCII, which tells no two words apart here. Only the
    Kelvin sign would become one of ASCII; a text with it is translated letter by letter.
    """
    return F.when(text.contains("\u212a"), F.translate(text, _UPPER, _LOWER)).otherwise(F.lower(text))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lowered(text), f"{_GAP}+"), "")


def _texts(words: list[str]) -> Column:
    return F.array(*map(F.lit, words))


def template_index(docs: DataFrame, templates: dict[str, str], threshold: float) -> list[tuple[str, list[str], int, int]]:
    """Of each template its label, its words from the rarest to the most frequent, the words that a match shares, its length.

    The order is that of the number of documents that have the word, over all of ``docs``.
    """
    vocabulary = sorted({word for text in templates for word in text.split()})
    found = F.array_intersect(words_of(text_of()), _texts(vocabulary))
    counts = docs.select(F.explode(found).alias("word")).groupBy("word").count()
    # At most one row per word of the templates.
    frequency = {row["word"]: row["count"] for row in counts.collect()}
    index = []
    for text, label in templates.items():
        words = sorted(set(text.split()), key=lambda w: (frequency.get(w, 0), w))
        index.append((label, words, math.ceil(threshold * len(words) - 1e-9), len(text.split())))
    every = {word for text in templates for word in text.split()}
    return index, sorted(every, key=lambda w: (frequency.get(w, 0), w))


def window_length(span: int, threshold: float) -> int:
    """Words of a text block that is compared with a template of ``span`` words: room for what a share of ``threshold`` leaves."""
    return math.ceil(span / threshold - 1e-9)


def text_blocks(words: Column, starts: list[str], most: int) -> Column:
    """Of each place in ``words`` with one of the words ``starts``: the word, up to ``most`` - 1 words before it and up to
    ``most`` from there on, all within lines that follow each other without a ``BREAK``."""

    def until_break(listed: Column) -> Column:
        stop = F.array_position(listed, BREAK).cast("int")
        return F.when(stop > 0, F.slice(listed, F.lit(1), F.greatest(stop - 1, F.lit(0)))).otherwise(listed)

    def block(i: Column) -> Column:
        first = F.greatest(i - most + 1, F.lit(0))
        return F.struct(
            F.get(words, i).alias("word"),
            F.reverse(until_break(F.reverse(F.slice(words, first + 1, i - first)))).alias("before"),
            until_break(F.slice(words, i + 1, F.lit(most))).alias("after"),
        )

    known = _texts(starts)
    every = F.transform(words, lambda word, i: F.when(F.array_contains(known, word), i))
    return F.transform(F.array_compact(every), block)


def template_matches(blocks: DataFrame, index: list[tuple[str, list[str], int, int]], order: list[str], threshold: float) -> DataFrame:
    """Every pair of a text and a template of which some block of the text has the words that a match needs.

    A block is any ``window_length`` words in a row. ``blocks`` has row_id, word, before and after: a place of a
    template's rare word, with the words around it that blocks with this place can have. ``order`` has all words of the
    templates, the rarest first.
    Columns: row_id, label, containment (largest share of the template's distinct words in a block).
    The join is on words: a block that matches shares a word with the template's prefix, its rarest words, as
    those that may be missing are one fewer. Each pair need only be found at the rarest word that both share. Pairs are left out if there are too few distinct words around the place (length
    filter), or if fewer words that are more frequent than the shared one are in the template, or around the place, than a
    match still needs (positional filter). The pairs that are left are compared block by block.
    """
    spark = blocks.sparkSession
    ranked = spark.createDataFrame(_prefixes(index), "word string, template int, place int")
    sets = spark.createDataFrame(
        [(i, label, words, need, window_length(span, threshold)) for i, (label, words, need, span) in enumerate(index)],
        "template int, label string, wanted array<string>, need int, width int",
    )
    # Both are as large as the given templates.
    probes = ranked.join(sets, "template")
    known = _texts(order)
    some = blocks.join(F.broadcast(probes), "word")
    before = F.reverse(F.slice(F.reverse("before"), F.lit(1), F.col("width") - 1))
    near = some.select("row_id", "label", "word", "wanted", "need", "width", "place", F.concat(before, F.slice("after", F.lit(1), F.col("width"))).alias("words"))
    long_enough = near.where(F.size(F.array_distinct("words")) >= F.col("need"))
    # Words of any template around the place, by their ranks, and the place's own among them.
    ranks = F.transform(F.array_intersect("words", known), lambda word: F.array_position(known, word))
    own = F.array_position(known, F.col("word"))
    behind = F.least(F.size("wanted") - F.col("place") - 1, F.size(F.filter(ranks, lambda rank: rank > own)))
    possible = long_enough.where(behind + 1 >= F.col("need"))

    def shared(i: Column) -> Column:
        return F.size(F.array_intersect(F.slice("words", i + 1, F.col("width")), F.col("wanted")))

    best = F.array_max(F.transform(F.sequence(F.lit(0), F.greatest(F.size("words") - F.col("width"), F.lit(0))), shared))
    compared = possible.select("row_id", "label", "wanted", "need", best.alias("shared")).where("shared >= need")
    return compared.select("row_id", "label", (F.col("shared") / F.size("wanted")).alias("containment"))


def _prefixes(index: list[tuple[str, list[str], int, int]]) -> list[tuple[str, int, int]]:
    return [(w, i, at) for i, (_, words, need, _) in enumerate(index) for at, w in enumerate(words[: len(words) - need + 1])]


def _places(words: Column, phrase: str) -> Column:
    """Where the words of ``phrase`` stand one after the other."""
    parts = phrase.split()

    def stands(i: Column) -> Column:
        whole = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            whole = whole & (F.get(words, i + k) == part)
        return whole

    none = F.array().cast("array<int>")
    return F.when(F.size(words) >= len(parts), F.filter(F.sequence(F.lit(0), F.size(words) - len(parts)), stands)).otherwise(none)


def license_scan(
    docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES, threshold: float = 0.8
) -> DataFrame:
    """Licenses that each whole text states, by fixed phrases and by similarity to templates.

    Columns: doc_id, n_words, n_base (places of phrases), first_word and last_word (where the first and the last
    place begin, null without any), base_labels, labels (with those of the templates; distinct, sorted, comma-joined),
    score (1 with a phrase, else the highest containment of a template that matches, else 0). A template matches a text
    if ``threshold`` of its distinct words are in one block of the text, that is ``window_length`` words in a row, on one line
    or on lines without an empty one between them. Null and empty texts have no words and no labels.
    """
    index, order = template_index(docs, templates, threshold)
    starts = sorted({word for word, *_ in _prefixes(index)})
    in_phrases = [word for phrase in phrases for word in phrase.split()]
    nothing = F.array().cast("array<string>")
    wanted = {word for _, words, *_ in index for word in words}
    taken_apart = docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", text_of().alias("text"), words_of(text_of()).alias("words"))
    parts = taken_apart.select("*", F.array_intersect("words", _texts(sorted({*wanted, *in_phrases}))).alias("hits"))
    # Only texts that have all words of a phrase are searched for it, and only texts that have the words which a match
    # of some template needs are searched for blocks.
    enough = [F.size(F.array_intersect("hits", _texts(words))) >= need for _, words, need, _ in index]
    places = {
        f"places_{i}": F.when(F.size(F.array_except(_texts(phrase.split()), F.col("hits"))) == 0, _places(F.col("words"), phrase)).otherwise(
            F.array().cast("array<int>")
        )
        for i, phrase in enumerate(phrases)
    }
    rows = stored(
        parts.select(
            "row_id",
            "doc_id",
            F.size("words").cast("long").alias("n_words"),
            F.when(reduce(or_, enough, F.lit(False)), words_of(F.regexp_replace("text", BREAKS, f" {BREAK} "))).otherwise(nothing).alias("marked"),
            *[column.alias(name) for name, column in places.items()],
        )
    )
    most = max((window_length(span, threshold) for *_, span in index), default=1)
    blocks = rows.select("row_id", F.explode(text_blocks(F.col("marked"), starts, most)).alias("block")).select("row_id", "block.*")
    matches = template_matches(blocks, index, order, threshold)
    matched = matches.groupBy("row_id").agg(F.collect_set("label").alias("matched"), F.max("containment").alias("containment"))
    found = rows.join(matched, "row_id", "left")
    every = F.concat(*places)
    base = F.array_compact(F.array(*[F.when(F.size(c) > 0, F.lit(label)) for c, label in zip(places, phrases.values(), strict=True)]))
    return found.select(
        "doc_id",
        "n_words",
        F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.coalesce("matched", nothing))), ",").alias("labels"),
        F.when(F.size(every) > 0, F.lit(1.0)).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
    )
