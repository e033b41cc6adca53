"""License scans: an exact set-similarity join of text blocks with notice templates.

A template's blocks are each line with words and the lines after it, those without
words left out, until the lines after it have as many words as the template: a
notice that begins in a line ends in its block, however it is wrapped or spaced.
The join finds every block with |block & template| >= 0.8 * |template|, over
distinct words.  Words of all templates get one global order, by the number of
documents that have them, rarest first.  A text with a block that meets the
threshold has one of the first |template| - needed + 1 words of the template
(prefix filter) and at least `needed` words (length filter).  With its first shared word
at place p of the template, all before p are missing; every place of a prefix
leaves `needed` template words from it on, so the positional bound can only fail on
the text's side: it must share `needed` words from that place on.  The texts left
are cut into blocks, from lines that share a word with the template, and
verified.  The templates are a fixed list, so their index is literal.  DataFrame
functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Share of a template's distinct words that a block must have, in percent.
CONTAINMENT = 80

#: Phrases and labels of the base scan.
PHRASES = (
    (("cc", "by"), "cc-by"),
    (("general", "public", "license"), "gpl"),
    (("all", "rights", "reserved"), "reserved"),
)

#: Notices of common licenses and their labels.  Of up to four distinct words all are needed, so a short
#: template holds just what names its license; a long notice may lose a fifth of its words.
TEMPLATES = (
    ("apache", "apache license"),
    ("apache-2.0", "apache license version 2"),
    ("mit", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("bsd", "bsd license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("gpl", "gnu general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu"),
    ("gpl-2.0", "gnu public license 2"),
    ("gpl-3.0", "gnu public license 3"),
    ("lgpl", "lesser general public license"),
    ("agpl", "affero general public license"),
    ("mpl-2.0", "mozilla public license 2"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2.0"),
    ("epl-2.0", "eclipse public license 2"),
    ("cc-by-nc", "cc by nc"),
    ("cc-by-nd", "cc by nd"),
    ("cc-by-sa", "cc by sa"),
    ("cc", "creative commons attribution"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights to this work"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose is hereby granted"),
    ("public-domain", "released into the public domain by its author"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("reserved", "all rights reserved"),
)

#: What stands between words once A-Z are in lower case.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)


def words_of(low: Column) -> Column:
    """The words of a text in lower case, in order."""
    return F.filter(F.split(low, SEPARATORS), lambda w: w != "")


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    #: How many words it has, repeated ones too.
    length: int

    @property
    def needed(self) -> int:
        return -(-len(self.words) * CONTAINMENT // 100)

    @property
    def prefix(self) -> tuple[str, ...]:
        return self.words[: len(self.words) - self.needed + 1]


def ordered_templates(frequency: dict[str, int], templates=TEMPLATES) -> list[Template]:
    """Templates with distinct words in the global order, rarest first."""
    import re

    found = []
    for label, text in templates:
        words = [w for w in re.split(SEPARATORS, text) if w]
        ordered = sorted(set(words), key=lambda w: (frequency.get(w, 0), w))
        found.append(Template(label, tuple(ordered), len(words)))
    return found


def word_frequencies(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """For each word of the fixed vocabulary, how many of all documents have it."""
    has = F.array_intersect(F.split(lowered(F.col("text")), SEPARATORS), F.array(*map(F.lit, vocabulary)))
    counts = docs.select(F.explode(has).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return {r["word"]: r["n"] for r in counts.collect()}


def _starts(words: Column, phrase: tuple[str, ...]) -> Column:
    """Where a phrase's words stand consecutively."""
    last = F.size(words) - len(phrase)
    places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))

    def here(i: Column) -> Column:
        match = F.get(words, i) == phrase[0]
        for k, word in enumerate(phrase[1:], 1):
            match = match & (F.get(words, i + k) == word)
        return match

    return F.filter(places, here)


def _block(lines: Column, first: Column, i: Column, length: int) -> Column:
    """The words of line i and of the lines after it, until those have as many words as given."""
    empty = F.struct(first.alias("words"), F.lit(0).alias("after"))

    def add(block: Column, line: Column) -> Column:
        longer = F.struct(F.concat(block["words"], line).alias("words"), (block["after"] + F.size(line)).alias("after"))
        return F.when(block["after"] < length, longer).otherwise(block)

    # no line is without words, so `length` lines are enough
    return F.aggregate(F.slice(lines, i + 2, F.lit(length)), empty, add)["words"]


def _match(words: Column, lines: Column, t: Template) -> Column:
    """(label, containment) of the best block of a text for a template; null without one."""
    own = F.array(*map(F.lit, t.words))
    may = F.arrays_overlap(words, F.array(*map(F.lit, t.prefix)))
    # no word before the first shared place is in the text, so all shared words stand from that place on
    may = (F.size(words) >= t.needed) & may & (F.size(F.array_intersect(words, own)) >= t.needed)
    shared = F.array_max(
        F.transform(lines, lambda line, i: F.when(F.arrays_overlap(line, own), F.size(F.array_intersect(_block(lines, line, i, t.length), own))))
    )
    best = F.when(may, shared)
    return F.when(best >= t.needed, F.struct(F.lit(t.label).alias("label"), (best / len(t.words)).alias("score")))


def scan_licenses(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """License labels of every row.

    docs: doc_id, text and any other columns.  One row per row: doc_id, n_words,
    n_base, first_word, last_word (places of the base phrases; null without one),
    base_labels, labels (distinct, sorted, comma-joined; empty without any) and
    score (1 for a base phrase, else the best containment, 0 without any).  Null
    and empty texts have no words.  Repeated and null doc_ids are rows like any
    others; an empty table gives an empty result.
    """
    vocabulary = sorted({w for t in ordered_templates({}, templates) for w in t.words})
    ordered = ordered_templates(word_frequencies(docs, vocabulary), templates)
    triggers = sorted({w for t in ordered for w in t.prefix})

    low = lowered(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long"), low.alias("low")).withColumn("words", words_of(F.col("low")))
    words = F.col("words")
    separated = "|".join(SEPARATORS.join(phrase) for phrase, _ in PHRASES)
    none = F.array().cast("array<int>")
    base = [F.when(F.col("low").rlike(separated), _starts(words, p)).otherwise(none) for p, _ in PHRASES]
    rows = rows.withColumn("base", F.array(*base))

    trigger = F.arrays_overlap(words, F.array(*map(F.lit, triggers)))
    lines = F.filter(F.transform(F.split(F.col("low"), "\n"), words_of), lambda line: F.size(line) > 0)
    rows = rows.withColumn("lines", F.when(trigger, lines))
    # filters by text need only the words that templates have
    rows = rows.withColumn("known", F.when(trigger, F.array_intersect(words, F.array(*map(F.lit, vocabulary)))))
    found = F.filter(F.array(*[_match(F.col("known"), F.col("lines"), t) for t in ordered]), lambda m: m.isNotNull())
    nothing = F.array().cast("array<struct<label:string,score:double>>")
    rows = rows.withColumn("matched", F.when(F.col("known").isNotNull(), found))
    rows = rows.withColumn("matched", F.coalesce("matched", nothing))

    places = F.flatten("base")
    base_labels = F.filter(
        F.array(*[F.when(F.size(F.col("base")[i]) > 0, F.lit(label)) for i, (_, label) in enumerate(PHRASES)]),
        lambda label: label.isNotNull(),
    )
    best = F.coalesce(F.array_max(F.transform("matched", lambda m: m["score"])), F.lit(0.0))
    return rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base_labels), ",").alias("base_labels"),
        F.array_join(
            F.array_sort(F.array_distinct(F.concat(base_labels, F.transform("matched", lambda m: m["label"])))), ","
        ).alias("labels"),
        F.when(F.size(places) > 0, F.lit(1.0)).otherwise(best).alias("score"),
    )
