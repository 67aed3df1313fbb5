"""License scans by a positional index of rare words, in DataFrame functions.

The words of all license templates form a small fixed vocabulary.  One pass
over the files counts in how many of them each vocabulary word occurs.  In each
file the ``ANCHORS`` words of highest inverse document frequency among those it
holds of a template are its anchors: their positions minus their positions in
the template propose starts, which are intersected, give or take the template's
slack: a start that a rarer anchor proposes too (or the only anchor's, where no
more are held) is kept where the mandatory key phrases stand word by word and at least
half of the template's words stand in their places.  A file that lacks a word of a key
phrase cannot hold the template and is not looked at further.
Everything after the counts happens inside a file's own row: no shuffle.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANCHORS = 8
MIN_SHARE = 0.5


@dataclass(frozen=True)
class Template:
    """``slack``: how many words a position may be off, 0 for exact phrases."""

    label: str
    text: str
    keys: tuple[str, ...]
    slack: int = 3
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    def key_positions(self) -> list[tuple[int, list[str]]]:
        padded = f" {self.text} "
        return [(padded[:padded.index(f" {k} ")].count(" "), k.split()) for k in self.keys]


def _phrase(label: str, text: str) -> Template:
    return Template(label, text, (text,), slack=0, base=True)


# The base phrases and their labels.
BASE_TEMPLATES = (
    _phrase("mit", "under the mit license"),
    _phrase("apache-2", "apache license version 2"),
    _phrase("cc-by-nc", "cc by nc"),
)

# Notices of public licenses, lower case without punctuation.
MORE_TEMPLATES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of "
             "this software and associated documentation files",
             ("permission is hereby granted free of charge",)),
    Template("apache-2", "you may not use this file except in compliance with the license you may "
             "obtain a copy of the license at http www apache org licenses license 2 0",
             ("except in compliance with the license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification "
             "are permitted provided that the following conditions are met",
             ("redistribution and use in source and binary forms",)),
    Template("gpl", "this program is free software you can redistribute it and or modify it under "
             "the terms of the gnu general public license as published by the free software foundation",
             ("gnu general public license",)),
    Template("gpl-3", "licensed under the gnu general public license version 3",
             ("gnu general public license version 3",)),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license "
             "v 2 0", ("mozilla public license",)),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license",
             ("creative commons attribution 4 0 international",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             ("free and unencumbered software",)),
    Template("all-rights-reserved", "all rights reserved", ("all rights reserved",), slack=0),
)
TEMPLATES = BASE_TEMPLATES + MORE_TEMPLATES


def words(text: Column) -> Column:
    """Words of a text in lower case.  Only ASCII words are ever compared, so
    lower-casing other letters too changes nothing."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), _SEPARATORS), "")


def _literals(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def document_frequencies(docs: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """(files, files per vocabulary word): one row per vocabulary word."""
    own = docs.select(F.array_intersect(words(F.col("text")), _literals(vocabulary)).alias("w"))
    rows = own.select(F.explode(F.array_append("w", F.lit(""))).alias("word")) \
        .groupBy("word").agg(F.count("*").alias("n")).collect()
    found = {r["word"]: r["n"] for r in rows}
    return found.pop("", 0), found


def ranked(template: Template, files: int, frequencies: dict[str, int]) -> list[str]:
    """The template's words that any file holds, of highest inverse document
    frequency first."""
    idf = {w: math.log((files + 1) / (frequencies[w] + 1))
           for w in template.words if frequencies.get(w)}
    return sorted(idf, key=lambda w: (-idf[w], w))


def _near(word: Column, at: Column, slack: int) -> Column:
    """Whether ``word`` stands within ``slack`` words of position ``at``."""
    if not slack:
        return F.coalesce(F.get("words", at) == word, F.lit(False))
    first = F.greatest(at - slack, F.lit(0))
    return (at + slack >= 0) & F.array_contains(
        F.slice("words", first + 1, F.greatest(at + slack + 1 - first, F.lit(0))), word)


def _stands_at(phrase: list[str], at: Column, slack: int) -> Column:
    def exact(start: Column) -> Column:
        return (start >= 0) & (F.slice("words", F.greatest(start, F.lit(0)) + 1, len(phrase))
                               == _literals(phrase))

    if not slack:
        return exact(at)
    return F.exists(F.sequence(at - slack, at + slack), exact)


def _starts(template: Template, order: list[str]) -> Column:
    """Verified starts of a template in a file (``words``, ``held``)."""
    nothing = F.array().cast("array<int>")
    needed = sorted({w for k in template.keys for w in k.split()})
    if not set(needed) <= set(order):  # no file holds the key phrases
        return nothing
    postings = defaultdict(list)
    for i, w in enumerate(template.words):
        postings[w].append(i)
    places = F.create_map(*[c for w in order for c in (F.lit(w), F.array(*map(F.lit, postings[w])))])

    def proposed(word: Column) -> Column:
        """Starts at which ``word`` would stand in place."""
        at = F.filter(F.transform("words", lambda w, i: F.when(w == word, i)), lambda i: i.isNotNull())
        return F.array_distinct(F.flatten(F.transform(at, lambda a: F.transform(
            F.element_at(places, word), lambda i: a - i))))

    if template.slack == 0:
        # An exact phrase holds its rarest word.
        starts = proposed(F.lit(next(w for w in order if w in needed)))
    else:
        # The file's own rare words, of highest inverse document frequency: a
        # start counts if a rarer one has proposed it too, or if there is one
        # word only.
        own = F.slice(F.filter(_literals(order), lambda w: F.array_contains("held", w)), 1, ANCHORS)

        def agree(state: Column, word: Column) -> Column:
            found = proposed(word)
            around = F.flatten(F.transform(found, lambda s: F.sequence(s - template.slack, s + template.slack)))
            return F.struct(F.array_union(state["around"], around).alias("around"),
                            F.array_union(state["agreed"], F.array_intersect(found, state["around"])).alias("agreed"))

        both = F.aggregate(own, F.struct(nothing.alias("around"), nothing.alias("agreed")), agree,
                           lambda state: state["agreed"])
        starts = F.when(F.size(own) == 1, proposed(F.get(own, F.lit(0)))).otherwise(both)

    def verified(found: Column, at: int, phrase: list[str]) -> Column:
        return F.filter(found, lambda s: _stands_at(phrase, s + at, template.slack))

    for at, phrase in template.key_positions():
        starts = verified(starts, at, phrase)
    if template.slack:
        starts = F.filter(starts, lambda s: _in_place(template, s) >= MIN_SHARE)
    return F.when(F.size(F.array_except(_literals(needed), "held")) == 0, starts).otherwise(nothing)


def _in_place(template: Template, start: Column) -> Column:
    """Share of the template's words that stand in place."""
    own = template.words
    return F.size(F.filter(
        F.sequence(F.lit(0), F.lit(len(own) - 1)),
        lambda j: _near(F.get(_literals(own), j), start + j, template.slack))) / F.lit(len(own))


def _share(template: Template, starts: Column) -> Column:
    """Largest share of the template's words found in place; null: no start."""
    if template.slack == 0:
        return F.when(F.size(starts) > 0, 1.0)
    return F.array_max(F.transform(starts, lambda s: _in_place(template, s)))


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score) for every row of ``docs``.

    Null and empty texts have no words and no labels, score 0; equal rows
    give equal rows; an empty table gives an empty result; other columns are
    not read.
    """
    vocabulary = sorted({w for t in templates for w in t.words})
    files, frequencies = document_frequencies(docs, vocabulary)
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       words(F.col("text")).alias("words"))
    read = read.withColumn("held", F.array_intersect("words", _literals(vocabulary)))
    found = read.select("doc_id", "words", F.size("words").cast("long").alias("n_words"), *[
        _starts(t, ranked(t, files, frequencies)).alias(f"s{k}") for k, t in enumerate(templates)])
    base = [k for k, t in enumerate(templates) if t.base]
    places = F.concat(*[F.col(f"s{k}") for k in base])

    def labels(which: list[int]) -> Column:
        present = F.array(*[F.when(F.size(f"s{k}") > 0, F.lit(templates[k].label)) for k in which])
        return F.array_join(F.array_sort(F.array_distinct(F.array_compact(present))), ",")

    shares = [F.coalesce(_share(t, F.col(f"s{k}")), F.lit(0.0)) for k, t in enumerate(templates)]
    return found.select(
        "doc_id", "n_words", F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        labels(base).alias("base_labels"), labels(list(range(len(templates)))).alias("labels"),
        F.greatest(*shares).alias("score"))
