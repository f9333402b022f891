"""Licence scan by a positional index of rare words, in built-in functions only.

Templates are the words of licence notices, each with one key phrase that must stand in
a file for the template to apply. The index lists for each licence word its positions in
the templates. A file is scanned in three steps:

1. Of each template whose key phrase's words the file holds, look up the file's words of
   the highest inverse document frequency. How many documents hold each licence word is
   counted over the whole corpus first; the licence words are a fixed list, so the counts
   are a short list too.
2. Each place of such a word, together with each of its postings, says where the template
   would begin. Equal beginnings are one candidate: the postings are intersected by
   relative position. The places of the template's key phrase say so too, so that a
   notice is also met where its rare words are shifted or stand elsewhere.
3. A candidate counts if its key phrase stands where it should and enough of the
   template's other words do too. The share of them is its score.

Everything but the document frequencies happens within a row; files without licence
words, nearly all, only pay for being split into words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.functions.once import compute_once
from orderlake.llm.text import let

# What separates words (ASCII other than letters and digits), the base
# phrases with their labels, and the templates: label, notice, key phrase.
SEPARATORS = "".join(map(chr, [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
SEPARATOR_CLASS = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
BASE_PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
TEMPLATES = (
    ("mit", "released under the mit license", "the mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files",
        "permission is hereby granted free of charge",
    ),
    (
        "apache-2",
        "licensed under the apache license version 2 0 the license you may not use this file "
        "except in compliance with the license",
        "apache license version 2",
    ),
    (
        "gpl-2",
        "under the terms of the gnu general public license version 2",
        "gnu general public license version 2",
    ),
    (
        "gpl-3",
        "this work is licensed under the gnu general public license version 3",
        "gnu general public license version 3",
    ),
    (
        "gpl",
        "you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation",
        "terms of the gnu general public license",
    ),
    (
        "lgpl",
        "under the terms of the gnu lesser general public license",
        "gnu lesser general public license",
    ),
    (
        "agpl",
        "under the terms of the gnu affero general public license",
        "gnu affero general public license",
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
        "redistribution and use in source and binary forms",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or "
        "without fee is hereby granted",
        "for any purpose with or without fee",
    ),
    (
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        "mozilla public license v 2",
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        "free and unencumbered software",
    ),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    (
        "cc-by",
        "licensed under a creative commons attribution 4 0 international license",
        "creative commons attribution 4 0",
    ),
    ("all-rights-reserved", "all rights reserved", "all rights reserved"),
)


@dataclass(frozen=True)
class ScanLimits:
    #: Words looked up for a template, the rarest first.
    rare_words: int = 2
    #: Share of a template's words that must stand in place.
    least_share: float = 0.5


def license_words() -> list[str]:
    """The words of the templates and base phrases, each once, in order."""
    said = [notice for _, notice, _ in TEMPLATES] + [phrase for _, phrase in BASE_PHRASES]
    return sorted({word for text in said for word in text.split()})


def scan_words(text: Column) -> Column:
    """Words of a text with A-Z in lower case; none for null.

    Other letters are lower-cased too, which no phrase can tell, as all are of ASCII.
    Two of them would become ASCII letters (the Kelvin sign, the capital dotted I); they
    are changed into others first.
    """
    safe = F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u0138"))
    lowered = F.lower(F.replace(safe, F.lit("\u0130"), F.lit("\u0131")))
    bare = F.trim(lowered, F.lit(SEPARATORS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(
        F.split(bare, SEPARATOR_CLASS)
    )


def _strings(words: list[str]) -> Column:
    return F.array(*map(F.lit, words))


def document_frequencies(docs: DataFrame, text_col: str = "text") -> dict[str, int]:
    """Number of rows that hold each licence word; words of no row are left out."""
    known = _strings(license_words())
    held = docs.select(F.explode(F.array_intersect(scan_words(F.col(text_col)), known)).alias("w"))
    return {row.w: row.n for row in held.groupBy("w").agg(F.count("*").alias("n")).collect()}


def _templates(frequency: dict[str, int]) -> Column:
    """The templates as one array; ``rarest`` lists the words by document frequency."""
    rows = []
    for label, notice, phrase in TEMPLATES:
        words, key = notice.split(), phrase.split()
        start = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
        rarest = sorted(set(words), key=lambda w: (frequency.get(w, 0), w))
        rows.append(
            F.struct(
                F.lit(label).alias("label"),
                _strings(words).alias("words"),
                _strings(key).alias("phrase"),
                F.lit(start).alias("start"),
                _strings(rarest).alias("rarest"),
            )
        )
    return F.array(*rows)


def _phrase_at(words: Column, at: Column, phrase: Column) -> Column:
    # slice() counts from one, and from the end if its start is negative.
    return F.when(at >= 0, F.slice(words, at + 1, F.size(phrase)) == phrase).otherwise(False)


def _beginnings(words: Column, template: Column, held: Column, limits: ScanLimits) -> Column:
    """Where the template would begin in the file, by its rarest words that are there."""
    rare = F.slice(
        F.filter(template["rarest"], lambda w: F.array_contains(held, w)), 1, limits.rare_words
    )

    def from_rare(rare: Column) -> Column:
        places = F.filter(
            F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))),
            lambda x: F.array_contains(rare, x["w"]),
        )
        postings = F.filter(
            F.transform(template["words"], lambda w, p: F.struct(w.alias("w"), p.alias("p"))),
            lambda x: F.array_contains(rare, x["w"]),
        )

        def met(postings: Column) -> Column:
            return F.array_distinct(
                F.flatten(
                    F.transform(
                        places,
                        lambda x: F.transform(
                            F.filter(postings, lambda y: y["w"] == x["w"]),
                            lambda y: x["i"] - y["p"],
                        ),
                    )
                )
            )

        return let(postings, met)

    return let(rare, from_rare)


def _phrase_beginnings(words: Column, template: Column) -> Column:
    """Where the template would begin by each place of its key phrase."""
    first = F.filter(
        F.transform(words, lambda w, i: F.when(w == template["phrase"][0], i)),
        lambda i: i.isNotNull(),
    )
    places = F.filter(first, lambda i: _phrase_at(words, i, template["phrase"]))
    return F.transform(places, lambda i: i - template["start"])


def _share(words: Column, template: Column, begin: Column) -> Column:
    equal = F.filter(
        F.transform(
            template["words"],
            lambda w, p: (begin + p >= 0) & (F.get(words, begin + p) == w).eqNullSafe(True),
        ),
        lambda same: same,
    )
    return F.size(equal).cast("double") / F.size(template["words"])


def _found_templates(
    words: Column, held: Column, templates: Column, limits: ScanLimits
) -> Column:
    """(label, share) of each template that the file holds."""
    possible = F.filter(templates, lambda t: F.size(F.array_except(t["phrase"], held)) == 0)

    def best(t: Column) -> Column:
        verified = F.filter(
            F.array_union(_beginnings(words, t, held, limits), _phrase_beginnings(words, t)),
            lambda begin: _phrase_at(words, begin + t["start"], t["phrase"]),
        )
        share = F.array_max(F.transform(verified, lambda begin: _share(words, t, begin)))
        return F.struct(t["label"].alias("label"), share.alias("share"))

    return F.filter(
        F.transform(possible, best), lambda x: (x["share"] >= limits.least_share).eqNullSafe(True)
    )


def _base_places(words: Column, held: Column) -> Column:
    """(label, start) of each base phrase, wherever it stands."""
    found = []
    for label, phrase in BASE_PHRASES:
        key = phrase.split()
        starts = F.filter(F.sequence(F.lit(0), F.size(words) - len(key)), _stands(words, key))
        possible = (F.size(F.array_except(_strings(key), held)) == 0) & (F.size(words) >= len(key))
        places = F.transform(starts, _labelled(label))
        empty = F.array().cast("array<struct<label:string,start:int>>")
        found.append(F.when(possible, places).otherwise(empty))
    return F.flatten(F.array(*found))


def _stands(words: Column, key: list[str]):
    return lambda i: F.slice(words, i + 1, len(key)) == _strings(key)


def _labelled(label: str):
    return lambda i: F.struct(F.lit(label).alias("label"), i.alias("start"))


#: Columns that the scan adds, in this order.
SCAN_COLUMNS = "n_words n_base first_word last_word base_labels labels score".split()


def scan_licenses(
    docs: DataFrame, text_col: str = "text", limits: ScanLimits | None = None
) -> DataFrame:
    """All rows and columns of ``docs`` with SCAN_COLUMNS behind them.

    ``n_base`` counts the places of the base phrases; ``first_word`` and ``last_word``
    are the smallest and the largest number of a word that one begins with, from 0, null
    without any. ``base_labels`` are theirs; ``labels`` adds those of the templates
    found; both distinct, sorted, joined by commas, empty without any. ``score`` is 1
    with a base label, else the largest share of a template's words found, else 0.

    A null text is an empty one and holds nothing. Rows that repeat are scanned one by
    one (and counted so in the document frequencies); keys are not looked at. A column
    of ``docs`` that bears the name of a scan column gives way to it.
    """
    limits = limits or ScanLimits()
    templates = _templates(document_frequencies(docs, text_col))
    known = _strings(license_words())
    passed = docs.drop(*[c for c in SCAN_COLUMNS if c != text_col])

    def scan(words: Column) -> Column:
        return let(
            F.array_intersect(words, known),
            lambda held: F.struct(
                F.size(words).cast("bigint").alias("n_words"),
                _base_places(words, held).alias("base"),
                _found_templates(words, held, templates, limits).alias("more"),
            ),
        )

    found = compute_once(passed, _scan=let(scan_words(F.col(text_col)), scan))
    base, more = F.col("_scan.base"), F.col("_scan.more")
    starts = F.transform(base, lambda x: x["start"])
    base_labels = F.array_distinct(F.transform(base, lambda x: x["label"]))
    labels = F.array_union(base_labels, F.transform(more, lambda x: x["label"]))
    shares = F.array_max(F.transform(more, lambda x: x["share"]))
    return found.select(
        *passed.columns,
        F.col("_scan.n_words").alias("n_words"),
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).cast("bigint").alias("first_word"),
        F.array_max(starts).cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(base_labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(labels), ",").alias("labels"),
        F.when(F.size(base) > 0, 1.0).otherwise(F.coalesce(shares, F.lit(0.0))).alias("score"),
    )
