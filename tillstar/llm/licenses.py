"""License scans by diagonal voting, in DataFrame operations alone.

Every rolling k-gram of a document's words is hashed and joined to the places where the
templates have it. A match at document word p and template word t votes for the diagonal
p - t; the votes are summed per diagonal, and neighbouring diagonals of one template are
merged (a word put in or left out shifts the rest by one). A merged span is verified word by
word along its diagonals: a word of the template counts that stands where one of them
says, but a word of the text for one at most; a number is met by any number (versions differ). A span is found where enough of
the template is covered, in a stretch not much longer than the template.

Templates resemble each other: a notice covers most of its sister's template as well. Of
spans of different labels that overlap, only the one with the better share of words in
common stays (twice the covered words over the words of template and stretch together; then
the one with more covered words, then the label that is first in order).

Short phrases (`PHRASES`) are templates whose diagonals must have every vote and aren't
merged: each full diagonal is a place of the phrase. They use grams of two words, as do
texts of under `BRIEF` words, the other `TEXTS` grams of four. The table of templates is fixed,
so it is broadcast.

Texts are lower-cased from A to Z, words being runs of anything but ASCII that is neither
letter nor digit. Null and empty texts have no words and no labels; repeated rows each
get their result; an empty table gives an empty one; rows without an id are handled like
all others.
"""

from __future__ import annotations

import re
import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.common import written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: What separates words, before and after lower-casing.
BETWEEN_ANY, BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrase and label.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: The public notices of licenses, and the label each gives.
TEXTS = (
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
)
SHORT, LONG = 2, 4
#: Words from which a text's grams are long.
BRIEF = 20
NUMBER = "^[0-9]+$"
#: Diagonals this close to each other belong to one span.
NEIGHBOURS = 3
COVERAGE = 0.8
STRETCH = 1.25


def words_of(text: str) -> Column:
    """The lower-cased words of a text; null: none."""
    lower = F.translate(F.coalesce(F.col(text), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lower, BETWEEN), "")


def word_count(text: str) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), BETWEEN_ANY), "")).cast("long")


def template_words(text: str) -> list[str]:
    return re.findall(WORD, text.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)))


def gram_size(words: list[str], exact: bool) -> int:
    return SHORT if exact or len(words) < BRIEF else LONG


def _templates(df: DataFrame, phrases, texts) -> DataFrame:
    """A row per template gram: template, its label and words, exact (a phrase), length in
    words, the gram's size, its place and its words."""
    rows = []
    for number, (label, text, exact) in enumerate([*((b, a, True) for a, b in phrases), *((a, b, False) for a, b in texts)]):
        words = template_words(text)
        k = gram_size(words, exact)
        if len(words) < k:
            raise ValueError(f"a template needs {k} words: {text}")
        rows += [(number, label, words, exact, len(words), k, t, words[t : t + k]) for t in range(len(words) - k + 1)]
    table = df.sparkSession.createDataFrame(
        rows, "template int, label string, wanted array<string>, exact boolean, length int, k int, place int, gram array<string>"
    )
    return table.withColumn("hash", F.xxhash64(*[F.get("gram", F.lit(i)) for i in range(LONG)]))


def spans(df: DataFrame, id: str = "doc_id", text: str = "text", phrases=PHRASES, texts=TEXTS) -> DataFrame:
    """Found spans: id, key (a hash of the text), label, exact, start (word), length (words
    spanned) and coverage (share of the template's words)."""
    at = lambda i: F.get("words", F.col("pos") + i)
    rolling = (
        df.select(F.col(id).alias("id"), F.xxhash64(text).alias("key"), words_of(text).alias("words"))
        .select("id", "key", "words", F.posexplode_outer("words").alias("pos", "word"))
        .select("id", "key", "words", "pos", F.explode(F.array(*[F.xxhash64(*[at(i) for i in range(k)]) for k in (SHORT, LONG)])).alias("hash"))
    )
    equal = F.slice("words", F.col("pos") + 1, F.col("k")) == F.col("gram")  # the hash alone could collide
    votes = rolling.join(F.broadcast(_templates(df, phrases, texts)), "hash").where(equal)
    diagonal = F.col("pos") - F.col("place")
    begins_at = F.greatest(diagonal, F.lit(0))
    # The words that the diagonal sets beside the template's, from its first one on that is there.
    beside = F.slice("words", begins_at + 1, F.col("length") + F.least(diagonal, F.lit(0)))
    group = ["id", "key", "template", "label", "exact", "length", "k", "wanted"]
    # Written, as phrases and texts both read it and the texts are to be split once.
    diagonals = written(
        votes.select(*group, "place", diagonal.alias("diagonal"), beside.alias("beside"))
        .groupBy(*group, "diagonal").agg(F.collect_set("place").alias("places"), F.any_value("beside").alias("beside")),
        "diagonals",
    )
    exact = diagonals.where(F.col("exact") & (F.size("places") == F.col("length") - F.col("k") + 1)).select(
        "id", "key", "label", "exact", F.col("diagonal").alias("start"), "length", F.lit(1.0).alias("coverage")
    )
    return exact.union(_best(written(_merged(diagonals.where(~F.col("exact"))), "merged"), phrases, texts))


def _merged(diagonals: DataFrame) -> DataFrame:
    """Spans of neighbouring diagonals that cover enough of their template: id, key, template,
    span, label, start, end, covered (words), coverage and common (the share in common)."""

    def stands(t: Column) -> Column:
        found, wanted = F.get("beside", t + F.least("diagonal", F.lit(0))), F.get("wanted", t)
        return (found == wanted) | (wanted.rlike(NUMBER) & found.rlike(NUMBER))

    verified = diagonals.withColumn("places", F.filter(F.sequence(F.lit(0), F.col("length") - 1), stands))
    in_order = Window.partitionBy("id", "key", "template").orderBy("diagonal")
    begins = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(in_order) > NEIGHBOURS, F.lit(True)).cast("int")
    distinct = lambda words: F.size(F.array_distinct(F.flatten(F.collect_list(words))))
    whole = (
        verified.withColumn("begins", begins).withColumn("span", F.sum("begins").over(in_order))
        .groupBy("id", "key", "template", "span", "label", "length").agg(
            F.least(distinct("places"), distinct(F.transform("places", lambda t: t + F.col("diagonal")))).alias("covered"),
            F.min(F.col("diagonal") + F.array_min("places")).alias("start"),
            F.max(F.col("diagonal") + F.array_max("places") + 1).alias("end"),
        )
    )
    spanned = F.col("end") - F.col("start")
    return whole.where((F.col("covered") / F.col("length") >= COVERAGE) & (spanned <= STRETCH * F.col("length"))).select(
        "id", "key", "template", "span", "label", "start", "end", "covered", (F.col("covered") / F.col("length")).alias("coverage"),
        (2 * F.col("covered") / (F.col("length") + spanned)).alias("common"),
    )


def _best(found: DataFrame, phrases, texts) -> DataFrame:
    """Without the spans that a better one of another label overlaps. Spans that overlap share
    a stretch of `grid` words, so only spans of one stretch are compared."""
    grid = int(STRETCH * max((len(template_words(t)) for _, t in texts), default=1)) + 1
    named = ["id", "key", "template", "span"]
    placed = found.withColumn("cell", F.explode(F.array_distinct(F.array(
        F.floor(F.col("start") / grid), F.floor((F.col("end") - 1) / grid)
    ))))
    a, b = (placed.select(*[F.col(c).alias(f"{side}_{c}") for c in placed.columns]) for side in "ab")
    left, right = (lambda c: F.col(f"a_{c}")), (lambda c: F.col(f"b_{c}"))
    worse = (
        (left("common") < right("common")) | (left("common") == right("common"))
        & ((left("covered") < right("covered")) | (left("covered") == right("covered")) & (left("label") > right("label")))
    )
    beaten = a.join(b, (
        left("id").eqNullSafe(right("id")) & (left("key") == right("key")) & (left("cell") == right("cell")) & (left("label") != right("label"))
        & (left("start") < right("end")) & (right("start") < left("end")) & worse
    ), "left_semi").select(*[left(c).alias(f"x_{c}") for c in named]).distinct()
    same = F.col("id").eqNullSafe(F.col("x_id"))
    for c in named[1:]:
        same &= F.col(c) == F.col(f"x_{c}")
    return found.join(beaten, same, "left_anti").select(
        "id", "key", "label", F.lit(False).alias("exact"), "start", (F.col("end") - F.col("start")).alias("length"), "coverage"
    )


def scan(df: DataFrame, id: str = "doc_id", text: str = "text", phrases=PHRASES, texts=TEXTS) -> DataFrame:
    """One row per row of `df`: id, n_words, n_base (places of phrases), first_word and
    last_word (their smallest and largest start), base_labels and labels (distinct, sorted,
    comma-joined; labels holds those of texts too) and score (the best coverage)."""
    found = written(spans(df, id, text, phrases, texts), "spans")
    joined = lambda labels: F.array_join(F.array_sort(F.collect_set(labels)), ",")
    start = F.when(F.col("exact"), F.col("start")).cast("long")
    each = found.groupBy(F.col("id").alias("of"), F.col("key").alias("of_key")).agg(
        F.count(start).alias("n_base"), F.min(start).alias("first_word"), F.max(start).alias("last_word"),
        joined(F.when(F.col("exact"), F.col("label"))).alias("base_labels"), joined("label").alias("labels"),
        F.max("coverage").alias("score"),
    )
    rows = df.select(F.col(id).alias("id"), F.xxhash64(text).alias("key"), word_count(text).alias("n_words"))
    none = F.lit("")
    return rows.join(each, F.col("id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("of_key")), "left").select(
        F.col("id").alias(id), "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", none).alias("base_labels"), F.coalesce("labels", none).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
