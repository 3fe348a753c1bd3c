"""Operator 9: licence scans by the Dice coefficient of word bigrams.

Texts and licence templates are cut into passages and normalised: lower case, words of letters and digits. A
text is cut in three ways, and all the passages count: into lines and the sentences within them; into sentences
that run on over line ends, up to a line without words; and likewise, with a cut after each colon too. Marks at
the start of a line are no words, and ``dnl`` and ``rem`` there, which open comments, are taken away, so a notice
wrapped in comments has the same passages as an unwrapped one. A passage matches a template passage when the Dice coefficient of their
sets of word bigrams, 2 * common / (size + size), reaches ``threshold`` (a passage of one word has that word
as its only bigram). A document has a licence when at least ``coverage`` of the template's passages are
matched; its score is the mean, over the template's passages, of their best Dice values.

Candidates are pruned without loss. Sizes: the coefficient can only reach the threshold if the larger set is at
most (2 - threshold) / threshold times the smaller. Words: of a template passage's bigrams more than
``size - needed`` must hold a common one, so a passage without any of the words of such a choice of
bigrams is out; the test is one pattern over the text. Only what is left is cut into bigrams, which
meet the templates' in a join with that fixed, small table.

Null and empty texts have no licence. Every row gets a result; repeated rows get equal ones. Rows are told
apart by ``keys``; rows that agree in them are read as one document, whose passages are those of all its rows, equal ones once.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PASSAGE_END = r"\n|(?<=[.!?])[ \t]+"

# Over line ends: a line without words ends a passage, a line end only after a sentence (or colon).
BLOCK_END = r"\n[^A-Za-z0-9\n]*(?=\n)|(?<=[.!?])(?:[ \t]+|[^A-Za-z0-9\n.!?:]*\n)"
CLAUSE_END = BLOCK_END.replace("[.!?]", "[.!?:]")
COMMENT_WORD = r"(?im)^[ \t]*(?:dnl|rem)(?=[ \t\r\n])"

# Public licence notices and the openings of public licence texts, by SPDX identifier.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0."],
    "Apache-2.0-notice": [
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
        "See the License for the specific language governing permissions and limitations under the License."],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:"],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "CC0-1.0": ["To the extent possible under law, the author has dedicated all copyright and related and "
                "neighboring rights to this software to the public domain worldwide."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3."],
    "GPL-3.0-notice": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "MIT": ["Released under the MIT License."],
    "MIT-text": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software."],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "all-rights-reserved": ["All rights reserved."],
}


def template_passages(templates: dict[str, list[str]]) -> list[tuple[str, int, int, frozenset[str]]]:
    """(licence, its number of passages, passage number, bigrams) of each template passage."""
    out = []
    for name, texts in sorted(templates.items()):
        passages = [b for t in texts for p in re.split(PASSAGE_END, t) if (b := bigrams(p))]
        out += [(name, len(passages), k, b) for k, b in enumerate(passages)]
    return out


def bigrams(passage: str) -> frozenset[str]:
    words = re.findall(r"[a-z0-9]+", re.sub(r"[A-Z]", lambda m: m[0].lower(), passage))
    return frozenset(f"{a} {b}" for a, b in zip(words, words[1:])) if len(words) > 1 else frozenset(words)


def least_common(size: int, threshold: float) -> int:
    """The fewest common bigrams with which a passage can reach the threshold against a set of this size."""
    return max(1, math.ceil(threshold * size / (2 - threshold) - 1e-9))


def anchor_words(passages, threshold: float) -> list[str]:
    """Words one of which every matching passage holds: for each template passage, the longer words of as many
    bigrams as cannot all be missing, those with the longest words (the rarest, as a rule)."""
    seen = Counter(w for _, _, _, b in passages for g in b for w in set(g.split(" ")))
    anchors = set()
    for _, _, _, b in passages:
        rare = sorted(b, key=lambda g: (-max(map(len, g.split(" "))), g))
        for g in rare[: len(b) - least_common(len(b), threshold) + 1]:
            anchors.add(max(g.split(" "), key=lambda w: (len(w), -seen[w], w)))
    return sorted(anchors)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def scan(df: DataFrame, keys: list[str], text_col: str = "text", threshold: float = 0.8, coverage: float = 0.75,
         templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """Per distinct ``keys``: ``licenses``, an array of structs (license, score) ordered by licence; empty if none."""
    spark = df.sparkSession
    passages = template_passages(templates)
    rows = [F.struct(*(F.lit(v).alias(c) for c, v in zip(("license", "passages", "passage", "size", "gram"), (n, total, k, len(b), g))))
            for n, total, k, b in passages for g in sorted(b)]
    known = spark.range(1).select(F.inline(F.array(*rows)))
    pattern = "(?i)(?<![a-z0-9])(?:" + "|".join(anchor_words(passages, threshold)) + ")(?![a-z0-9])"
    sizes = sorted({len(b) for _, _, _, b in passages})
    low = [least_common(s, threshold) for s in sizes]
    high = [math.floor((2 - threshold) * s / threshold + 1e-9) for s in sizes]
    # Whole texts without an anchor word are out before they are cut up.
    bare = F.regexp_replace(text_col, COMMENT_WORD, "")
    # Equal passages of a text match alike: one is enough.
    cuts = F.array_distinct(F.concat(F.split(text_col, PASSAGE_END), F.split(bare, BLOCK_END), F.split(bare, CLAUSE_END)))
    pieces = (df.where(F.col(text_col).rlike(pattern))
              .select(*keys, F.explode(cuts).alias("p")).where(F.col("p").rlike(pattern)))
    words = F.filter(F.split(ascii_lower(F.col("p")), "[^a-z0-9]+"), lambda w: w != "")
    grams = F.when(F.size("words") > 1, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.size("words") - 1),
        lambda i: F.concat(F.get("words", i - 1), F.lit(" "), F.get("words", i))))).otherwise(F.col("words"))
    fits = F.lit(False)
    for a, b in zip(low, high):
        fits = fits | F.col("n").between(a, b)
    sets = pieces.select(*keys, words.alias("words")).where(F.size("words") > 0)
    sets = sets.select(*keys, grams.alias("grams")).select(*keys, F.size("grams").alias("n"), "grams").where(fits)
    # A passage is named by its set of bigrams; equal ones of a document's rows and cuts match alike, so one is enough.
    sets = sets.withColumn("at", F.md5(F.array_join(F.array_sort("grams"), ",").cast("binary"))).dropDuplicates([*keys, "at"])
    common = (sets.select(*keys, "at", "n", F.explode("grams").alias("gram")).join(F.broadcast(known), "gram")  # fixed table
              .where((F.col("n") >= F.col("size") * threshold / (2 - threshold) - 1e-9)
                     & (F.col("n") <= F.col("size") * (2 - threshold) / threshold + 1e-9))
              .groupBy(*keys, "at", "n", "license", "passages", "passage", "size").agg(F.count("*").alias("c")))
    dice = common.select(*keys, "license", "passages", "passage", (2 * F.col("c") / (F.col("n") + F.col("size"))).alias("dice"))
    best = dice.where(F.col("dice") >= threshold).groupBy(*keys, "license", "passages", "passage").agg(F.max("dice").alias("dice"))
    found = (best.groupBy(*keys, "license", "passages").agg(F.count("*").alias("k"), F.sum("dice").alias("d"))
             .where(F.col("k") >= coverage * F.col("passages"))
             .groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("license", (F.col("d") / F.col("passages")).alias("score")))).alias("found")))
    empty = F.array().cast("array<struct<license:string,score:double>>")
    documents = df.select(*keys).distinct()
    on = [documents[k].eqNullSafe(found[k]) for k in keys]
    joined = documents.join(found, on[0] if len(on) == 1 else on, "left")
    return joined.select(*(documents[k] for k in keys), F.coalesce(found["found"], empty).alias("licenses"))
