"""License scan: fixed phrases, and an exact set-similarity join with templates. DataFrame functions only."""

from __future__ import annotations

import json
import math
import re
import string
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapidar.llm.common import let, running

#: Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Notices as licenses ask for them, and paragraphs of license files, by label.
TEMPLATES = {
    "agpl": ["This program is licensed under the GNU Affero General Public License, version 3.",
             "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"],
    "apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
                   "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
                   "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."],
    "boost": ["Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license "
              "(the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
            "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-nc-nd": ["Licensed under CC BY-NC-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."],
    "cc-by-nc-sa": ["Licensed under CC BY-NC-SA 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."],
    "cc-by-nd": ["Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "gpl": ["This work is licensed under the GNU General Public License, version 3.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, "
            "either version 3 of the License, or (at your option) any later version."],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies."],
    "lgpl": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
             "This work is licensed under the GNU Lesser General Public License, version 3."],
    "mit": ["Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software "
            "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
            "and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "reserved": ["All rights reserved."],
    "unlicense": ["This is free and unencumbered software released into the public domain.",
                  "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
                  "for any purpose, commercial or non-commercial, and by any means."],
    "zlib": ["This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."],
}
#: Words that name a license. A block must hold all of them that the template has.
NAMES = {
    "agpl": "affero", "apache-2.0": "apache", "cc-by": "cc by creative commons attribution", "cc-by-nc": "cc by nc creative commons attribution noncommercial",
    "cc-by-nc-nd": "cc by nc nd creative commons attribution noncommercial noderivatives", "cc-by-nc-sa": "cc by nc sa creative commons attribution noncommercial sharealike",
    "cc-by-nd": "cc by nd creative commons attribution noderivatives", "cc-by-sa": "cc by sa creative commons attribution sharealike", "cc0": "waived", "gpl": "gnu general",
    "lgpl": "gnu lesser", "mit": "mit", "mpl-2.0": "mozilla mpl", "unlicense": "unencumbered",
}
CONTAINMENT = 0.8
"""Least share of a template's words that a block holds."""

LETTER = r"[0-9A-Za-z\x{80}-\x{10FFFF}]"
"""A sign of a word, in either case."""
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PARAGRAPHS = r"\n[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*\n"
"""Between paragraphs: lines without a word, of comment marks too."""


def lowered(text: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    """The words of a text, joined by one space."""
    return F.trim(F.regexp_replace(lowered(text), GAP, " "))


def tokens_of(notice: str) -> list[str]:
    """The different words of a notice, in order of the alphabet."""
    return sorted(set("".join(c if c.isalnum() else " " for c in notice.lower()).split()))


def need(size: int, containment: float) -> int:
    return math.ceil(containment * size - 1e-9)


def reach(notice: str, containment: float) -> int:
    """Most words in a row that a wrapped notice may take."""
    return int(len("".join(c if c.isalnum() else " " for c in notice).split()) / containment + 1e-9)


def tightest(every: Column, tokens: Column, width: Column) -> Column:
    """Most different ones of tokens in any width words of every on end; each window begins at a word that is met."""
    hits = F.filter(F.transform(every, lambda w, i: F.struct(i.alias("at"), w.alias("word"))), lambda h: F.array_contains(tokens, h["word"]))

    def best(hits: Column) -> Column:
        return F.array_max(F.transform(hits, lambda h, k: F.size(F.array_distinct(F.transform(
            F.filter(F.slice(hits, k + 1, width), lambda g: g["at"] < h["at"] + width), lambda g: g["word"])))))

    return F.element_at(F.transform(F.array(hits), best), 1)


def any_word(some: list[str]) -> str:
    """Pattern of one of some as a whole word; a tree by first letters, so that most places fail at once."""
    tree: dict = {}
    for w in some:
        node = tree
        for c in [*w, ""]:
            node = node.setdefault(c, {})

    def branch(node: dict) -> str:
        parts = [re.escape(c) + branch(below) for c, below in sorted(node.items()) if c]
        found = parts[0] if len(parts) == 1 else "(?:" + "|".join(parts) + ")" if parts else ""
        return f"(?:{found})?" if "" in node and parts else found

    return rf"(?<!{LETTER}){branch(tree)}(?!{LETTER})"


def frequencies(rows: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """How often all texts hold each word of the templates; at most one count a word reaches the driver."""
    found = rows.select(F.explode(F.split(words(F.col("text")), " ")).alias("word")).where(F.col("word").isin(vocabulary))
    return {w: 0 for w in vocabulary} | {x["word"]: x["count"] for x in found.groupBy("word").count().collect()}


@dataclass
class Notice:
    """A template: its different words in order of the alphabet, how many a block must hold, those it must hold in any
    case, the most words on end that it may take when wrapped, and the templates of other labels whose words alone would meet it."""

    label: str
    tokens: list[str]
    least: int
    names: list[str]
    width: int
    explained: list[int] = field(default_factory=list)


def notices_of(templates: dict[str, list[str]], containment: float) -> list[Notice]:
    out = []
    for label, some in sorted(templates.items()):
        for notice in some:
            t = tokens_of(notice)
            out.append(Notice(label, t, need(len(t), containment), sorted(set(NAMES.get(label, "").split()) & set(t)), reach(notice, containment)))
    for x in out:
        x.explained = [i for i, y in enumerate(out) if y.label != x.label and len(set(x.tokens) & set(y.tokens)) >= x.least]
    return out


def similar_blocks(rows: DataFrame, templates: dict[str, list[str]] | None = None, containment: float = CONTAINMENT) -> DataFrame:
    """(doc_id, text) -> (doc_id, text_hash, wide, block, label, share): lines that hold at least
    containment of the distinct words of a template, the words that name the license among
    them; wide: paragraphs of several lines that hold as much in few words on end (reach),
    wherever their lines break.

    Words are ordered by their count in all texts, rarest first. A line can only reach
    the threshold if it holds one of the first size - need + 1 words of a template (the
    prefix), has need words or more (length), and leaves room for enough common words
    after the one that was met (position); what is left is counted exactly. The index
    holds the templates' words alone, whatever the input, and is broadcast for that.
    Of the templates that a block meets, one goes where another of a different label
    fits better (larger share, then more words) and would meet it by its own words:
    CC BY where the block says CC BY-NC, GPL where it says Affero.
    """
    notices = notices_of(TEMPLATES if templates is None else templates, containment)
    vocabulary = sorted({w for x in notices for w in x.tokens})
    count = frequencies(rows, vocabulary)
    rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (count[w], w)))}
    index = []
    for number, x in enumerate(notices):
        t = sorted(x.tokens, key=rank.__getitem__)
        index += [{"word": w, "template": number, "place": i, "size": len(t), "tokens": t, **{k: getattr(x, k) for k in ("label", "least", "names", "width", "explained")}}
                  for i, w in enumerate(t[: len(t) - x.least + 1])]
    kind = ("array<struct<word: string, template: int, place: int, size: int, tokens: array<string>, label: string, least: int, names: array<string>, "
            "width: int, explained: array<int>>>")
    inverted = rows.sparkSession.range(1).select(F.inline(F.from_json(F.lit(json.dumps(index)), kind)))
    prefix = sorted({x["word"] for x in index})
    ranked = F.array(*(F.lit(w) for w in sorted(rank, key=rank.__getitem__)))

    # words of a prefix are ASCII: a text without any of them, in whatever case, has no such block
    hint = F.col("text").rlike("(?i)" + any_word(prefix))

    def blocks(parts: Column, wide: bool) -> Column:
        return F.transform(parts, lambda x, i: F.struct(i.alias("block"), F.lit(wide).alias("wide"), x.alias("part")))

    wrapped = F.filter(blocks(F.split("text", PARAGRAPHS), True), lambda x: x["part"].contains("\n"))
    every = F.explode(F.concat(blocks(F.split("text", "\n"), False), wrapped)).alias("x")
    parts = rows.where(hint).select("doc_id", F.xxhash64("text").alias("text_hash"), every).select("doc_id", "text_hash", "x.*")
    sets = parts.select("doc_id", "text_hash", "wide", "block", F.split(words(F.col("part")), " ").alias("every"))
    sets = sets.where(F.arrays_overlap("every", F.array(*(F.lit(w) for w in prefix))))
    sets = sets.select("doc_id", "text_hash", "wide", "block", F.array_distinct("every").alias("own"), F.when(F.col("wide"), F.col("every")).alias("every"))
    # in the order of the ranks, for array_intersect keeps that of its first side
    sets = sets.select("doc_id", "text_hash", "wide", "block", "every", F.size("own").alias("own_size"), F.array_intersect(ranked, F.col("own")).alias("common"))
    sets = sets.where(F.size("common") >= min(x["least"] for x in index))
    met = sets.select("*", F.posexplode("common").alias("at", "word")).join(F.broadcast(inverted), "word")
    met = met.where((F.col("own_size") >= F.col("least"))
                    & (1 + F.least(F.col("size") - F.col("place"), F.size("common") - F.col("at")) - 1 >= F.col("least"))
                    & (F.size(F.array_except("names", "common")) == 0))
    # a template is met by one word of its prefix or more: by the rarest it counts
    met = met.withColumn("both", F.array_intersect("tokens", "common")).where(F.element_at("both", 1) == F.col("word"))
    met = met.withColumn("shared", F.size("both")).where("shared >= least")
    tight = F.when(F.col("wide"), tightest(F.col("every"), F.col("tokens"), F.col("width"))).otherwise(F.col("shared"))
    met = met.withColumn("shared", tight).where("shared >= least").select(
        "doc_id", "text_hash", "wide", "block", F.struct((F.col("shared") / F.col("size")).alias("share"), "shared", "template", "label", "explained").alias("met"))
    # at most one row a template
    every = met.groupBy("doc_id", "text_hash", "wide", "block").agg(F.collect_set("met").alias("all"))
    better = lambda y, x: (y["share"] > x["share"]) | ((y["share"] == x["share"]) & (y["shared"] > x["shared"]))
    own = F.filter("all", lambda x: ~F.exists("all", lambda y: F.array_contains(x["explained"], y["template"]) & better(y, x)))
    return (every.select("doc_id", "text_hash", "wide", "block", F.inline(own))
            .groupBy("doc_id", "text_hash", "wide", "block", "label").agg(F.max("share").alias("share")))


def _starts(padded: Column, phrase: str) -> Column:
    """Word indexes at which a phrase stands; padded: words with one space before, between and after."""
    inside = phrase.count(" ")
    spaces = F.transform(F.split(padded, f"(?<= ){phrase}(?= )", -1), lambda x: F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))))
    passed = let(spaces, lambda s: running(F.slice(s, 1, F.size(s) - 1), lambda a, b: a + b))
    return F.when(padded.contains(f" {phrase} "), F.transform(passed, lambda x, i: x - 1 + inside * i)).otherwise(F.expr("cast(array() as array<int>)"))


def _labelled(starts: Column, label: str) -> Column:
    return F.transform(starts, lambda x: F.struct(F.lit(label).alias("label"), x.alias("start")))


def find_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, list[str]] | None = None,
                  containment: float = CONTAINMENT) -> DataFrame:
    """One row per row of docs: doc_id, n_words, places array<struct<label, start>>, similar and wrapped array<struct<label, block, share>>.

    places: where the words of a phrase stand one after another (words from 0); similar:
    lines that meet a template, in order of label and line; wrapped: paragraphs (from 0,
    between lines without words) of several lines that do, so notices over many lines too. Null text counts as empty
    and has no words; null ids stay null; rows that share id and text share what is
    found; templates that fit equally well all count; an empty table gives an empty one;
    other columns are ignored. Work grows with a text's length and its matches: nothing
    compares them with each other.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    found = similar_blocks(rows, templates, containment)
    some = F.struct("label", "block", "share")
    similar = found.groupBy("doc_id", "text_hash").agg(*(F.array_sort(F.collect_list(F.when(F.col("wide") == wide, some))).alias(c) for c, wide in (("similar", False), ("wrapped", True))))
    padded = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), F.concat(F.lit(" "), words(F.col("text")), F.lit(" ")).alias("padded"))
    p = F.col("padded")
    places = F.concat(*(_labelled(_starts(p, phrase), label) for phrase, label in PHRASES.items()))
    n_words = F.when(p == "  ", 0).otherwise(F.length(p) - F.length(F.replace(p, F.lit(" "), F.lit(""))) - 1).cast("long")
    base = padded.select("doc_id", "text_hash", n_words.alias("n_words"), places.alias("places"))
    met = base.join(similar.withColumnsRenamed({"doc_id": "other_id", "text_hash": "other_hash"}),
                    F.col("doc_id").eqNullSafe(F.col("other_id")) & (F.col("text_hash") == F.col("other_hash")), "left")
    none = F.expr("cast(array() as array<struct<label: string, block: int, share: double>>)")
    return met.select("doc_id", "n_words", "places", *(F.coalesce(c, none).alias(c) for c in ("similar", "wrapped")))
