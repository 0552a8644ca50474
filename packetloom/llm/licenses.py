"""License scan by diagonal voting.

Every run of two words of a document meets, by a join on its hash, the places of the templates at which the same two words stand. A meeting
at document word i and template word j votes for the diagonal i - j. A template that stands in a document as it is puts all its
votes on one diagonal; words added or left out shift the rest to diagonals beside it, so neighbouring ones are merged.
Merged votes give a span of the document and how much of the template it covers, and spans are verified: whole phrases
have to be there word for word, longer templates by most of their word pairs within a span not much longer than themselves. Where merged
votes reach further than that, every stretch of them that is short enough is tried, so stray pairs beside a template do not hide it.

Only DataFrame functions are used. Templates are constants of this module, so their table has a fixed size and is broadcast.

The score is the largest share of a template that was verified, 0 without any. A label is the template's; `base_labels` are those of
whole phrases.

Defined cases: a NULL text has no words; phrases may overlap and count at every place; repeated rows come back repeated, with equal results; an
empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from packetloom.llm.common import words
from packetloom.llm.shingles import KEY, gram_hash, grams, keyed, word_count

GRAM = 2
#: Diagonals this near to each other are merged.
NEAR = 4
#: Share of a longer template's word pairs that has to be found, and how much longer than it the span may be.
COVERED = 0.75
STRETCH = 1.5

# The phrases of the contract and the wording of well-known license texts.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
TEXTS = {
    "mit": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License",
        "Licensed under the Apache License, Version 2.0",
    ],
    "gpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
        "Licensed under the GNU General Public License",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License "
        "as published by the Free Software Foundation",
    ],
    "agpl": ["it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies",
    ],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "unlicense": ["This is free and unencumbered software released into the public domain"],
    "cc0": ["To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or neighboring rights"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0"],
    "cc-by": ["This work is licensed under a Creative Commons Attribution 4.0 International License"],
}


def templates(spark: SparkSession) -> DataFrame:
    """`template, label, phrase, length, at, first, second, h`: one row per pair of neighbouring words of each template."""
    rows = [(text, label, True) for text, label in PHRASES.items()]
    rows += [(text, label, False) for label, texts in TEXTS.items() for text in texts]
    made = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "template int, text string, label string, phrase boolean")
    listed = made.withColumn("words", words(F.col("text")))
    spread = listed.withColumn("at", F.explode(F.sequence(F.lit(0), F.size("words") - GRAM)))
    pair = [F.get("words", F.col("at") + j) for j in range(GRAM)]
    return spread.select(
        "template", "label", "phrase", F.size("words").alias("length"), "at", pair[0].alias("first"), pair[1].alias("second"),
        gram_hash(*pair).alias("h"),
    )


def most_repeats() -> int:
    """How often a pair of words stands in one template at most."""
    found = [re.findall("[0-9a-z]+", text.lower()) for texts in TEXTS.values() for text in texts]
    return max(n for w in found for n in Counter(zip(w, w[1:])).values())


def best_stretch(lines: Column, length: Column) -> Column:
    """`votes, begin, end` of the stretch with the most votes that a template of `length` words may have, over merged `lines` (diagonal, ats).

    A stretch begins at a vote, and no more than so many votes lie in it as its places times the repeats of a pair.
    """
    reach = F.floor(F.lit(STRETCH) * length).cast("int") - GRAM
    places = F.array_sort(F.flatten(F.transform(lines, lambda d: F.transform(d["ats"], lambda at: F.struct((d["diagonal"] + at).alias("pos"), at.alias("at"))))))

    def stretch(first: Column, i: Column) -> Column:
        inside = F.filter(F.slice(places, i + 1, (reach + 1) * most_repeats()), lambda p: p["pos"] <= first["pos"] + reach)
        end = F.element_at(inside, -1)["pos"] + GRAM
        return F.struct(F.size(F.array_distinct(inside["at"])).alias("votes"), first["pos"].alias("begin"), end.alias("end"))

    return F.array_max(F.transform(places, stretch))


def spans(docs: DataFrame) -> DataFrame:
    """`doc, text_hash, template, label, phrase, length, votes, begin, end` for merged diagonals of `docs` (as made by `keyed`)."""
    found = grams(docs, GRAM).join(F.broadcast(templates(docs.sparkSession)), "h")
    found = found.filter((F.col("gram.w0") == F.col("first")) & (F.col("gram.w1") == F.col("second")))
    place = [*KEY, "template", "label", "phrase", "length"]
    # Repeated rows vote for the same places, which count once.
    votes = found.groupBy(*place, (F.col("pos") - F.col("at")).alias("diagonal")).agg(F.collect_set("at").alias("ats"))
    whole = votes.filter("phrase").select(
        *place, F.size("ats").alias("votes"), F.col("diagonal").alias("begin"), (F.col("diagonal") + F.col("length")).alias("end")
    )
    # A single pair of words in common says nothing about a longer text; it can still join a diagonal beside it.
    texts = votes.filter("NOT phrase")
    near = Window.partitionBy(*KEY, "template").orderBy("diagonal")
    fresh = F.col("diagonal") - F.lag("diagonal").over(near) > NEAR
    grouped = texts.withColumn("fresh", F.coalesce(fresh.cast("int"), F.lit(0)))
    grouped = grouped.withColumn("group", F.sum("fresh").over(near))
    merged = grouped.groupBy(*place, "group").agg(
        F.collect_list(F.struct("diagonal", "ats")).alias("lines"),
        F.min(F.col("diagonal") + F.array_min("ats")).alias("begin"), F.max(F.col("diagonal") + F.array_max("ats") + GRAM).alias("end"),
    )
    all_votes = F.size(F.array_distinct(F.flatten("lines.ats")))
    whole_span = F.struct(all_votes.alias("votes"), "begin", "end")
    long = (F.col("end") - F.col("begin") > STRETCH * F.col("length")) & (all_votes >= COVERED * (F.col("length") - GRAM + 1))
    found = merged.select(*place, F.when(long, best_stretch(F.col("lines"), F.col("length"))).otherwise(whole_span).alias("span"))
    return whole.unionByName(found.select(*place, "span.*"))


def scan(docs: DataFrame) -> DataFrame:
    """`doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score` for every row of `docs` (doc_id, text)."""
    rows = keyed(docs.select("doc_id", "text"))
    share = F.col("votes") / (F.col("length") - GRAM + 1)
    verified = spans(rows).filter(
        F.when(F.col("phrase"), share == 1).otherwise((share >= COVERED) & (F.col("end") - F.col("begin") <= STRETCH * F.col("length")))
    )
    base = F.when(F.col("phrase"), F.col("begin"))
    marks = verified.groupBy(*KEY).agg(
        F.count(base).alias("n_base"), F.min(base).cast("long").alias("first_word"), F.max(base).cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("phrase"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"), F.max(share).alias("score"),
    )
    counted = rows.select("doc_id", *KEY, word_count(F.col("text")).alias("n_words"))
    joined = counted.join(marks, KEY, "left")
    filled = {"n_base": F.lit(0).cast("long"), "base_labels": F.lit(""), "labels": F.lit(""), "score": F.lit(0.0)}
    return joined.select(
        "doc_id", "n_words", *[F.coalesce(c, filled[c]).alias(c) if c in filled else c
                               for c in ("n_base", "first_word", "last_word", "base_labels", "labels", "score")],
    )
