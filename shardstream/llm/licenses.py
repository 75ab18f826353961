"""License scans by diagonal voting, in DataFrame operations only.

Rolling hashes of k words of every document are joined with the places where license templates have them;
matches on one diagonal (place in the document less place in the template) vote for a copy of the template there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

GRAM = 5
# Diagonals this near are one copy with words put in or left out.
NEAR = 8
# Least part of a template's words, and least words in a row, that a verified span has.
COVER, SPAN_WORDS = 0.4, 8
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The phrases of the base scan and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices of public licenses, with their labels.
TEMPLATES = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
        this permission notice shall be included in all copies or substantial portions of the Software.""",
    "apache": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
        applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.""",
    "gpl": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "mpl": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "cc": """This work is licensed under a Creative Commons Attribution 4.0 International License. To view a copy of this license,
        visit http://creativecommons.org/licenses/by/4.0/""",
}


def words_of(text: Column) -> Column:
    """The words of a text as an array; lower case by Spark, which agrees with A-Z on all words that are matched here."""
    plain = F.btrim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD, " "), F.lit(" "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def grams_of(words: Column, k: int) -> Column:
    """All runs of k words as (place, hash, first word, last word); none if there are fewer words."""
    last = F.size(words) - k
    at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.struct(
        i.alias("place"), F.xxhash64(F.slice(words, i + 1, k)).alias("hash"), F.get(words, i).alias("head"), F.get(words, i + (k - 1)).alias("tail")))


def template_places(spark: SparkSession, templates: dict[str, str], k: int) -> DataFrame:
    """label, template_words, spot, hash, template_head, template_tail: the runs of k words of each template. As large as the templates."""
    rows = spark.createDataFrame(list(templates.items()), "label string, body string").withColumn("words", words_of(F.col("body")))
    grams = rows.select("label", F.size("words").alias("template_words"), F.explode(grams_of(F.col("words"), k)).alias("g"))
    return grams.select("label", "template_words", F.col("g.place").alias("spot"), F.col("g.hash").alias("hash"),
                        F.col("g.head").alias("template_head"), F.col("g.tail").alias("template_tail"))


def license_spans(docs: DataFrame, templates: dict[str, str] | None = None, k: int = GRAM) -> DataFrame:
    """Verified copies of templates: doc_id, text_hash, label, first_word, last_word, matched_words, coverage.

    Every run of k words of every whole text is joined with the broadcast templates. Each match votes for its diagonal;
    votes are counted per diagonal, diagonals at most NEAR apart in one document are one copy. A copy is verified by its words:
    the first and the last word of each run are compared, which in a stretch of 2k - 2 words (SPAN_WORDS) are all words, and the
    copy must cover COVER of the template and SPAN_WORDS words.
    """
    places = template_places(docs.sparkSession, templates or TEMPLATES, k)
    words = docs.select("doc_id", F.coalesce(F.xxhash64("text"), F.lit(0)).alias("text_hash"), words_of(F.col("text")).alias("words"))
    grams = words.select("doc_id", "text_hash", F.explode(grams_of(F.col("words"), k)).alias("g"))
    runs = grams.select("doc_id", "text_hash", "g.place", "g.hash", "g.head", "g.tail")
    same = (F.col("head") == F.col("template_head")) & (F.col("tail") == F.col("template_tail"))
    votes = runs.join(F.broadcast(places), "hash").filter(same)
    votes = votes.select("doc_id", "text_hash", "label", "template_words", "place", "spot").distinct()
    copy = ["doc_id", "text_hash", "label"]
    diagonals = votes.groupBy(*copy, "template_words", (F.col("place") - F.col("spot")).alias("diagonal")).agg(
        F.count("*").alias("votes"), F.min("place").alias("first"), F.max("place").alias("last"), F.collect_set("spot").alias("spots"))
    ordered = Window.partitionBy(*copy).orderBy("diagonal")
    begins = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(ordered) > NEAR).cast("int"), F.lit(1))
    merged = diagonals.withColumn("begins", begins).withColumn("number", F.sum("begins").over(ordered))
    copies = merged.groupBy(*copy, "template_words", "number").agg(
        F.min("first").alias("first_word"), (F.max("last") + k - 1).alias("last_word"),
        F.array_distinct(F.flatten(F.collect_list("spots"))).alias("spots"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("spots", lambda s: F.sequence(s, s + k - 1)))))
    found = copies.withColumn("matched_words", covered).withColumn("coverage", F.col("matched_words") / F.col("template_words"))
    return found.filter((F.col("coverage") >= COVER) & (F.col("matched_words") >= SPAN_WORDS)).drop("number", "spots", "template_words")


def phrase_places(words: Column, phrase: str) -> Column:
    """Where the words of a phrase stand next to each other."""
    parts = phrase.split(" ")
    last = F.size(words) - len(parts)
    at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))

    def here(i):
        same = F.lit(True)
        for j, part in enumerate(parts):
            same = same & (F.get(words, i + j) == part)
        return same

    return F.filter(at, here)


def scan_licenses(docs: DataFrame, phrases: dict[str, str] | None = None, templates: dict[str, str] | None = None) -> DataFrame:
    """Licenses of every whole text: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    The base counts places of the phrases; ``labels`` adds those of verified template copies (see :func:`license_spans`).
    score is 1 for a complete copy or a base phrase within a copy, else the best coverage, and 0.5 at least with a base phrase.
    Null and empty texts have no words, no labels and score 0; texts of any length are scanned whole; rows that are equal get equal
    results, each its own row; documents are matched by id and text, also with a null id; other columns are
    not read; an empty table gives no rows. One row of votes a document, template and diagonal is shuffled, no text.
    """
    phrases = phrases or PHRASES
    spans = license_spans(docs, templates).groupBy("doc_id", "text_hash").agg(
        F.collect_set("label").alias("found"), F.max("coverage").alias("coverage"))
    spans = spans.select(F.col("doc_id").alias("span_doc"), F.col("text_hash").alias("span_text"), "found", "coverage")
    plain = F.concat(F.lit(" "), F.btrim(F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), NOT_WORD, " "), F.lit(" ")), F.lit(" "))
    rows = docs.select("doc_id", F.coalesce(F.xxhash64("text"), F.lit(0)).alias("text_hash"), plain.alias("plain"))
    rows = rows.withColumn("words", F.when(F.col("plain") == "  ", F.array().cast("array<string>")).otherwise(F.split(F.btrim("plain"), " ")))
    none = F.array().cast("array<int>")
    names = {p: f"places_{i}" for i, p in enumerate(phrases)}
    for phrase, name in names.items():  # word by word only where the phrase is in the text at all
        rows = rows.withColumn(name, F.when(F.contains("plain", F.lit(f" {phrase} ")), phrase_places(F.col("words"), phrase)).otherwise(none))
    every = F.flatten(F.array(*names.values()))
    labels = F.array_compact(F.array(*[F.when(F.size(n) > 0, phrases[p]) for p, n in names.items()]))
    slim = rows.select(
        "doc_id", "text_hash", F.size("words").cast("long").alias("n_words"), F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"), labels.alias("base"))
    same = F.col("doc_id").eqNullSafe(F.col("span_doc")) & (F.col("text_hash") == F.col("span_text"))
    joined = slim.join(spans, same, "left")
    both = F.array_union("base", F.coalesce("found", F.array().cast("array<string>")))
    cover, based = F.coalesce("coverage", F.lit(0.0)), F.size("base") > 0
    score = F.when(based & (cover > 0), 1.0).when(based, F.greatest(cover, F.lit(0.5))).otherwise(cover)

    def listed(array):
        return F.array_join(F.array_sort(F.array_distinct(array)), ",")

    return joined.select("doc_id", "n_words", "n_base", "first_word", "last_word", listed(F.col("base")).alias("base_labels"),
                         listed(both).alias("labels"), F.least(score, F.lit(1.0)).alias("score"))
