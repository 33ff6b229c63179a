"""Licence notices in texts, by Dice coefficient over word bigrams (operator 2). DataFrame functions only."""

from collections import Counter
from functools import reduce
from math import ceil, floor
from operator import or_
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelforge.llm.frames import documents, whole_text
from reelforge.operators.durable import settle

#: Public notices, a name and its text. A licence has a line for each customary form.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License. See LICENSE in the project root for license information."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("lgpl-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("bsd-3-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc0-1.0", "To the extent possible under law, the author has dedicated all copyright to the public domain under CC0 1.0 Universal."),
    ("proprietary", "All rights reserved. No part of this work may be reproduced without prior written permission."),
)
#: Full licence texts without title and copyright line: they and the templates are also looked for across line breaks.
FULL_TEXTS = tuple((path.stem, path.read_text()) for path in sorted((Path(__file__).parent / "licence_texts").glob("*.txt")))
LEAST_DICE = 0.85


def words_of(text: Column) -> Column:
    """The words of the normalised text: lower case, letters and digits only."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def pairs_of(words: Column) -> Column:
    n = F.size(words)
    return F.when(n > 1, F.zip_with(
        F.slice(words, F.lit(1), n - 1), F.slice(words, F.lit(2), n - 1), lambda a, b: F.concat(a, F.lit(" "), b),
    )).otherwise(F.array().cast("array<string>"))


def bigrams(text: Column) -> Column:
    """Different pairs of neighbouring words of the normalised text."""
    return F.array_distinct(pairs_of(words_of(text)))


def _plain_words(text: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def _plain_bigrams(text: str) -> list[str]:
    words = _plain_words(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def telling_words(grams: list[str], least: float) -> list[str]:
    """Words of which a unit must hold one to reach ``least`` against a template.

    A unit that reaches it shares all but b (2 - 2 t) / (2 - t) of the template's b bigrams, so of one bigram more it holds at
    least one, and with it that bigram's words. The bigrams with the longest words are taken, as the rarest.
    """
    longest = sorted((max(gram.split(), key=len) for gram in grams), key=lambda word: (-len(word), word))
    return longest[: floor(len(grams) * (2 - 2 * least) / (2 - least) + 1e-9) + 1]


def fewest_telling_words(grams: list[str], least: float) -> list[str]:
    """As ``telling_words``, but few of them: each next one is the long word that is in most of the bigrams not yet met."""
    wanted, left, found = floor(len(grams) * (2 - 2 * least) / (2 - least) + 1e-9) + 1, set(grams), []
    while len(grams) - len(left) < wanted:
        counts = Counter(word for gram in left for word in set(gram.split()))
        word = max(counts, key=lambda w: (min(len(w), 7), counts[w], len(w), w))
        found.append(word)
        left = {gram for gram in left if word not in gram.split()}
    return found


def _holds_any(text: Column, words: list[str]) -> Column:
    return reduce(or_, [F.contains(text, F.lit(word)) for word in words])


def window_hits(texts: DataFrame, notices: tuple, full: tuple, least: float) -> DataFrame:
    """Windows of the texts' words that reach ``least``: ``doc_id``, ``_text``, and ``window`` with the lines where it begins and ends.

    A window for a template has as many words as the template, or as many as are left, and begins with one of its bigrams;
    line breaks count as blanks. A window that reaches ``least`` shares at least ``least / (2 - least)`` of the template's bigrams,
    so windows in which fewer bigrams stand are left out before they are counted as sets. ``texts`` has ``doc_id``, ``text``, ``_text``.
    """
    sets = [(name, len(_plain_words(text)), _plain_bigrams(text), at >= len(notices)) for at, (name, text) in enumerate(notices + full)]
    need = [ceil(least * len(grams) / (2 - least) - 1e-9) for _, _, grams, _ in sets]
    telling = [fewest_telling_words(grams, least) for _, _, grams, _ in sets]
    seen = F.array_intersect(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), F.array(*map(F.lit, sorted({word for words in telling for word in words}))))
    may = F.array_compact(F.array(*[
        F.when((F.length("text") >= 2 * need[at]) & F.arrays_overlap("_seen", F.array(*map(F.lit, words))), F.lit(at)) for at, words in enumerate(telling)]))
    lines = F.transform(F.split("text", "\n"), lambda line, i: F.transform(words_of(line), lambda w: F.struct(i.alias("line"), w.alias("word"))))
    cut = (
        texts.select("doc_id", "_text", "text", F.xxhash64("doc_id", "_text").alias("_key")).dropDuplicates(["_key"])
        .withColumn("_seen", F.explode(F.array(seen)))  # exploded, so that each use does not cut the text again
        .withColumn("_may", may).where(F.size("_may") > 0).withColumn("_words", F.flatten(lines))
    )
    cut = settle(cut.select(
        "_key", "doc_id", "_text", "_may", F.transform("_words", lambda w: w["line"]).alias("_lines"),
        pairs_of(F.transform("_words", lambda w: w["word"])).alias("_grams")), "windows")

    spark = texts.sparkSession
    of = {}
    for at, (_, _, grams, _) in enumerate(sets):
        for gram in grams:
            of.setdefault(gram, []).append(str(at))
    known = spark.range(1).select(F.explode(F.split(F.lit("\n".join(f"{gram}\t{','.join(ats)}" for gram, ats in sorted(of.items()))), "\n")).alias("_row"))
    known = known.select(
        F.split("_row", "\t")[0].alias("_gram"), F.split(F.split("_row", "\t")[1], ",").cast("array<int>").alias("_ats"))
    facts = F.array(*[
        F.struct(F.lit(name).alias("licence"), F.lit(words).alias("words"), F.lit(len(grams)).alias("size"), F.lit(need[at]).alias("need"), F.lit(whole).alias("whole"))
        for at, (name, words, grams, whole) in enumerate(sets)])
    met = (
        cut.select("_key", "_may", F.posexplode("_grams").alias("_pos", "_gram")).join(F.broadcast(known), "_gram")
        .select("_key", "_pos", "_gram", F.explode(F.array_intersect("_may", "_ats")).alias("_at"))
        .groupBy("_key", "_at").agg(F.sort_array(F.collect_list(F.struct(F.col("_pos").alias("pos"), F.xxhash64("_gram").alias("gram")))).alias("_met"))
        .withColumn("_of", facts[F.col("_at")]).where(F.size("_met") >= F.col("_of.need"))
    )
    begins = F.filter(
        F.sequence(F.lit(0), F.size("_met") - F.col("_of.need")),
        lambda j: F.get("_met", j + F.col("_of.need") - 1)["pos"] <= F.get("_met", j)["pos"] + F.col("_of.words") - 2)

    def begun(j: Column) -> Column:
        start = F.get("_met", j)["pos"]
        inside = F.filter(F.slice("_met", j + 1, F.col("_of.words") - 1), lambda x: x["pos"] <= start + F.col("_of.words") - 2)
        return F.struct(start.alias("first"), F.size(F.array_distinct(F.transform(inside, lambda x: x["gram"]))).alias("shared"))

    found = met.select("_key", "_of", F.filter(F.transform(begins, begun), lambda w: w["shared"] >= F.col("_of.need")).alias("_found"))

    def judged(w: Column) -> Column:
        size = F.size(F.array_distinct(F.slice("_grams", w["first"] + 1, F.col("_of.words") - 1)))
        last = F.least(w["first"] + F.col("_of.words"), F.size("_lines")) - 1
        return F.struct(
            (-w["shared"]).alias("loss"), (-(F.lit(2.0) * w["shared"] / (size + F.col("_of.size")))).alias("far"), F.col("_of.licence").alias("licence"),
            w["first"].alias("first"), last.alias("last"), F.get("_lines", w["first"]).alias("line"), F.get("_lines", last).alias("until"), F.col("_of.whole").alias("whole"))

    # a document meets all its windows for a template at once: it is not copied for each of them
    both = found.where(F.size("_found") > 0).join(cut.drop("_may"), "_key")
    hits = F.filter(F.transform("_found", judged), lambda w: -w["far"] >= least)
    return both.select("doc_id", "_text", F.explode(hits).alias("window"))


def windows_beside(units: Column, windows: Column) -> Column:
    """Windows that do not overlap, those with most shared bigrams first; one of a notice is left out where a unit with a hit meets it."""
    free = F.filter(F.sort_array(windows), lambda w: w["whole"] | ~F.exists(
        units, lambda u: (u["unit"] == -1) | u["unit"].between(w["line"], w["until"])))
    return F.aggregate(free, F.slice(free, 1, 0), lambda kept, w: F.when(
        F.exists(kept, lambda k: (k["first"] <= w["last"]) & (w["first"] <= k["last"])), kept).otherwise(F.concat(kept, F.array(w))))


def licence_hits(docs: DataFrame, templates: tuple = TEMPLATES, least: float = LEAST_DICE, full: tuple = FULL_TEXTS) -> DataFrame:
    """One row per document with notices: ``doc_id``, ``_text`` (hash of the text), ``hits`` of ``(unit, licence, dice)``.

    Units are the lines of the text from 0, and the whole text as unit -1 where it has several lines. A unit's licence is the
    template with the largest Dice coefficient of at least ``least`` (ties: the name first in order). A template is compared
    only with units whose number of bigrams can reach it: Dice is at most 2 min / (a + b). Texts and units that hold none of
    the templates' telling words are left out before they are cut into bigrams; none of them can reach ``least``. Null and empty texts, and
    units of one word, have no hits. Rows that repeat ``doc_id`` and text count as one; texts of any length are searched
    whole; other columns are not read, whatever their names; an empty table gives no rows.

    Notices that are wrapped or stand within a longer line, and the ``full`` licence texts, are found as windows of words
    (``window_hits``). A window's unit is the line where it begins. Windows do not overlap, and a notice that a line or
    the whole text has already shown is not counted again; a full text counts beside the notices among its lines.
    """
    texts = docs.select("doc_id", whole_text().alias("text")).withColumn("_text", F.xxhash64("text"))
    lines = F.split("text", "\n")
    units = F.concat(
        F.transform(lines, lambda line, i: F.struct(i.alias("unit"), line.alias("words"))),
        F.when(F.size(lines) > 1, F.array(F.struct(F.lit(-1).alias("unit"), F.col("text").alias("words"))))
        .otherwise(F.array().cast("array<struct<unit:int,words:string>>")))
    sets = [(name, _plain_bigrams(text)) for name, text in templates]
    low = [ceil(least * len(grams) / (2 - least)) for _, grams in sets]
    high = [floor((2 - least) / least * len(grams)) for _, grams in sets]
    every = {word for _, grams in sets for word in telling_words(grams, least)}
    telling = sorted(word for word in every if not any(other != word and other in word for other in every))
    cut = (
        texts.where(_holds_any(F.lower("text"), telling))
        .select("doc_id", "_text", F.explode(units).alias("_u")).select("doc_id", "_text", "_u.*")
        .where(_holds_any(F.lower("words"), telling)).withColumn("_grams", bigrams(F.col("words")))
    )
    cut = cut.withColumn("_n", F.size("_grams")).where(F.col("_n").between(min(low), max(high)))

    def dice(at: int) -> Column:
        name, grams = sets[at]
        shared = F.size(F.array_intersect("_grams", F.array(*[F.lit(g) for g in grams])))
        value = F.lit(2.0) * shared / (F.col("_n") + len(grams))
        return F.when(F.col("_n").between(low[at], high[at]), F.struct((-value).alias("loss"), F.lit(name).alias("licence")))

    scored = cut.withColumn("_best", F.array_min(F.array_compact(F.array(*[dice(at) for at in range(len(sets))]))))
    hit = F.struct("unit", F.col("_best.licence").alias("licence"), (-F.col("_best.loss")).alias("dice"))
    windows = window_hits(texts, templates, full, least)
    lone = scored.where(-F.col("_best.loss") >= least).select("doc_id", "_text", hit.alias("hit"), F.lit(None).cast(windows.schema["window"].dataType).alias("window"))
    both = lone.unionByName(windows.withColumn("hit", F.lit(None).cast(lone.schema["hit"].dataType)))
    found = both.groupBy("doc_id", "_text").agg(F.collect_set("hit").alias("_units"), F.collect_set("window").alias("_windows"))
    beside = F.transform(windows_beside(F.col("_units"), F.col("_windows")), lambda w: F.struct(
        w["line"].alias("unit"), w["licence"].alias("licence"), (-w["far"]).alias("dice")))
    return found.select("doc_id", "_text", F.sort_array(F.concat("_units", beside)).alias("hits"))


def op2_license_scan(spark, sf_dir: str) -> DataFrame:
    """Per document: number of units with a notice, its best licence, that coefficient, and all licences found."""
    docs = documents(spark, sf_dir)
    found = licence_hits(docs).withColumnsRenamed({"doc_id": "_id", "_text": "_hash"})
    best = F.array_min(F.transform("hits", lambda h: F.struct((-h["dice"]).alias("loss"), h["licence"].alias("licence"))))
    return docs.select("doc_id", F.xxhash64(whole_text()).alias("_text")).join(
        found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash")), "left"
    ).select(
        "doc_id",
        F.when(F.col("hits").isNull(), F.lit(0)).otherwise(F.size("hits")).cast("long").alias("n_units"),
        best["licence"].alias("licence"), F.round(-best["loss"], 6).alias("dice"),
        F.coalesce(F.array_join(F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["licence"]))), ","), F.lit("")).alias("licences"),
    )


def _sql_list(grams: list[str]) -> str:
    return "[" + ", ".join("'" + g.replace("'", "''") + "'" for g in grams) + "]"


OP2_SQL = f"""
WITH templates AS (SELECT * FROM (VALUES {", ".join(f"('{name}', {_sql_list(_plain_bigrams(text))})" for name, text in TEMPLATES)}) t(licence, theirs)),
texts AS (SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (SELECT row_no, text, string_split(text, chr(10)) AS l FROM texts),
units AS (
    SELECT row_no, unnest(range(len(l))) AS unit, unnest(l) AS words FROM lines
    UNION ALL SELECT row_no, -1, text FROM lines WHERE len(l) > 1),
worded AS (SELECT row_no, unit, list_filter(string_split_regex(lower(words), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w FROM units),
cut AS (SELECT row_no, unit, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS ours FROM worded WHERE len(w) > 1),
scored AS (
    SELECT row_no, unit, licence, 2.0 * len(list_intersect(ours, theirs)) / (len(ours) + len(theirs)) AS dice
    FROM cut JOIN templates ON len(ours) BETWEEN 1 AND 3 * len(theirs)),
best AS (
    SELECT * FROM scored WHERE dice >= {LEAST_DICE}
    QUALIFY row_number() OVER (PARTITION BY row_no, unit ORDER BY dice DESC, licence) = 1),
grouped AS (
    SELECT row_no, count(*) AS n_units, arg_min(licence, (-dice, licence)) AS licence, round(max(dice), 6) AS dice,
           string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences
    FROM best GROUP BY row_no)
SELECT doc_id, coalesce(n_units, 0) AS n_units, licence, dice, coalesce(licences, '') AS licences
FROM texts LEFT JOIN grouped USING (row_no)
"""
