"""License scans: an exact set-similarity join of text blocks with license templates.

A template is the set of words of a license notice; the blocks of a document, for a template of L words, are its
runs of 2 L words (fewer at its end) from every word on. The join finds what is the best block from any word of the
template that holds at least ``THRESHOLD`` of the template's words, or all of them if these are fewer than ``SHORT``: short
notices of different licenses differ in a single word. (A block from another word holds no more of them than the next
block from a word of the template.)

1. words are ordered by the number of documents that hold them, over all documents, rarest first (words of no
   template cannot be shared and come last);
2. prefix filter: with overlap a = ceil(threshold * |T|), a block and a template of that overlap share a word of
   the first |T| - a + 1 words of T and the first |B| - a + 1 words of B. So blocks are only taken around the places of
   T's prefix words, each block at the first such place in it, and only where all blocks of a place together hold a words;
3. length filter: |B| >= a;
4. positional filter: the words from the first shared word on must still allow the overlap;
5. the overlap itself is counted for the blocks that remain.

Scale: whole texts are read twice (word frequencies, then blocks) and never move. Only documents with a word of some
template's prefix carry their words on, and only (row, label, score) of matching documents are exchanged. What
is brought to the driver is one row per template word, a fixed number.

Edge cases: null text counts as empty and has no words. Repeated rows get a row each (rows are numbered, ids are
not used as keys). Only ``doc_id`` and ``text`` are read. An empty table gives an empty result; words that no
document holds count as rarest.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import pin, text_or_empty

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
THRESHOLD = 0.85
SHORT = 10
SEGMENT = 512

# The phrases of the base scan and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# License notices, as their licenses ask to state them.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
               "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)


def lowered(text: Column) -> Column:
    """A-Z to lower case where it can matter: the two other characters whose lower case holds A-Z are set aside."""
    return F.lower(F.replace(F.replace(text, F.lit("K"), F.lit("")), F.lit("İ"), F.lit("")))


def doc_words(text: Column) -> Column:
    return F.regexp_extract_all(lowered(text), F.lit(WORD), F.lit(0))


def least_shared(words: int, threshold: float = THRESHOLD) -> int:
    """How many of a template's ``words`` distinct words a block must hold."""
    return words if words < SHORT else max(1, math.ceil(round(threshold * words, 9)))


def _split(text: str) -> list[str]:
    return re.findall(WORD, text.lower())


def word_frequencies(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Documents that hold each word of ``vocabulary``, over all documents; one row per word comes back."""
    held = docs.select(F.explode(F.array_intersect(
        doc_words(text_or_empty()), F.array(*[F.lit(w) for w in vocabulary]))).alias("word"))
    return {w: 0 for w in vocabulary} | {r["word"]: r["n"] for r in held.groupBy("word").agg(
        F.count(F.lit(1)).alias("n")).collect()}


def ordered_templates(frequencies: dict[str, int], templates=TEMPLATES, threshold: float = THRESHOLD) -> list[dict]:
    """Each template's words by global frequency (then by the word), its least overlap and its prefix."""
    rank = {w: i for i, w in enumerate(sorted(frequencies, key=lambda w: (frequencies[w], w)))}
    out = []
    for k, (label, text) in enumerate(templates):
        said = _split(text)
        words = sorted(set(said), key=rank.__getitem__)
        least = least_shared(len(words), threshold)
        out.append({"template": k, "label": label, "length": len(said), "words": words, "least": least,
                    "prefix": words[:len(words) - least + 1]})
    return out


def _strings(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words]) if words else F.array().cast("array<string>")


def _places(words: Column, phrase: str) -> Column:
    """Starts (from 0) of the places where the phrase's words stand in a row."""
    said = phrase.split()
    n = F.size(words)

    def here(i: Column) -> Column:
        test = F.get(words, i) == said[0]
        for k, w in enumerate(said[1:], 1):
            test = test & (F.get(words, i + k) == w)
        return test

    starts = F.when(F.arrays_overlap(words, _strings(said[:1])) & (n >= len(said)),
                    F.sequence(F.lit(0), n - len(said))).otherwise(F.array().cast("array<int>"))
    return F.filter(starts, here)


def _candidates(docs: DataFrame, prefixes: list[str], phrases) -> DataFrame:
    """One written row per document: its base columns, and its words if it may match."""
    words = F.col("words")
    rows = docs.select("doc_id", doc_words(text_or_empty()).alias("words"))
    ends = sorted({p.split()[-1] for p, _ in phrases})
    maybe = F.arrays_overlap(words, _strings(ends))
    none = F.array().cast("array<int>")
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.size(words).cast("long").alias("n_words"),
                       *[F.when(maybe, _places(words, p)).otherwise(none).alias(f"at{k}")
                         for k, (p, _) in enumerate(phrases)],
                       F.when(F.arrays_overlap(words, _strings(prefixes)), words).alias("words"))
    every = F.concat(*[F.col(f"at{k}") for k in range(len(phrases))])
    found = F.array_compact(F.array(*[F.when(F.size(f"at{k}") > 0, F.lit(label))
                                      for k, (_, label) in enumerate(phrases)]))
    return pin(rows.select("row", "doc_id", "n_words", "words", F.size(every).cast("long").alias("n_base"),
                           F.array_min(every).cast("long").alias("first_word"),
                           F.array_max(every).cast("long").alias("last_word"),
                           F.array_sort(F.array_distinct(found)).alias("base")), "license-rows")


def matching_blocks(rows: DataFrame, frequencies: dict[str, int], ordered: list[dict]) -> DataFrame:
    """row, template, label, start, shared, size of template, for each block of ``rows`` that meets the threshold."""
    spark = rows.sparkSession
    # One row per template: a fixed table.
    table = F.broadcast(spark.createDataFrame(
        [(t["template"], t["label"], t["length"], t["words"], t["least"], t["prefix"]) for t in ordered],
        "template int, label string, length int, t_words array<string>, least int, t_prefix array<string>"))
    of: dict[str, list[int]] = {}
    for t in ordered:
        for w in t["prefix"]:
            of.setdefault(w, []).append(t["template"])
    prefixes = sorted(of)
    by_word = F.create_map(*[x for w in prefixes for x in (F.lit(w), F.array(*[F.lit(k) for k in of[w]]))])
    rank = F.create_map(*[x for i, w in enumerate(sorted(frequencies, key=lambda w: (frequencies[w], w)))
                          for x in (F.lit(w), F.lit(i))])
    touched = F.array_distinct(F.flatten(F.transform(
        F.array_intersect("words", _strings(prefixes)), lambda w: F.try_element_at(by_word, w))))
    # A document is cut into segments first, so that taking a block never copies a long text; a segment holds
    # whole the blocks that start in it. Those without a word of the template's prefix hold no candidate.
    width, least = 2 * F.col("length"), F.col("least")
    segments = F.filter(
        F.transform(F.sequence(F.lit(0), F.size("words") - 1, F.lit(SEGMENT)),
                    lambda s: F.struct(s.alias("first"), F.slice("words", s + 1, F.lit(SEGMENT) + width).alias("part"))),
        lambda g: F.arrays_overlap(g["part"], F.col("t_prefix")))
    hits = F.array_compact(F.transform("seg.part", lambda w, i: F.when(F.array_contains("t_prefix", w), i)))
    # The starts of the blocks whose first prefix word stands at ``hit``: behind the hit before, inside the segment.
    around = F.zip_with(hits, F.concat(F.array(F.lit(-1)), hits), lambda hit, before: F.struct(
        F.greatest(before + 1, hit - width + 1).alias("low"), F.least(hit, F.lit(SEGMENT - 1)).alias("high")))
    around = F.filter(around, lambda a: a["low"] <= a["high"])
    starts = F.filter(F.sequence(F.lit(0), F.col("around.high") - F.col("around.low")),
                      lambda i: F.array_contains("t_words", F.get("part", i)))
    block = F.array_distinct(F.slice("part", F.col("at") + 1, width))
    in_order = F.transform(F.array_sort(F.transform("block", lambda w: F.struct(
        F.coalesce(F.try_element_at(rank, w), F.lit(len(frequencies))).alias("i"), w.alias("w")))), lambda s: s["w"])
    b_size, t_size = F.size("block"), F.size("t_words")
    first = F.get(F.array_intersect("t_prefix", "b_prefix"), F.lit(0))
    left = F.least(t_size - F.array_position("t_words", first), b_size - F.array_position("block", first)) + 1
    return (rows.filter("words is not null")
            .select("row", "words", F.explode(touched).alias("template"))
            .join(table, "template")
            .select("row", "template", "label", "length", "t_words", "least", "t_prefix", F.explode(segments).alias("seg"))
            .select("*", F.explode(around).alias("around"))
            .withColumn("part", F.slice("seg.part", F.col("around.low") + 1,
                                        F.col("around.high") - F.col("around.low") + width))
            .withColumn("first", F.col("seg.first") + F.col("around.low")).drop("seg")
            .filter(F.size(F.array_intersect("part", "t_words")) >= least)
            .select("*", F.explode(starts).alias("at"))
            .withColumn("start", F.col("first") + F.col("at"))
            .withColumn("block", block).drop("part").filter(b_size >= least)                     # length
            .withColumn("block", in_order)
            .withColumn("b_prefix", F.slice("block", 1, F.greatest(b_size - least + 1, F.lit(0))))
            .filter(F.arrays_overlap("t_prefix", "b_prefix"))                                    # prefix
            .filter(left >= least)                                                               # positional
            .select("row", "template", "label", "start", "least", F.size(F.array_intersect("block", "t_words")).alias("shared"),
                    t_size.alias("of"))
            .filter("shared >= least").drop("least"))


def license_scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for each row of ``docs``.

    ``score`` is the largest share of a template's words that a matching block holds, 1 where a phrase stands, else 0.
    """
    vocabulary = sorted({w for _, t in templates for w in _split(t)})
    frequencies = word_frequencies(docs, vocabulary)
    ordered = ordered_templates(frequencies, templates, threshold)
    rows = _candidates(docs, sorted({w for t in ordered for w in t["prefix"]}), phrases)
    best = (matching_blocks(rows, frequencies, ordered).groupBy("row")
            .agg(F.collect_set("label").alias("found"), F.max(F.col("shared") / F.col("of")).alias("share")))
    return (rows.drop("words").join(best, "row", "left")
            .select("doc_id", "n_words", "n_base", "first_word", "last_word",
                    F.concat_ws(",", "base").alias("base_labels"),
                    F.concat_ws(",", F.array_sort(F.array_union("base", F.coalesce(
                        "found", F.array().cast("array<string>"))))).alias("labels"),
                    F.greatest(F.coalesce("share", F.lit(0.0)),
                               F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(0.0)).alias("score")))


def oracle_sql(templates=TEMPLATES, threshold: float = THRESHOLD) -> str:
    """DuckDB SQL of the same result: every block from a word of the template, without frequencies or filters."""
    listed = ", ".join(f"('{label}', {len(_split(t))}, {least_shared(len(set(_split(t))), threshold)}, {sorted(set(_split(t)))!r})"
                       for label, t in templates)
    places = " union all ".join(
        f"select row, i, '{label}' as label from words, unnest(range(0, len(w))) as u(i) where "
        + " and ".join(f"w[i + {k + 1}] = '{word}'" for k, word in enumerate(phrase.split()))
        for phrase, label in PHRASES)
    return f"""
with templates(label, length, least, t) as (values {listed}),
words as (select row_number() over () as row, doc_id,
                 regexp_extract_all(lower(replace(replace(coalesce(text, ''), chr(8490), chr(57344)),
                                                  chr(304), chr(57345))), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
          from documents),
places as ({places}),
base as (select row, count(*) as n, min(i) as a, max(i) as b, list_sort(list_distinct(list(label))) as labels
         from places group by row),
blocks as (select row, label, least, t, list_distinct(w[s + 1 : s + 2 * length]) as b
           from words, templates, unnest(range(0, len(w))) as u(s) where list_contains(t, w[s + 1])),
shares as (select row, label, least, len(list_intersect(b, t)) as shared, len(t) as whole from blocks),
best as (select row, list(distinct label) as labels, max(shared::double / whole) as share from shares
         where shared >= least group by row)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n, 0) as n_base, a as first_word, b as last_word,
       coalesce(array_to_string(base.labels, ','), '') as base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(best.labels, [])))),
                                ','), '') as labels,
       greatest(coalesce(share, 0.0), case when n > 0 then 1.0 else 0.0 end) as score
from words left join base using (row) left join best using (row)
"""
