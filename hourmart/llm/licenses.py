"""License scan (operator 4), DataFrame functions only.

Two findings per document. The base: places where the words of a phrase stand
one after the other. The method: an exact set-similarity join of text blocks with
license templates. Blocks are all runs of words up to ``SPAN`` times as long as
the template, line breaks ignored, so a wrapped notice is met like one on a
single line and words far apart are not. A block meets a template when it holds
at least ``threshold`` of the template's distinct words, and all of those that
name the license (``NAMES``): without them most notices read alike. Template
words are ordered by their frequency over all texts, rarest first; a block that
meets the threshold must hold one of the template's first m - need + 1 words,
and always the rarest naming word, so only those are join keys. Pairs then pass a length and positional filter
(enough words from the key on, in that order, within reach of its place) and
the exact count of each block that holds the place.

* null or empty text: no words, no labels, score 0. Repeated rows: each its own
  result (matches are keyed by doc_id and text). Ties in frequency: by word.
* the templates are a stated table; their words (under a few hundred) are the
  only thing collected or broadcast. No rows of one license meet in a task:
  matches are grouped by document.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourmart.llm.common import ascii_lower, document_key, store
from hourmart.llm.words import words

# Phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Notices of common licenses.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files to deal in the software without restriction"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license "
               "is distributed on an as is basis without warranties or conditions of any kind"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)

# What names a license. A block must hold those of its template's words that stand in one of these.
NAMES = ("mit", "apache", "gnu", "cc by nc", "creative commons attribution", "noncommercial", "mozilla")

THRESHOLD = 0.8
SPAN = 1.5


def needed(n_words: int, threshold: float = THRESHOLD) -> int:
    """Smallest number of common words that meets the threshold."""
    return max(1, math.ceil(threshold * n_words - 1e-9))


def naming(template: str) -> list[str]:
    """Words of the template that name the license."""
    return sorted({w for n in NAMES if f" {n} " in f" {template} " for w in n.split()})


def longest(n_words: int) -> int:
    """Words a block may have for a template of ``n_words`` words, repeated ones included."""
    return math.ceil(SPAN * n_words - 1e-9)


def _phrase_places(w: Column, phrase: str) -> Column:
    """Word positions at which the phrase starts."""
    parts = phrase.split(" ")

    def here(i: Column) -> Column:
        hit = F.get(w, i) == F.lit(parts[0])
        for k, part in enumerate(parts[1:], 1):
            hit = hit & F.coalesce(F.get(w, i + F.lit(k)) == F.lit(part), F.lit(False))
        return hit

    places = F.filter(F.sequence(F.lit(0), F.size(w) - F.lit(1)), here)
    return F.when(F.size(w) >= F.lit(len(parts)), places).otherwise(F.array().cast("array<int>"))


def scan_words(docs: DataFrame, id_col: str, text: str, phrases, vocabulary: list[str]) -> DataFrame:
    """One pass over the texts: id, key, n_words, n_base, first_word, last_word, base (labels, distinct
    and sorted) and places (position and word of each word that is in ``vocabulary``, in order)."""
    low = ascii_lower(F.coalesce(F.col(text), F.lit("")))
    rows = docs.select(F.col(id_col), document_key(F.col(text)).alias("key"), words(low, lowered=True).alias("w"))
    # a phrase's last word must stand somewhere: texts without it skip the search
    maybe = F.lit(False)
    for tail in sorted({p.split(" ")[-1] for p, _ in phrases}):
        maybe = maybe | F.array_contains("w", tail)
    none = F.array().cast("array<int>")
    rows = rows.withColumn("at", F.array(*[F.when(maybe, _phrase_places(F.col("w"), p)).otherwise(none)
                                           for p, _ in phrases]))
    every = F.flatten("at")
    labels = F.array(*[F.when(F.size(F.get("at", F.lit(i))) > 0, F.lit(label)) for i, (_, label) in enumerate(phrases)])
    known = F.filter(F.transform("w", lambda x, i: F.struct(i.alias("at"), x.alias("w"))),
                     lambda p: p["w"].isin(vocabulary))
    return rows.select(
        id_col, "key", F.size("w").cast("long").alias("n_words"), F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(F.filter(labels, lambda x: x.isNotNull()))).alias("base"),
        known.alias("places"))


def template_matches(scanned: DataFrame, id_col: str, sets: list[tuple[str, list[str], list[str], int]], vocabulary: list[str],
                     threshold: float = THRESHOLD) -> DataFrame:
    """(id, key, found, best): per document with a block that meets a template, the labels and the
    greatest containment. ``sets``: (label, distinct words, naming words, longest block) of each template."""
    spark = scanned.sparkSession
    # global frequency order of the template words: at most len(vocabulary) rows reach the driver
    counts = dict(scanned.select(F.explode("places.w").alias("w")).groupBy("w").count().collect())
    order = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    prefix = []
    for label, s, names, span in sets:
        s = sorted(s, key=rank.get)
        need = needed(len(s), threshold)
        if names:
            prefix.append((min(names, key=rank.get), label, len(s), need, span, s, names))
        else:  # the word is the block's rarest of the template: what is rarer still is not counted there
            prefix += [(w, label, len(s), need, span, s[pos:], []) for pos, w in enumerate(s[:len(s) - need + 1])]
    probe = F.broadcast(spark.createDataFrame(
        prefix, "w string, label string, m int, need int, span int, tokens array<string>, names array<string>"))

    # each place of a prefix word, with the places that a block around it can hold
    reach = max(span for *_, span in sets) - 1
    keys = sorted({p[0] for p in prefix})
    spots = F.filter(F.transform("places", lambda p, j: F.struct(p["at"].alias("at"), p["w"].alias("w"), j.alias("j"))),
                     lambda p: p["w"].isin(keys))
    around = F.transform(spots, lambda p: F.struct(
        p["at"].alias("at"), p["w"].alias("w"),
        F.slice("places", F.greatest(p["j"] - F.lit(reach), F.lit(0)) + F.lit(1), F.lit(2 * reach + 1)).alias("near")))
    placed = scanned.select(id_col, "key", F.explode(around).alias("c")).select(id_col, "key", "c.*")
    near = F.filter("near", lambda p: (F.abs(p["at"] - F.col("at")) < F.col("span"))
                    & F.array_contains(F.col("tokens"), p["w"]))
    pairs = placed.join(probe, "w").withColumn("near", near) \
        .where((F.size(F.array_distinct("near.w")) >= F.col("need"))  # length and position
               & (F.size(F.array_except("names", "near.w")) == 0))

    def held(first: Column) -> Column:
        """Distinct template words of the block that starts at a place; 0 without a naming word."""
        block = F.filter("near", lambda p: (p["at"] >= first["at"]) & (p["at"] < first["at"] + F.col("span")))
        block = F.transform(block, lambda p: p["w"])
        return F.when(F.size(F.array_except("names", block)) == 0, F.size(F.array_distinct(block))).otherwise(0)

    common = F.array_max(F.transform(F.filter("near", lambda p: p["at"] <= F.col("at")), held))
    met = pairs.withColumn("common", common).where(F.col("common") >= F.col("need"))
    return met.groupBy(id_col, "key").agg(
        F.collect_set("label").alias("found"),
        F.max(F.col("common").cast("double") / F.col("m").cast("double")).alias("best"))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", templates=TEMPLATES,
                 threshold: float = THRESHOLD) -> DataFrame:
    """id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row.

    ``score``: 1 with a base phrase, else the greatest containment of a template that is met, else 0.
    """
    sets = [(label, sorted(set(t.split())), naming(t), longest(len(t.split()))) for label, t in templates]
    vocabulary = sorted({w for _, s, _, _ in sets for w in s})
    scanned = store(scan_words(docs, id_col, text, PHRASES, vocabulary), "license-words")
    met = template_matches(scanned, id_col, sets, vocabulary, threshold).alias("b")
    base = scanned.drop("places").alias("a")
    both = base.join(met, (F.col("a.key") == F.col("b.key"))
                     & F.col(f"a.{id_col}").eqNullSafe(F.col(f"b.{id_col}")), "left")
    labels = F.array_sort(F.array_union("base", F.coalesce("found", F.array().cast("array<string>"))))
    return both.select(
        F.col(f"a.{id_col}").alias(id_col), "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))
