"""License scans: an exact set-similarity join of text blocks with license templates, by containment.

Blocks are the lines, and for notices broken over lines also overlapping windows of words over the whole text: every stretch as
long as the longest template lies whole in one of them. A label found in a line is not given for windows again.

A line meets a template if it holds at least `threshold` of the template's distinct words. Words are ordered by how often the
whole corpus has them, rarest first. A line can only meet a template if it holds one of the template's prefix words (the
rarest n - ceil(threshold * n) + 1) and is long enough; the places of the first common word in the line's and the template's
order bound what they can still share (positional filter); pairs that are left are compared whole. DataFrame functions only;
texts are not shuffled, lines without a prefix word never leave their task, and the templates are a fixed, small set.

Base: the places where a phrase's words follow each other anywhere in the text, also across lines.

Null and empty text: no words, no labels, score 0. Repeated rows are judged one by one. Very long lines are taken whole.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from givingledger.llm.common import PUNCTUATION, lower_ascii, split_words

# Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# One-line notices by the label that they give.
TEMPLATES = {
    "agpl-3.0": "licensed under the GNU Affero General Public License version 3",
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "cc-by-4.0": "Licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0",
    "gpl-3.0": "licensed under the GNU General Public License, version 3",
    "lgpl": "licensed under the GNU Lesser General Public License",
    "mit": "Released under the MIT License",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "mpl-2.0": "subject to the terms of the Mozilla Public License, v. 2.0",
    "unlicense": "This is free and unencumbered software released into the public domain",
}
# Words of a template that may not be missing, by which it differs from other licenses' notices.
NAMED = {"agpl-3.0": ["affero", "3"], "mpl-2.0": ["mozilla", "2"]}
# Templates of ten words or more may lack one; a shorter one consists of what tells it apart.
THRESHOLD = 0.9


def quoted(words: list[str]) -> str:
    return ", ".join("'" + w + "'" for w in words)


def template_words(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """(label, words): distinct words of each template."""
    rows = spark.createDataFrame(sorted(templates.items()), "label string, text string")
    return rows.select("label", F.array_distinct(split_words(lower_ascii(F.col("text")), PUNCTUATION)).alias("words"))


def corpus_order(words: DataFrame, vocabulary: list[str]) -> list[str]:
    """The template words, rarest in the corpus first; words (words) has an array for each document."""
    used = words.select(F.explode("words").alias("word")).filter(F.col("word").isin(vocabulary))
    counts = {r["word"]: r["count"] for r in used.groupBy("word").count().collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def phrase_places() -> Column:
    """(place, label) of each phrase in `words`; looked for only in texts that hold a phrase's words in one blank-joined line."""
    tests = [" AND ".join(f"get(words, i + {k}) = '{w}'" if k else f"words[i] = '{w}'" for k, w in enumerate(p.split())) for p in PHRASES]
    cases = " ".join(f"WHEN {test} THEN '{label}'" for test, label in zip(tests, PHRASES.values(), strict=True))
    held = " OR ".join(f"contains(joined, ' {p} ')" for p in PHRASES)
    return F.expr(f"""CASE WHEN {held} THEN filter(
        transform(words, (w, i) -> struct(i AS place, CASE {cases} END AS label)), x -> x.label IS NOT NULL)
        ELSE CAST(array() AS array<struct<place:int,label:string>>) END""")


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, and blocks: matches (line or first word, label, share)."""
    spark = docs.sparkSession
    lowered = docs.select("doc_id", lower_ascii(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text"))
    known = {r["label"]: r["words"] for r in template_words(spark, templates).collect()}
    order = corpus_order(lowered.select(split_words(F.col("text"), PUNCTUATION).alias("words")), sorted(set().union(*known.values())))
    rank = {w: i for i, w in enumerate(order)}
    needs = {label: -(-round(threshold * 1000) * len(words) // 1000) for label, words in known.items()}
    rows = [(label, sorted(words, key=rank.get), needs[label]) for label, words in known.items()]
    prefix = sorted({w for _, words, need in rows for w in words[: len(words) - need + 1]})
    shortest = min(needs.values())
    sets = ", ".join(f"struct('{label}' AS label, array({quoted(words)}) AS words, {need} AS need, CAST(array({quoted(NAMED.get(label, []))}) AS array<string>) AS named)" for label, words, need in rows)
    met = F.expr(f"""filter(transform(filter(lines, l -> size(l.words) >= {shortest} AND exists(l.words, w -> w IN ({quoted(prefix)}))),
        l -> struct(l.line AS line, l.word AS word, array_intersect(array({quoted(order)}), l.words) AS known)), l -> size(l.known) >= {shortest})""")
    # One pair for each (line, template) that shares a prefix word and can still share enough after its first common word.
    pairs = F.expr(f"""flatten(transform(candidates, l -> filter(transform(array({sets}), t -> struct(
            l.line AS line, l.word AS word, t.label AS label, size(t.words) AS n, t.need AS need, array_position(t.words, get(array_intersect(t.words, l.known), 0)) AS t1,
            array_position(l.known, get(array_intersect(t.words, l.known), 0)) AS l1, size(l.known) AS held, size(array_except(t.named, l.known)) AS unnamed,
            size(array_intersect(t.words, l.known)) AS common)),
        p -> p.t1 BETWEEN 1 AND p.n - p.need + 1 AND least(p.n - p.t1, p.held - p.l1) + 1 >= p.need AND p.common >= p.need AND p.unnamed = 0)))""")
    worded = lowered.select("doc_id", "text", split_words(F.col("text"), PUNCTUATION).alias("words"))
    # Only texts with one of the prefix words are cut into lines and windows.
    step = max(len(list(filter(None, re.split(PUNCTUATION, t.lower())))) for t in templates.values())
    line_sets = F.expr(f"""CASE WHEN exists(words, w -> w IN ({quoted(prefix)})) THEN concat(
        transform(split(text, '\\n'), (x, i) -> struct(i AS line, CAST(NULL AS int) AS word, array_distinct(array_remove(split(x, '{PUNCTUATION}'), '')) AS words)),
        transform(sequence(0, size(words) - 1, {step}), i -> struct(CAST(NULL AS int) AS line, i AS word, array_distinct(slice(words, i + 1, {2 * step})) AS words)))
        ELSE CAST(array() AS array<struct<line:int,word:int,words:array<string>>>) END""".replace("\\x", "\\\\x"))
    found = (
        worded.withColumn("joined", F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")))
        .select("doc_id", F.size("words").cast("long").alias("n_words"), phrase_places().alias("places"), line_sets.alias("lines"))
        .withColumn("candidates", met)
        .withColumn("pairs", pairs)
        .withColumn("pairs", F.expr("filter(pairs, p -> p.line IS NOT NULL OR NOT exists(pairs, q -> q.line IS NOT NULL AND q.label = p.label))"))
        .withColumn("blocks", F.transform("pairs", lambda p: F.struct(p["line"], p["word"], p["label"], (p["common"] / p["n"]).alias("share"))))
    )
    labels = F.array_distinct(F.transform("places", lambda x: x["label"]))
    more = F.transform("blocks", lambda x: x["label"])
    places = F.transform("places", lambda x: x["place"])
    score = F.greatest(F.when(F.size("places") > 0, 1.0).otherwise(0.0), F.coalesce(F.array_max(F.transform("blocks", lambda x: x["share"])), F.lit(0.0)))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"), F.array_max(places).cast("long").alias("last_word"),
        F.array_join(F.array_sort(labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(labels, more)), ",").alias("labels"), score.alias("score"),
        F.to_json("blocks").alias("blocks"))
