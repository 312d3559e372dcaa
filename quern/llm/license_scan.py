"""License scans as an exact set-similarity join of text blocks with license templates, in DataFrame functions only.

Base: places where the words of a known phrase stand consecutively. The method: a block meets a template when at least
`percent` per cent of the template's distinct words are in it. The blocks of a text, for one template, are all windows of
consecutive words that are as long as the template and a quarter more (SLACK), so a notice may be wrapped, commented out or
have words put in, and scattered words of a long text do not add up. No block is left out:

Words of templates are put in one global order, rare in the corpus first. A block with the required overlap
a = ceil(percent * |T| / 100) has one of the first |T| - a + 1 words of the template (prefix filter), so only windows
around such words are looked at. Of these, a place goes on only if enough words of the template stand within a window's
length of it (positional and length filters), and then every window around it is verified by intersection.

Templates are fixed settings of a few hundred words; they, their prefixes and their counts are the only data broadcast.

Cases: null or empty text has no words and no labels. Rows are scanned one by one, so null and repeated ids and repeated
rows are kept as they are. A label met by several blocks counts once. Other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.shared import table, written

PERCENT = 80
#: A block has a template's number of words and this share of them more.
SLACK = 0.25
#: Base phrases and their labels.
PHRASES = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}
#: Statements by which texts name their license, and their labels.
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at apache.org"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("lgpl", "licensed under the terms of the GNU Lesser General Public License"),
    ("agpl", "licensed under the terms of the GNU Affero General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("proprietary", "All rights reserved. No part of this publication may be reproduced without prior written permission"),
]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The one code point outside A-Z whose lower case has an ASCII letter for a word of its own.
_KELVIN = "\u212a"


def _words(text: Column) -> Column:
    """Words of the text in lower case; only A-Z count as capitals of ASCII letters."""
    lower = F.when(text.contains(_KELVIN), F.translate(text, _UPPER, _LOWER)).otherwise(F.lower(text))
    return F.regexp_extract_all(lower, F.lit(_WORD), F.lit(0))


def template_words(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(_WORD, text.lower())))


def block_length(text: str) -> int:
    n = len(re.findall(_WORD, text.lower()))
    return n + int(n * SLACK)


def word_order(docs: DataFrame, text_col: str, vocabulary: list[str]) -> list[str]:
    """The templates' words, those of the fewest documents first; one row a word reaches the driver."""
    known = docs.select(F.explode(F.array_intersect(_words(F.col(text_col).cast("string")), F.array(*map(F.lit, vocabulary)))).alias("word"))
    counts = dict(known.groupBy("word").count().collect())
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def _both(word: str):
    return lambda met, x: met & F.coalesce(x == word, F.lit(False))


def _matches(texts: DataFrame, templates: list[tuple[str, list[str], int]], percent: int) -> DataFrame:
    """(row, label, share) of texts(row, words) with a block that meets a template (label, words rarest first, block length)."""
    spark = texts.sparkSession
    rows = [(k, label, ws, len(ws), (percent * len(ws) + 99) // 100, n) for k, (label, ws, n) in enumerate(templates)]
    known = spark.createDataFrame(rows, "template int, label string, wanted array<string>, size int, need int, length int")
    prefixes = known.select("*", F.explode(F.slice("wanted", F.lit(1), F.col("size") - F.col("need") + 1)).alias("word"))
    reach = max(n for *_, n in rows) - 1
    places = F.array_compact(F.transform("words", lambda x, i: F.when(x.isin(prefix_words(templates, percent)), i + 1)))

    def around(p: Column) -> Column:
        begin = F.greatest(F.lit(1), p - reach)
        return F.struct(F.element_at("words", p).alias("word"), (p - begin + 1).alias("at"), F.slice("words", begin, p + reach - begin + 1).alias("near"))

    probes = texts.select("row", F.explode(F.transform(places, around)).alias("x")).select("row", "x.*")
    met = probes.join(F.broadcast(prefixes), "word")
    first = F.greatest(F.lit(1), F.col("at") - F.col("length") + 1)
    met = met.withColumn("near", F.slice("near", first, F.col("at") + F.col("length") - first)).withColumn("at", F.col("at") - first + 1)
    met = met.where(F.size(F.array_intersect("near", "wanted")) >= F.col("need"))
    starts = F.sequence(F.lit(1), F.col("at"))
    overlap = F.array_max(F.transform(starts, lambda k: F.size(F.array_intersect(F.slice("near", k, F.col("length")), F.col("wanted")))))
    return met.select("row", "label", "size", "need", overlap.alias("overlap")).where("overlap >= need").select("row", "label", (F.col("overlap") / F.col("size")).alias("share"))


def prefix_words(templates: list[tuple[str, list[str], int]], percent: int) -> list[str]:
    return sorted({w for _, ws, _ in templates for w in ws[: len(ws) - (percent * len(ws) + 99) // 100 + 1]})


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] = TEMPLATES, percent: int = PERCENT) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score."""
    words = [(label, template_words(t), block_length(t)) for label, t in templates]
    order = word_order(docs, text_col, sorted({w for _, ws, _ in words for w in ws}))
    place = {w: k for k, w in enumerate(order)}
    ranked = [(label, sorted(ws, key=place.get), n) for label, ws, n in words]

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    docs = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), _words(text).alias("w"))
    licensed = F.array_contains("w", "license")  # a word of every phrase

    def places(phrase: str) -> Column:
        # Shifted copies of the words are zipped: no lambda holds the words, which would be computed for each element.
        first, *rest = phrase.split()
        here = F.transform("w", lambda x: x == first)
        for k, part in enumerate(rest, 1):
            here = F.zip_with(here, F.slice("w", F.lit(k + 1), F.greatest(F.size("w"), F.lit(1))), _both(part))
        return F.when(licensed, F.array_compact(F.transform(here, lambda x, i: F.when(x, i)))).otherwise(F.array().cast("array<int>"))

    docs = docs.withColumns({f"at_{label}": places(phrase) for label, phrase in PHRASES.items()})
    starts = F.concat(*(F.col(f"at_{label}") for label in PHRASES))
    found = F.array_compact(F.array(*(F.when(F.size(f"at_{label}") > 0, F.lit(label)) for label in PHRASES)))
    rare = F.array(*map(F.lit, prefix_words(ranked, percent)))
    facts = docs.select(
        "row",
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_sort(found).alias("base"),
        F.when(F.arrays_overlap("w", rare), F.col("w")).alias("words"),
    )
    facts = written(facts, "licenses")
    more = _matches(facts.where("words is not null").select("row", "words"), ranked, percent)
    more = more.groupBy("row").agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))
    none = F.array().cast("array<string>")
    labels = F.array_join(F.array_sort(F.array_union("base", F.coalesce("more", none))), ",").alias("labels")
    score = F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score")
    return facts.drop("words").join(more, "row", "left").select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), labels, score)


def op8_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    lower = lambda x: f"regexp_extract_all(translate({x}, '{_UPPER}', '{_LOWER}'), '{_WORD}')"
    phrases = " UNION ALL ".join(
        f"SELECT doc_id, '{label}' AS label, i - 1 AS p FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d) WHERE " + " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(phrase.split())) for label, phrase in PHRASES.items()
    )
    templates = ", ".join(f"({k}, '{label}', {template_words(t)}, {block_length(t)})" for k, (label, t) in enumerate(TEMPLATES))
    return f"""
WITH d AS (SELECT doc_id, {lower("coalesce(text, '')")} AS w FROM documents),
base AS ({phrases}),
b AS (SELECT doc_id, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY 1),
template(k, label, words, size) AS (VALUES {templates}),
hit AS MATERIALIZED (SELECT doc_id, k, size, i, x FROM (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d) JOIN (SELECT k, size, unnest(words) AS x FROM template) USING (x)),
block AS (SELECT a.doc_id, a.k, a.i, count(DISTINCT b.x) AS n FROM (SELECT *, unnest([i // size, i // size + 1]) AS part FROM hit) a JOIN (SELECT *, i // size AS part FROM hit) b ON a.doc_id = b.doc_id AND a.k = b.k AND a.part = b.part AND b.i >= a.i AND b.i < a.i + a.size GROUP BY ALL),
met AS (SELECT doc_id, label, max(n) / any_value(len(words)) AS share FROM block JOIN template USING (k) WHERE 100 * n >= {PERCENT} * len(words) GROUP BY doc_id, k, label),
every AS (SELECT doc_id, label, 0 AS share FROM base UNION ALL SELECT * FROM met),
m AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS share FROM every GROUP BY 1)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0) END AS score
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN m USING (doc_id)
"""


ORACLE = _oracle()
