"""License scans by an exact set-similarity join, in DataFrame operations only.

Notices of licenses (templates) are looked for in every block of every text. A block is a window of
words, twice as long as the longest template of its class, that starts every half window, so every run
of words as long as a template lies whole in some block. A template is found in a block that holds at
least `containment` of its different words.

Words are ordered by how many documents of the corpus have them, rare ones first. If a block shares
`least` words with a template, the first (size - least + 1) words of both have one in common (prefix
filter); a block needs `least` words at all (length filter); and where the first common word stands
bounds what can be shared after it (positional filter). What is left is verified. Words that no
template has come first in any order and share nothing, so a block is its words of the templates.

Only the templates' words, which are fixed, are broadcast or stand in a plan.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, text_key

#: What stands between words, once A to Z are lower-case.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# fixed values: phrases whose words stand consecutively, with their labels
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# fixed values: notices by which public licenses are applied, with their labels
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
]

#: The most words of the templates of a class; longer ones are in the last class.
CLASSES = (16, 64)
CONTAINMENT = 0.9


def words(text: Column) -> Column:
    """The words of a text as an array; null has none."""
    cut = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BETWEEN, -1)
    return F.filter(cut, lambda w: w != "")


def plain(text: str) -> list[str]:
    import re

    return [w for w in re.split(BETWEEN, text.translate(str.maketrans(UPPER, LOWER))) if w]


def starts(w: str, phrase: str) -> str:
    """SQL for the array of places where a phrase's words stand in array w."""
    same = " AND ".join(f"get({w}, i + {k}) = '{x}'" if k else f"{w}[i] = '{x}'" for k, x in enumerate(phrase.split()))
    return f"CASE WHEN size({w}) > 0 THEN filter(sequence(0, size({w}) - 1), i -> {same}) ELSE CAST(array() AS array<int>) END"


def classes(templates: list[tuple[str, str]], containment: float, bounds=CLASSES) -> list[dict]:
    """Templates by the class of their length: longest (words of a half block), sets (id, label, words),
    words (all of them) and least (the fewest words of a block that can be enough)."""
    found: dict[int, dict] = {}
    for n, (label, text) in enumerate(templates):
        w = plain(text)
        at = next((i for i, b in enumerate(bounds) if len(w) <= b), len(bounds) - 1)
        c = found.setdefault(at, {"longest": 1, "sets": [], "words": set(), "least": 10**9})
        own = set(w)
        if not own:
            continue
        c["longest"] = max(c["longest"], len(w))
        c["sets"].append((n, label, sorted(own)))
        c["words"] |= own
        c["least"] = min(c["least"], max(1, ceil(containment * len(own) - 1e-9)))
    return [found[i] for i in sorted(found) if found[i]["sets"]]


def scan(
    spark: SparkSession, docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, phrases: dict[str, str] = PHRASES,
    containment: float = CONTAINMENT, doc_id: str = "doc_id", text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """(documents, blocks). documents: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels and score of every row of docs. blocks: doc_id, start and end (words, from 0, end not
    included), label, template (its place in the list), shared and containment of every block that
    meets the threshold; rows that repeat doc_id and text have theirs once.

    score: the largest containment that was found, 1 where a phrase stands, else 0. A null text is
    empty; texts without words have no place and no label. Null doc_ids and rows that repeat a doc_id are
    rows like any other. An empty table gives empty results. Columns besides doc_id and text are
    ignored, whatever they are named."""
    scratch, kinds = Scratch(spark, "licenses"), classes(templates, containment)
    h1, h2 = text_key(F.col("t"))
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t")).select("doc_id", h1.alias("k1"), h2.alias("k2"), words(F.col("t")).alias("w"))
    places = {f"p{i}": F.expr(starts("w", p)) for i, p in enumerate(phrases)}
    own = own.withColumns(places)
    every = F.flatten(F.array(*places))
    labels = F.array_compact(F.array(*[F.when(F.size(f"p{i}") > 0, F.lit(x)) for i, x in enumerate(phrases.values())]))
    blocks = []
    for c in kinds:
        half = c["longest"]
        at = F.expr(f"sequence(0, greatest(size(w) - {half} - 1, 0) div {half})")
        known = F.array(*[F.lit(x) for x in sorted(c["words"])])
        cut = F.transform(at, lambda b: F.struct(b.alias("b"), F.array_intersect(known, F.slice("w", b * half + 1, 2 * half)).alias("v")))  # noqa: B023
        blocks.append(F.filter(cut, lambda s: F.size(s["v"]) >= c["least"]))  # noqa: B023
    read = own.select(
        "doc_id", "k1", "k2",
        F.size("w").cast("long").alias("n_words"), F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
        F.array_distinct(labels).alias("base"),
        *[F.array_intersect(F.array(*[F.lit(x) for x in sorted(c["words"])]), F.col("w")).alias(f"has{i}") for i, c in enumerate(kinds)],
        *[b.alias(f"blocks{i}") for i, b in enumerate(blocks)],
    )
    read = scratch.table(read, "read")
    keys = ["doc_id", "k1", "k2"]
    found = None
    for i, c in enumerate(kinds):
        # a row for each word of the templates, whatever the size of the corpus
        seen = {r["x"]: r["n"] for r in read.select(F.explode(f"has{i}").alias("x")).groupBy("x").agg(F.count(F.lit(1)).alias("n")).collect()}
        order = sorted(c["words"], key=lambda x: (seen.get(x, 0), x))
        first = []
        for n, label, own_words in c["sets"]:
            ranked = sorted(own_words, key=order.index)
            least = max(1, ceil(containment * len(ranked) - 1e-9))
            first += [(n, label, ranked, least, p, x) for p, x in enumerate(ranked[: len(ranked) - least + 1])]
        columns = ("template", "label", "words", "least", "p", "x")
        first = [F.struct(*[(F.array(*map(F.lit, v)) if isinstance(v, list) else F.lit(v)).alias(k) for k, v in zip(columns, f)]) for f in first]
        prefix = spark.range(1).select(F.inline(F.array(*first)))
        ranked = F.array_intersect(F.array(*[F.lit(x) for x in order]), "s.v").alias("v")
        rows = read.select(*keys, "n_words", F.explode(f"blocks{i}").alias("s")).select(*keys, "n_words", "s.b", ranked)
        rows = rows.select("*", F.posexplode(F.slice("v", F.lit(1), F.size("v") - c["least"] + 1)).alias("q", "x"))
        left = F.size("v")
        near = rows.join(F.broadcast(prefix), "x").where(
            (left >= F.col("least"))
            & (F.col("q") <= left - F.col("least"))
            & (F.least(F.size("words") - F.col("p"), left - F.col("q")) >= F.col("least"))
        )
        shared = near.withColumn("shared", F.size(F.array_intersect("words", "v"))).where("shared >= least")
        half = c["longest"]
        kept = shared.select(
            *keys, (F.col("b") * half).cast("long").alias("start"), F.least(F.col("n_words"), (F.col("b") + 2) * half).cast("long").alias("end"),
            "label", "template", F.col("shared").cast("long").alias("shared"), (F.col("shared") / F.size("words")).alias("containment"),
        )
        found = kept if found is None else found.unionByName(kept)
    if found is None:
        columns = "CAST(0 AS LONG) AS start, CAST(0 AS LONG) AS end, '' AS label, 0 AS template, CAST(0 AS LONG) AS shared, 0.0D AS containment"
        found = read.where("false").selectExpr(*keys, *columns.split(", "))
    found = scratch.table(found.distinct(), "found")
    own_labels = found.groupBy(*keys).agg(F.collect_set("label").alias("more"), F.max("containment").alias("best"))
    own_labels = own_labels.withColumnsRenamed({k: f"f_{k}" for k in keys})
    on = [read["doc_id"].eqNullSafe(own_labels["f_doc_id"]), read["k1"] == own_labels["f_k1"], read["k2"] == own_labels["f_k2"]]
    joined = read.join(own_labels, on, "left")
    listed = lambda a: F.array_join(F.array_sort(a), ",")
    none = F.array().cast("array<string>")
    documents = joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        listed(F.col("base")).alias("base_labels"),
        listed(F.array_union("base", F.coalesce("more", none))).alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
    return documents, found.drop("k1", "k2")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))[0]


def oracle() -> str:
    """The same by comparing every block with every template."""
    rows, at = [], 0
    for c in classes(TEMPLATES, CONTAINMENT):
        for _, label, own in c["sets"]:
            rows.append(f"({at}, '{label}', {c['longest']}, [{', '.join(repr(x) for x in own)}])")
            at += 1
    spots = []
    for phrase, label in PHRASES.items():
        same = " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(phrase.split()))
        spots.append(f"SELECT d, i - 1 AS p, '{label}' AS label FROM (SELECT d, w, unnest(range(1, len(w) + 1)) AS i FROM d) WHERE {same}")
    return rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS d, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x{{00}}-\x{{2F}}\x{{3A}}-\x{{60}}\x{{7B}}-\x{{7F}}]+') AS w
  FROM documents
), spot AS (
  {" UNION ALL ".join(spots)}
), base AS (
  SELECT d, count(*) AS n, min(p) AS lo, max(p) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM spot GROUP BY d
), t(id, label, half, own) AS (
  VALUES {", ".join(rows)}
), b AS (
  SELECT d, half, own, label, w[k * half + 1 : (k + 2) * half] AS v
  FROM (SELECT d, w, t.*, unnest(range(0, greatest(len(w) - half - 1, 0) // half + 1)) AS k FROM d, t)
), hit AS (
  SELECT d, label, len(list_intersect(own, v)) / len(own) AS c FROM b WHERE len(list_intersect(own, v)) >= ceil({CONTAINMENT} * len(own) - 1e-9)
), more AS (
  SELECT d, max(c) AS best FROM hit GROUP BY d
), named AS (
  SELECT d, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT d, label FROM hit UNION ALL SELECT d, label FROM spot) GROUP BY d
)
SELECT doc_id, len(w) AS n_words, coalesce(base.n, 0) AS n_base, lo AS first_word, hi AS last_word, coalesce(base.labels, '') AS base_labels,
       coalesce(named.labels, '') AS labels, CASE WHEN base.n > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0)::DOUBLE END AS score
FROM d LEFT JOIN base USING (d) LEFT JOIN more USING (d) LEFT JOIN named USING (d)
"""


QUERIES = {"op12_license_scan": op12}
SQL = {"op12_license_scan": oracle()}
