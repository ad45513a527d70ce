"""Operator 1: licence scans by an exact set-similarity join (native functions only).

Every text is cut into overlapping blocks of words; a template (the words of a
licence notice) is found in a block when at least ``threshold`` of its distinct
words stand there.  The join of blocks and templates is exact:

* the template words are put into one global order, rarest first, by their document
  counts over the whole corpus;
* prefix filter: a block that holds ``need = ceil(threshold * size)`` words of a
  template holds one of its ``size - need + 1`` rarest words, so blocks meet
  templates on those words only, and texts without any of them have no blocks;
* length filter: a block needs at least ``need`` different template words;
* positional filter: what stands after the meeting word, in block and template,
  must still suffice; a pair is kept at its first meeting word only.

Only template words are collected and broadcast (the templates are a parameter, so
their number is bounded).  Besides, the places of fixed phrases are counted.

Null text is empty: no words, no labels, score 0.  Repeated rows and null ids are
results of their own (rows are told apart by position).
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, table

# The words that count, the base phrases and their labels.
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices as their licences word them, and the labels they give.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files to deal in the software without restriction"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl", "licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
]
THRESHOLD = (9, 10)
BLOCK, STRIDE = 64, 32        # words in a block, and between block starts


def words(text) -> F.Column:
    """Lower-cased words; the one other character that lower() turns into a-z stays out."""
    safe = F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ"))
    return F.regexp_extract_all(F.lower(safe), F.lit(WORDS), F.lit(0))


def _need(size: int, threshold) -> int:
    return -(-threshold[0] * size // threshold[1])


def _places(w, phrases: dict) -> F.Column:
    """array<struct<at, label>> of the places where a phrase's words stand."""
    def starts(phrase, label):
        parts = phrase.split()
        def here(i):
            ok = F.lit(True)
            for k, p in enumerate(parts):
                ok = ok & F.coalesce(F.get(w, i + k) == p, F.lit(False))
            return ok
        hits = F.filter(F.sequence(F.lit(0), F.size(w) - len(parts)), here)
        hits = F.transform(hits, lambda i: F.struct(i.cast("long").alias("at"), F.lit(label).alias("label")))
        possible = (F.size(w) >= len(parts)) & F.arrays_overlap(w, F.array(F.lit(parts[0]))) \
            & F.arrays_overlap(w, F.array(F.lit(parts[-1])))
        return F.when(possible, hits).otherwise(F.array().cast("array<struct<at:bigint,label:string>>"))
    return F.flatten(F.array(*[starts(p, l) for p, l in phrases.items()]))


def scan(df: DataFrame, text: str = "text", key: str = "doc_id", templates=TEMPLATES, phrases=PHRASES,
         threshold=THRESHOLD, block: int = BLOCK, stride: int = STRIDE) -> DataFrame:
    """Per row of ``df``: ``doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score`` (best containment of a found template; 1 where a phrase stands) and
    ``n_blocks``, the matched (block, template) pairs."""
    spark = df.sparkSession
    sets = [(label, sorted(set(t.split()))) for label, t in templates]
    docs = df.select(F.col(key).alias("doc_id"), words(F.col(text)).alias("w"))
    # global order of the template words, rarest first
    vocabulary = sorted({t for _, s in sets for t in s})
    hits = docs.select(F.explode(F.array_intersect(F.array(*map(F.lit, vocabulary)), "w")).alias("t"))
    counts = {r["t"]: r["count"] for r in hits.groupBy("t").count().collect()}     # template words only
    order = sorted(vocabulary, key=lambda t: (counts.get(t, 0), t))
    rank = {t: i for i, t in enumerate(order)}
    rows = []
    for n, (label, s) in enumerate(sets):
        s = sorted(s, key=rank.get)
        need = _need(len(s), threshold)
        rows += [(s[p], n, label, p, s, need) for p in range(len(s) - need + 1)]
    prefixes = spark.createDataFrame(rows, "t string, template int, label string, p int, s array<string>, need int")
    rare = F.array(*[F.lit(t) for t in sorted({r[0] for r in rows})])
    ordered = F.array(*map(F.lit, order))
    least = min(r[5] for r in rows)

    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - stride - 1, F.lit(0)), F.lit(stride))
    blocks = F.transform(starts, lambda i: F.array_intersect(ordered, F.slice("w", i + 1, block)))
    blocks = F.filter(blocks, lambda b: (F.size(b) >= least) & F.arrays_overlap(b, rare))
    base = docs.select(
        F.monotonically_increasing_id().alias("rid"), "doc_id", F.size("w").cast("long").alias("n_words"),
        _places(F.col("w"), phrases).alias("places"),
        F.when(F.arrays_overlap("w", rare), blocks).otherwise(F.array().cast("array<array<string>>")).alias("blocks"))
    met = (base.select("rid", "doc_id", "n_words", "places", F.explode_outer("blocks").alias("b"))
           .select("*", F.explode_outer(F.array_intersect("b", rare)).alias("t")))
    after = F.size("b") - F.array_position("b", F.col("t"))                    # block words behind the meeting word
    common = F.size(F.array_intersect("s", "b"))
    earlier = F.size(F.array_intersect(F.slice("s", 1, F.col("p")), "b"))
    found = (met.join(F.broadcast(prefixes), "t", "left")
             .withColumn("ok", F.coalesce((F.size("b") >= F.col("need"))
                                          & (F.least(after, F.size("s") - F.col("p") - 1) + 1 >= F.col("need"))
                                          & (earlier == 0) & (common >= F.col("need")), F.lit(False)))
             .withColumn("part", F.when(F.col("ok"), common / F.size("s"))))
    per_doc = found.groupBy("rid").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.first("places").alias("places"),
        F.collect_set(F.when(F.col("ok"), F.col("label"))).alias("more"), F.max("part").alias("part"),
        F.count_if("ok").alias("n_blocks"))
    at, own = F.col("places.at"), F.array_distinct(F.col("places.label"))
    return per_doc.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"),
        F.array_join(F.array_sort(own), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(own, "more")), ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce("part", F.lit(0.0))).alias("score"), "n_blocks")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    """The same results in DuckDB, every block against every template."""
    lists = ",\n  ".join(f"({i}, '{l}', {sorted(set(t.split()))!r})" for i, (l, t) in enumerate(TEMPLATES))
    base = "\n  UNION ALL ".join(
        f"SELECT rid, i - 1 AS pos, '{label}' AS label FROM i WHERE i <= n_words - {len(p.split()) - 1} AND "
        + " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(p.split())) for p, label in PHRASES.items())
    return f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
  regexp_extract_all(lower(replace(coalesce(text, ''), chr(8490), chr(312))), '{WORDS}') AS w FROM documents),
i AS (SELECT rid, w, len(w) AS n_words, unnest(range(1, len(w) + 1)) AS i FROM d),
p AS ({base}),
pb AS (SELECT rid, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word,
  array_to_string(list_sort(list_distinct(list(label))), ',') AS base_labels, list_distinct(list(label)) AS own FROM p GROUP BY rid),
t(template, label, s) AS (VALUES {lists}),
b AS (SELECT rid, list_distinct(w[k + 1:k + {BLOCK}]) AS b FROM (SELECT rid, w, unnest(range(0, greatest(len(w) - {STRIDE + 1}, 0) + 1, {STRIDE})) AS k FROM d)),
m AS (SELECT rid, label, len(list_intersect(b, s)) AS c, len(s) AS z FROM b, t),
g AS (SELECT rid, list_distinct(list(label)) AS more, max(c / z) AS part, count(*) AS n_blocks FROM m WHERE c * {THRESHOLD[1]} >= z * {THRESHOLD[0]} GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
  CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(own, []), coalesce(more, [])))), ','), '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(part, 0)::DOUBLE END AS score, CAST(coalesce(n_blocks, 0) AS BIGINT) AS n_blocks
FROM d LEFT JOIN pb USING (rid) LEFT JOIN g USING (rid)"""


QUERIES = {"op1_license_scan": op1_license_scan}
SQL = {"op1_license_scan": _sql()}
