"""License scan by diagonal voting, in DataFrame expressions only.

Words are runs of letters and digits of the text with A-Z lower-cased.  Base
phrases are counted where their words stand consecutively.  Templates are
license notices: every rolling three-word gram of a document is hashed and
looked up among the hashes of the templates' grams; the grams that hit are
joined with all template positions of their hash.  Each match votes for its
diagonal (word in the document minus word in the template).  Neighbouring
diagonals of one template (a few inserted or missing words) are merged into one
span, no longer than the template and those words, and a span counts when its
words, compared as text, cover enough of the template in the template's order.

Defined results: NULL or empty text has no words, no labels, score 0 and NULL
first and last words; NULL ids and repeated rows are judged like any row; an
empty table gives an empty result; very long texts are scanned whole, each place
of a notice is a span of its own; other columns are not read.

At scale: nothing of a document is shuffled but its few hits.  The look-up
keeps a gram when its hash is one of the templates' (a constant set, a few
hundred values), which is the join's own semi-join applied before the grams
become rows; the join with template positions follows.  The hits are staged with a
row number, so equal ids stay apart.  Groups are hits of one document on one
template.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from freightlake.llm.common import ascii_lower, let, stage, word_list

#: Everything that is not a word character (ASCII letters and digits, and all
#: characters beyond ASCII).
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAM = 3
#: Inserted and missing words that a span bears: its diagonals lie that near each other.
SLACK = 6

# Base phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# License notices by label.
TEMPLATES = (
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc0", "no rights reserved this work is dedicated to the public domain"),
    ("gpl-notice", "this work is licensed under the gnu general public license version 3"),
    ("gpl-notice", "free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mpl", "subject to the terms of the mozilla public license v 2 0"),
)


def template_grams(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """(hash, gram, template, label, size, at) of every gram of every template."""
    rows = [(" ".join(w[i:i + GRAM]), *w[i:i + GRAM], t, label, len(w), i)
            for t, (label, text) in enumerate(templates)
            for w in [text.split()] for i in range(len(w) - GRAM + 1)]
    words = [f"w{k}" for k in range(GRAM)]
    return (spark.createDataFrame(rows, "gram string, " + ", ".join(f"{w} string" for w in words)
                                  + ", template int, label string, size int, at int")
            .select(F.xxhash64(*words).alias("hash"), "gram", "template", "label", "size", "at"))


def _phrase_hits(w: Column, phrases) -> Column:
    """(at, label) of every place of a phrase."""
    def here(i: Column, phrase: str) -> Column:
        parts = phrase.split()
        test = F.get(w, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            test = test & F.coalesce(F.get(w, i + k) == part, F.lit(False))
        return test

    def places(phrase: str, label: str) -> Column:
        starts = F.filter(F.transform(w, lambda x, i: i), lambda i: here(i, phrase))
        found = F.transform(starts, lambda i: F.struct(i.cast("long").alias("at"), F.lit(label).alias("label")))
        # word lists without the phrase's last word are not scanned place by place
        return F.when(F.array_contains(w, phrase.split()[-1]), found).otherwise(
            F.array().cast("array<struct<at:bigint,label:string>>"))

    return F.flatten(F.array(*(places(*x) for x in phrases)))


def scan_words(df: DataFrame, id_col: str, text_col: str, hashes: list[int], phrases=PHRASES) -> DataFrame:
    """One row for each document: row, id, n_words, base (phrase places) and
    hits (grams that are a template's)."""
    def grams(w: Column) -> Column:
        starts = F.when(F.size(w) >= GRAM, F.filter(
            F.sequence(F.lit(0), F.size(w) - GRAM),
            lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(GRAM)]).isin(hashes)))
        return F.transform(starts, lambda i: F.struct(
            i.alias("at"), F.concat_ws(" ", *[F.get(w, i + k) for k in range(GRAM)]).alias("gram")))

    words = word_list(ascii_lower(F.col(text_col)), BETWEEN)
    found = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"),
                                          _phrase_hits(w, phrases).alias("base"), grams(w).alias("hits")))
    return (df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), found.alias("s"))
            .select("row", "id", "s.*"))


def spans(scanned: DataFrame, templates: DataFrame, slack: int = SLACK, least: float = 0.7) -> DataFrame:
    """(row, label, first, last, coverage) of the verified spans.

    Votes are counted by diagonal.  Each diagonal with votes is a base, merged with those
    up to ``slack`` above it: places of a template of n words on them lie within n + slack
    words of the document.  A base is verified when the template's places found there, each
    at its first place in the document, cover enough of the template in its order: a place
    counts if it stands behind all places of earlier ones.  Verified bases within ``slack``
    of each other are one span, with the coverage of the best.
    """
    hits = (scanned.where(F.size("hits") > 0).select("row", F.explode("hits").alias("h"))
            .select("row", F.col("h.at").alias("pos"), F.col("h.gram").alias("gram")))
    votes = (hits.join(F.broadcast(templates), "gram")
             .withColumn("diagonal", F.col("pos") - F.col("at"))
             .groupBy("row", "template", "label", "size", "diagonal")
             .agg(F.collect_set("at").alias("ats")))
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    near = F.collect_list(F.struct("diagonal", "ats")).over(order.rangeBetween(0, slack))

    def place(at: Column) -> Column:
        on = F.filter(F.col("near"), lambda d: F.array_contains(d["ats"], at))
        return F.struct(at.alias("at"), (F.array_min(F.transform(on, lambda d: d["diagonal"])) + at).alias("pos"))

    found = F.filter(F.transform(F.sequence(F.lit(0), F.col("size") - GRAM), place), lambda x: x["pos"].isNotNull())
    in_order = F.filter(F.col("found"), lambda x, i: F.coalesce(
        x["pos"] > F.array_max(F.transform(F.slice("found", 1, i), lambda y: y["pos"])), F.lit(True)))
    words = F.array_distinct(F.flatten(F.transform("places", lambda x: F.sequence(x["at"], x["at"] + GRAM - 1))))
    verified = (votes.withColumn("near", near).withColumn("found", found).withColumn("places", in_order)
                .withColumn("coverage", F.size(words) / F.col("size")).where(F.col("coverage") >= least)
                .select("row", "template", "label", "diagonal", "coverage", F.array_min("places.pos").alias("first"),
                        (F.array_max("places.pos") + GRAM - 1).alias("last")))
    new = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > slack, F.lit(True)).cast("int")
    return (verified.withColumn("new", new).withColumn("span", F.sum("new").over(order))
            .groupBy("row", "template", "label", "span")
            .agg(F.min("first").cast("long").alias("first"), F.max("last").cast("long").alias("last"),
                 F.max("coverage").alias("coverage"))
            .select("row", "label", "first", "last", "coverage"))


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """One row for each document: id, n_words, n_base, first_word, last_word
    (starts of base phrases), base_labels, labels, score (greatest covered share
    of a template or phrase) and n_spans (verified template spans)."""
    known = template_grams(df.sparkSession, templates)
    hashes = [r[0] for r in known.select("hash").distinct().collect()]  # the templates' own, a constant set
    scanned = stage(scan_words(df, id_col, text_col, hashes, phrases), "license-hits")
    by_row = (spans(scanned, known.drop("hash")).groupBy("row")
              .agg(F.collect_set("label").alias("more"), F.max("coverage").alias("coverage"), F.count("*").alias("n_spans")))
    base_labels = F.array_distinct(F.col("base.label"))
    none = F.array().cast("array<string>")
    joined = lambda a: F.array_join(F.array_sort(a), ",")
    return (scanned.drop("hits").join(by_row, "row", "left")
            .select(F.col("id").alias(id_col), "n_words", F.size("base").cast("long").alias("n_base"),
                    F.array_min(F.col("base.at")).alias("first_word"), F.array_max(F.col("base.at")).alias("last_word"),
                    joined(base_labels).alias("base_labels"),
                    joined(F.array_union(base_labels, F.coalesce("more", none))).alias("labels"),
                    F.greatest(F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.lit(0.0)),
                               F.coalesce("coverage", F.lit(0.0))).alias("score"),
                    F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans")))


def oracle(templates=TEMPLATES, phrases=PHRASES) -> str:
    """DuckDB SQL of ``scan_licenses`` over ``documents`` with distinct ids."""
    t = ", ".join(f"({k}, '{label}', '{text}')" for k, (label, text) in enumerate(templates))
    p = ", ".join(f"('{phrase}', '{label}', {len(phrase.split())})" for phrase, label in phrases)
    return rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
phrases(phrase, label, n) AS (VALUES {p}),
templates(template, label, body) AS (VALUES {t}),
b AS (
  SELECT doc_id, i, label FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM w) x
  JOIN phrases ON array_to_string(words[i:i + n - 1], ' ') = phrase),
tw AS (SELECT template, label, string_split(body, ' ') AS words FROM templates),
tg AS (
  SELECT template, label, len(words) AS size, place, array_to_string(words[place + 1:place + 3], ' ') AS gram
  FROM (SELECT *, unnest(range(0, len(words) - 2)) AS place FROM tw)),
g AS (
  SELECT doc_id, pos, array_to_string(words[pos + 1:pos + 3], ' ') AS gram
  FROM (SELECT *, unnest(range(0, len(words) - 2)) AS pos FROM w)),
d AS (
  SELECT DISTINCT doc_id, template, label, size, pos - place AS diagonal, place FROM g JOIN tg USING (gram)),
m AS (
  SELECT d.doc_id, d.template, d.label, d.size, b.diagonal AS base, d.place, min(d.diagonal) + d.place AS pos
  FROM (SELECT DISTINCT doc_id, template, diagonal FROM d) b
  JOIN d ON d.doc_id = b.doc_id AND d.template = b.template AND d.diagonal BETWEEN b.diagonal AND b.diagonal + {SLACK}
  GROUP BY d.doc_id, d.template, d.label, d.size, b.diagonal, d.place),
r AS (
  SELECT *, max(pos) OVER (PARTITION BY doc_id, template, base ORDER BY place
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS behind FROM m),
c AS (
  SELECT doc_id, template, label, base, count(DISTINCT k) / size AS coverage
  FROM (SELECT *, unnest([place, place + 1, place + 2]) AS k FROM r WHERE behind IS NULL OR pos > behind)
  GROUP BY doc_id, template, label, size, base),
v AS (
  SELECT *, CASE WHEN base - lag(base) OVER (PARTITION BY doc_id, template ORDER BY base) <= {SLACK} THEN 0 ELSE 1 END AS new
  FROM c WHERE coverage >= 0.7),
s AS (
  SELECT doc_id, list(DISTINCT label) AS labels, max(coverage) AS coverage, sum(new) AS n_spans
  FROM v GROUP BY doc_id),
f AS (
  SELECT doc_id, count(*) AS n_base, min(i) - 1 AS first_word, max(i) - 1 AS last_word, list(DISTINCT label) AS labels
  FROM b GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(f.labels), ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(f.labels, []), coalesce(s.labels, [])))), ',') AS labels,
       greatest(CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END, coalesce(coverage, 0.0::DOUBLE)) AS score,
       coalesce(n_spans, 0)::BIGINT AS n_spans
FROM w LEFT JOIN f ON f.doc_id = w.doc_id LEFT JOIN s ON s.doc_id = w.doc_id
"""
