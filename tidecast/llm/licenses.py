"""License scans by diagonal voting, in DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidecast.session import materialise

from .common import table

GRAM = 3  # words of a k-gram
DRIFT = 3  # diagonals that lie this near are one passage with words put in or left out
VERIFIED = 0.8  # share of a template's words that a passage must hold
MOST_SENT = 1 << 20  # template k-grams that may be sent to every task
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases that give a label wherever they stand.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Public notices of common licenses and the labels of their passages.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
            "publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("apache", 'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
            "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
             "published by the Free Software Foundation"),
    ("agpl", "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
            "above copyright notice and this permission notice appear in all copies."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)

UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_in(text: Column) -> Column:
    """Words of a text, A-Z lower-cased: runs of letters, digits and characters beyond ASCII."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, SMALL), BETWEEN), "")


def places(words: Column, phrase: str) -> Column:
    """First words of the places where a phrase's words stand one behind the other."""
    own = phrase.split()
    last = F.size(words) - len(own)
    here = lambda i: reduce(Column.__and__, [F.get(words, i + j) == w for j, w in enumerate(own)])
    return F.when((last >= 0) & F.array_contains(words, own[-1]), F.filter(F.sequence(F.lit(0), last), here)).otherwise(F.array().cast("array<int>"))


def template_grams(spark: SparkSession, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """(template, label, n_template, at, t_0 ..., gram): every k-gram of every template with its position.

    A template of fewer than GRAM words has none and is never found.
    """
    rows = spark.createDataFrame([(i, label, text) for i, (label, text) in enumerate(templates)], "template int, label string, notice string")
    cut = rows.select("template", "label", words_in(F.col("notice")).alias("t")).withColumn("n_template", F.size("t"))
    cut = cut.where(F.col("n_template") >= GRAM).withColumn("at", F.explode(F.sequence(F.lit(0), F.col("n_template") - GRAM)))
    parts = [F.get("t", F.col("at") + j).alias(f"t_{j}") for j in range(GRAM)]
    return cut.select("template", "label", "n_template", "at", *parts).withColumn("gram", F.xxhash64(*[f"t_{j}" for j in range(GRAM)]))


def key_of(doc_id: Column, text: Column) -> list[Column]:
    """What a row's findings hang on: its id and its text by content."""
    return [doc_id.alias("doc_id"), F.unhex(F.md5(F.coalesce(text, F.lit("")))).alias("content")]


def passages(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """(doc_id, content, template, label, share, held, begin, end) of the best passage of every template that a text votes for.

    All rolling k-grams of all texts meet the templates' k-grams in a join on their hashes, and their words
    are compared. A match at word p of the text and q of the template votes for diagonal p - q. Diagonals
    within DRIFT of each other are merged, around each of them in turn, and what they hold of the template
    is counted word by word, from the matches' own words, so no text is read twice: share is the part of
    the template's words that stand in the words begin to end of the text, held their number. Rows with equal id and text
    share their votes, which are sets of positions.
    """
    spark = docs.sparkSession
    grams = template_grams(spark, templates)
    if grams.count() <= MOST_SENT:
        grams = F.broadcast(grams)
    rows = docs.select(*key_of(docs[doc_id], docs[text]), words_in(docs[text]).alias("w")).where(F.size("w") >= GRAM)
    hashes = F.transform(F.sequence(F.lit(0), F.size("w") - GRAM), lambda i: F.xxhash64(*[F.get("w", i + j) for j in range(GRAM)]))
    rolled = rows.select("doc_id", "content", "w", F.posexplode(hashes).alias("pos", "rolling"))
    same = reduce(Column.__and__, [F.get("w", F.col("pos") + j) == F.col(f"t_{j}") for j in range(GRAM)])
    votes = rolled.join(grams, (F.col("rolling") == F.col("gram")) & same).select("doc_id", "content", "template", "label", "n_template", (F.col("pos") - F.col("at")).alias("diagonal"), "at")
    diagonals = votes.groupBy("doc_id", "content", "template", "label", "n_template", "diagonal").agg(F.collect_set("at").alias("ats"))
    near = Window.partitionBy("doc_id", "content", "template").orderBy("diagonal").rangeBetween(-DRIFT, DRIFT)
    merged = diagonals.withColumn("hits", F.collect_list(F.struct("diagonal", "ats")).over(near))
    held = F.size(F.array_distinct(F.flatten(F.flatten(F.transform("hits", lambda h: F.transform(h["ats"], lambda a: F.array(*[a + j for j in range(GRAM)])))))))
    begin = F.array_min(F.transform("hits", lambda h: h["diagonal"] + F.array_min(h["ats"])))
    end = F.array_max(F.transform("hits", lambda h: h["diagonal"] + F.array_max(h["ats"]))) + GRAM
    spans = merged.select("doc_id", "content", "template", "label", (held / F.col("n_template")).alias("share"), held.alias("held"), begin.alias("begin"), end.alias("end"))
    best = F.max(F.struct("share", (-F.col("begin")).alias("first"), F.col("end"), F.col("held"))).alias("best")
    return spans.groupBy("doc_id", "content", "template", "label").agg(best).select("doc_id", "content", "template", "label", "best.share", "best.held", (-F.col("best.first")).alias("begin"), "best.end")


def better(q: Column, p: Column) -> Column:
    """Whether passage q, of another label, covers half of p and fits its template better."""
    shared = F.least(p["end"], q["end"]) - F.greatest(p["begin"], q["begin"])
    fits = (q["share"] > p["share"]) | ((q["share"] == p["share"]) & (q["held"] > p["held"]))
    return (q["label"] != p["label"]) & (shared * 2 >= p["end"] - p["begin"]) & fits


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", templates: tuple[tuple[str, str], ...] = TEMPLATES, phrases: tuple[tuple[str, str], ...] = PHRASES) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, passages.

    Base labels are those of the phrases, wherever their words stand one behind the other; n_base counts
    these places, first_word and last_word are the least and greatest of their first words (null without
    any). labels adds those of templates of which a passage holds VERIFIED of the words, unless a passage of
    another label that covers half of it fits better (a greater share, then more words). score is the
    greatest share of a template found, and at least VERIFIED where a phrase stands. passages lists label,
    begin, end and share of the ones that count, by begin. A null text is empty and has no words; repeated
    rows each get their row; of equally good passages of a template the first is listed. Only the two
    named columns are read. No documents give no rows.
    """
    best = materialise(passages(docs, text, doc_id, templates), "passages")
    good = F.filter(F.array_sort(F.collect_list(F.struct("begin", "end", "label", "share", "held"))), lambda p: p["share"] >= VERIFIED)
    found = best.groupBy(F.col("doc_id").alias("found_id"), F.col("content").alias("found_content")).agg(good.alias("passages"), F.max("share").alias("share"))
    found = found.withColumn("passages", F.filter("passages", lambda p: ~F.exists("passages", lambda q: better(q, p))))
    w = F.col("w")
    places_of = [places(w, p).alias(f"p_{i}") for i, (p, _) in enumerate(phrases)]
    rows = docs.select(*key_of(docs[doc_id], docs[text]), words_in(docs[text]).alias("w")).select("doc_id", "content", F.size("w").cast("long").alias("n_words"), *places_of)
    everywhere = F.concat(*[F.col(f"p_{i}") for i in range(len(phrases))])
    named = F.array_distinct(F.array_compact(F.array(*[F.when(F.size(f"p_{i}") > 0, F.lit(label)) for i, (_, label) in enumerate(phrases)])))
    slim = rows.select(
        "doc_id", "content", "n_words", F.size(everywhere).cast("long").alias("n_base"), F.array_min(everywhere).cast("long").alias("first_word"),
        F.array_max(everywhere).cast("long").alias("last_word"), F.array_sort(named).alias("base"),
    )
    met = slim.join(found, slim["doc_id"].eqNullSafe(found["found_id"]) & (slim["content"] == found["found_content"]), "left")
    more = F.coalesce(F.transform("passages", lambda p: p["label"]), F.array().cast("array<string>"))
    score = F.greatest(F.coalesce("share", F.lit(0.0)), F.when(F.col("n_base") > 0, F.lit(VERIFIED)).otherwise(F.lit(0.0)))
    none = F.array().cast("array<struct<begin:int,end:int,label:string,share:double,held:int>>")
    return met.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("base", more))), ",").alias("labels"), score.alias("score"), F.coalesce("passages", none).alias("passages"),
    )


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).drop("passages")


_WORDS = f"regexp_extract_all(translate({{}}, '{UPPER}', '{SMALL}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_NOTICES = ", ".join("({}, '{}', '{}')".format(i, label, text.replace("'", "''")) for i, (label, text) in enumerate(TEMPLATES))
_PHRASES = ", ".join(f"('{p}', '{label}')" for p, label in PHRASES)
SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS row_no, doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents
), t AS (
  SELECT template, label, {_WORDS.format("notice")} AS ts FROM (VALUES {_NOTICES}) v(template, label, notice)
), tg AS (
  SELECT template, label, len(ts) AS n, q, array_to_string(ts[q + 1:q + {GRAM}], ' ') AS gram FROM (SELECT *, unnest(range(0, len(ts) - {GRAM} + 1)) AS q FROM t)
), dg AS (
  SELECT row_no, pos, array_to_string(ws[pos + 1:pos + {GRAM}], ' ') AS gram FROM (SELECT *, unnest(range(0, len(ws) - {GRAM} + 1)) AS pos FROM d)
), v AS (
  SELECT DISTINCT row_no, template, label, n, pos - q AS diagonal, q FROM dg JOIN tg USING (gram)
), m AS (
  SELECT row_no, template, label, center, count(DISTINCT q + j) AS held, count(DISTINCT q + j) / n AS share, min(center + gap + q) AS begin_, max(center + gap + q) + {GRAM} AS end_ FROM (
    SELECT c.row_no, c.template, c.label, c.n, c.diagonal AS center, v.diagonal - c.diagonal AS gap, v.q
    FROM (SELECT DISTINCT row_no, template, label, n, diagonal FROM v) c
    JOIN v ON v.row_no = c.row_no AND v.template = c.template AND abs(v.diagonal - c.diagonal) <= {DRIFT}), range({GRAM}) r(j)
  GROUP BY row_no, template, label, center, n
), b AS (
  SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY row_no, template ORDER BY share DESC, begin_, end_ DESC) = 1
), g AS (
  SELECT row_no, label FROM b WHERE share >= {VERIFIED} AND NOT EXISTS (
    SELECT 1 FROM b o WHERE o.row_no = b.row_no AND o.label <> b.label AND o.share >= {VERIFIED}
      AND (least(o.end_, b.end_) - greatest(o.begin_, b.begin_)) * 2 >= b.end_ - b.begin_ AND (o.share > b.share OR (o.share = b.share AND o.held > b.held)))
), s AS (
  SELECT row_no, max(share) AS share FROM b GROUP BY 1
), p AS (
  SELECT row_no, label, i - 1 AS first FROM (SELECT row_no, ws, unnest(range(1, len(ws) + 1)) AS i FROM d), (VALUES {_PHRASES}) x(phrase, label)
  WHERE ws[i] = string_split(phrase, ' ')[1] AND array_to_string(ws[i:i + len(string_split(phrase, ' ')) - 1], ' ') = phrase
), pp AS (
  SELECT row_no, count(*) AS n_base, min(first) AS first_word, max(first) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM p GROUP BY 1
), l AS (
  SELECT row_no, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT row_no, label FROM p UNION SELECT row_no, label FROM g) GROUP BY 1
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       greatest(coalesce(share, 0), CASE WHEN n_base > 0 THEN {VERIFIED} ELSE 0 END)::DOUBLE AS score
FROM d LEFT JOIN pp USING (row_no) LEFT JOIN l USING (row_no) LEFT JOIN s USING (row_no)
"""
