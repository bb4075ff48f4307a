"""License scans: phrases, and an exact set-similarity join with templates.

Blocks are the runs of up to ``MAX_LINES`` consecutive lines of a text, so that
a wrapped notice is one block, too. Blocks and templates are sets of words; a
block carries a template's label when it holds at least ``MIN_CONTAINMENT`` of
the template's words. Words are ordered by their frequency over all blocks,
rarest first. A qualifying block and the template share a word of both their
prefixes under that order (prefix filter), the block has enough words (length
filter), and the words after the first shared one leave enough overlap
(positional filter); only pairs that pass are compared. Blocks are reduced to
words that occur in templates first, as others can't add to an overlap.

The order of words and the templates are bounded by the template list, so they
are literals of the plan; all work on texts is DataFrame functions.

Defined results: words and lines of a null text are those of an empty one.
Texts without a place have null first and last words, empty labels and score
0. Rows are told apart by id and text hash, so ties of ids don't mix texts and
repeated rows get equal results. An empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import materialize, table

# Phrases that count as places, with their labels
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Notices whose words a block has to hold, with the labels that they add
TEMPLATES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "licensed under the gnu general public license version 3": "gpl-3.0",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "released under the mit license": "mit-release",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit-grant",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "this program is free software you can redistribute it and or modify it under the terms": "gpl-notice",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
}
MIN_CONTAINMENT = 0.8
MAX_LINES = 3   # the longest template, wrapped at 40 characters
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_RAW_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_RAW_WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _lower(col: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(col, string.ascii_uppercase, string.ascii_lowercase)


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SEPARATORS), lambda w: w != "")


def _places(words: Column, phrase: str) -> Column:
    want = phrase.split()

    def here(i: Column) -> Column:
        ok = F.lit(True)
        for k, w in enumerate(want):
            ok = ok & (F.get(words, i + k) == w)
        return ok

    room = F.size(words) - len(want)
    return F.filter(F.when(room >= 0, F.sequence(F.lit(0), room)).otherwise(F.array().cast("array<int>")), here)


def phrase_places(docs: DataFrame) -> DataFrame:
    """Per row: id, text hash, word count, and the places and labels of the phrases."""
    any_phrase = "(?i)" + "|".join(_RAW_SEPARATORS.join(p.split()) for p in PHRASES)
    held = F.when(_text().rlike(any_phrase), _words(_lower(_text()))).otherwise(F.array().cast("array<string>"))
    out = docs.select("doc_id", F.xxhash64("text").alias("text_hash"),
                      F.regexp_count(_text(), F.lit(_RAW_WORDS)).cast("long").alias("n_words"), held.alias("words"))
    names = {f"p{i}": (p, label) for i, (p, label) in enumerate(PHRASES.items())}
    out = out.select("doc_id", "text_hash", "n_words", *[_places(F.col("words"), p).alias(c) for c, (p, _) in names.items()])
    every = F.concat(*names)
    found = F.array_compact(F.array(*[F.when(F.size(c) > 0, F.lit(label)) for c, (_, label) in names.items()]))
    return out.select("doc_id", "text_hash", "n_words", F.size(every).cast("long").alias("n_base"),
                      F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
                      F.array_sort(F.array_distinct(found)).alias("base"))


def template_blocks(docs: DataFrame, max_lines: int = MAX_LINES) -> DataFrame:
    """(doc_id, text_hash, block, lines, words): the template words of every run of ``lines`` lines from ``block`` on.

    Runs without such words, and longer runs that add none in their last line to
    those of the run before it, are left out: no template fits them better."""
    vocab = F.array(*[F.lit(w) for w in sorted({w for t in TEMPLATES for w in t.split()})])
    split = F.split(_lower(_text()), "\n")
    held = docs.select("doc_id", F.xxhash64("text").alias("text_hash"),
                       F.transform(split, lambda x: F.array_intersect(F.split(x, SEPARATORS), vocab)).alias("sets"))

    def runs(words: Column, i: Column) -> Column:
        out, so_far = [], words
        for n in range(1, max_lines + 1):
            more = so_far if n == 1 else F.array_union(so_far, F.coalesce(F.get("sets", i + n - 1), F.array().cast("array<string>")))
            # a run of one line, or one with a new word
            new = F.size(words) > 0 if n == 1 else F.size(more) > F.size(so_far)
            out.append(F.when(new, F.struct(i.alias("block"), F.lit(n).alias("lines"), more.alias("words"))))
            so_far = more
        return F.array_compact(F.array(*out))

    return held.select("doc_id", "text_hash", F.inline(F.flatten(F.transform("sets", runs)))).where(F.size("words") > 0)


def containment_join(blocks: DataFrame, least: float = MIN_CONTAINMENT) -> DataFrame:
    """(doc_id, text_hash, block, lines, label, containment) of every qualifying pair."""
    spark = blocks.sparkSession
    counts = blocks.select(F.explode("words").alias("w")).groupBy("w").count().collect()   # template words at most
    freq = {r["w"]: r["count"] for r in counts}
    order = sorted({w for t in TEMPLATES for w in t.split()}, key=lambda w: (freq.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    rows, needs = [], []
    for t, label in TEMPLATES.items():
        words = sorted(set(t.split()), key=rank.get)
        need = math.ceil(least * len(words))
        needs.append(need)
        rows += [(label, words, need, i, w) for i, w in enumerate(words[:len(words) - need + 1])]
    prefixes = spark.createDataFrame(rows, "label string, t_words array<string>, need int, i int, w string")
    ordered = F.array_intersect(F.array(*[F.lit(w) for w in order]), F.col("words"))
    short = min(needs)
    b = (blocks.where(F.size("words") >= short).withColumn("words", ordered)
         .select("doc_id", "text_hash", "block", "lines", "words",
                 F.posexplode(F.slice("words", 1, F.size("words") - short + 1)).alias("j", "w")))
    size, t_size = F.size("words"), F.size("t_words")
    after = F.least(t_size - F.col("i"), size - F.col("j"))   # the shared word and those behind it
    pairs = (b.join(F.broadcast(prefixes), "w")               # bounded by the template list
             .where((size >= F.col("need")) & (F.col("j") <= size - F.col("need")) & (after >= F.col("need")))
             .select("doc_id", "text_hash", "block", "lines", "words", "label", "t_words", "need").distinct())
    overlap = F.size(F.array_intersect("words", "t_words"))
    return (pairs.where(overlap >= F.col("need"))
            .select("doc_id", "text_hash", "block", "lines", "label", (overlap / t_size).alias("containment")))


def license_labels(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: the phrase columns, all labels and the best containment."""
    pairs = containment_join(materialize(template_blocks(docs), "blocks"))
    found = (pairs.groupBy(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"))
             .agg(F.collect_set("label").alias("own"), F.max("containment").alias("best")))
    out = phrase_places(docs)
    out = out.join(found, out["doc_id"].eqNullSafe(F.col("d")) & (out["text_hash"] == F.col("h")), "left")
    none = F.array().cast("array<string>")
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                      F.array_join("base", ",").alias("base_labels"),
                      F.array_join(F.array_sort(F.array_union("base", F.coalesce("own", none))), ",").alias("labels"),
                      F.coalesce("best", F.lit(0.0)).alias("score"))


def op5_license_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_labels(table(spark, sf_dir, "documents"))


def _sql() -> str:
    templates = ", ".join(f"('{label}', string_split('{t}', ' '))" for t, label in TEMPLATES.items())
    phrases = ", ".join(f"('{label}', string_split('{p}', ' '))" for p, label in PHRASES.items())
    low = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    words = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return f"""
WITH t AS (SELECT label, list_distinct(words) AS words FROM (VALUES {templates}) v(label, words)),
p AS (SELECT label, words FROM (VALUES {phrases}) v(label, words)),
d AS (SELECT doc_id, {low} AS low, regexp_extract_all({low}, '{words}') AS words FROM documents),
l AS (SELECT doc_id, array_to_string(x[i:i + k], chr(10)) AS line
      FROM (SELECT doc_id, x, k, unnest(range(1, len(x) - k + 1)) AS i
            FROM (SELECT doc_id, string_split(low, chr(10)) AS x, unnest(range(0, {MAX_LINES})) AS k FROM d))),
m AS (SELECT doc_id, label, len(list_intersect(list_distinct(regexp_extract_all(line, '{words}')), t.words)) / len(t.words) AS part
      FROM l, t),
q AS (SELECT doc_id, label, part FROM m WHERE part >= {MIN_CONTAINMENT}),
h AS (SELECT doc_id, label, unnest(list_filter(range(0, len(d.words) - len(p.words) + 1),
             lambda i: d.words[i + 1:i + len(p.words)] = p.words)) AS place FROM d, p),
b AS (SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word FROM h GROUP BY doc_id),
bl AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS base_labels FROM (SELECT DISTINCT doc_id, label FROM h) GROUP BY doc_id),
al AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS labels
       FROM (SELECT doc_id, label FROM h UNION SELECT doc_id, label FROM q) GROUP BY doc_id),
s AS (SELECT doc_id, max(part) AS score FROM q GROUP BY doc_id)
SELECT d.doc_id, len(d.words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN bl USING (doc_id) LEFT JOIN al USING (doc_id) LEFT JOIN s USING (doc_id)
"""


OP5_SQL = _sql()
