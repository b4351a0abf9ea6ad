"""License scan by diagonal voting of rolling word k-grams.

Every k-gram of a text is hashed and joined with the positions of the same k-gram in the templates
(a constant table, broadcast). A hit votes for the diagonal ``text position - template position``.
A phrase stands where one diagonal has a vote from each of its k-grams. For the longer notices,
neighbouring diagonals (a word put in or left out moves to the next) are merged, and a merged span is
verified: enough of the template's k-grams, within a span not much longer than the template.

DataFrame functions only; nothing but votes and one row a text is shuffled. Texts are told apart by
id and a hash of the text. Defined cases: null text counts as empty; texts without a word or a hit
have a row with no label and score 0; repeated rows each give a row; null ids are kept; an empty table
gives no rows; very long texts are scanned whole (a text's k-grams are one array of 8 bytes each); of
hits that tie on a diagonal the template's first position opens it; other columns are not read.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.llm import common

K, SLACK, MIN_COVERED, MAX_STRETCH = 3, 2, 60, 2
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases: each consecutive occurrence is a place.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Opening words of public license notices.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "released under the mit license": "mit",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license": "apache-2",
    "licensed under the apache license version 2 0": "apache-2",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "cc-by-nc",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "this work is licensed under the gnu general public license version 3": "gpl-3",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2",
}
END = -1  # the template of the row that stands for the text itself


def lowered_words(text: Column) -> Column:
    """Words of a text; A-Z alone are lower-cased."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), ascii_uppercase, ascii_lowercase), F.lit(WORDS), F.lit(0))


def grams(words: Column, size: Column) -> Column:
    """Hash of each run of K words."""
    return F.transform(F.sequence(F.lit(1), size - (K - 1)), lambda i: F.xxhash64(*[F.element_at(words, i + F.lit(k)) for k in range(K)]))


def templates(spark: SparkSession) -> DataFrame:
    """hash, template, tpos, total (k-grams), words, label, phrase; and the row that matches the end mark 0."""
    rows = [(t, label, True) for t, label in PHRASES.items()] + [(t, label, False) for t, label in NOTICES.items()]
    texts = F.array(*[F.struct(F.lit(i).alias("template"), F.split(F.lit(t), " ").alias("w"), F.lit(label).alias("label"), F.lit(phrase).alias("phrase")) for i, (t, label, phrase) in enumerate(rows)])
    listed = spark.range(1).select(F.explode(texts).alias("t")).select("t.*").withColumn("words", F.size("w"))
    placed = listed.select("template", "words", "label", "phrase", F.posexplode(grams(F.col("w"), F.col("words"))).alias("tpos", "hash"))
    known = placed.select("hash", "template", "tpos", (F.col("words") - (K - 1)).alias("total"), "words", "label", "phrase")
    mark = spark.range(1).select(F.lit(0).cast("long").alias("hash"), F.lit(END).alias("template"), F.lit(0).alias("tpos"), F.lit(0).alias("total"), F.lit(0).alias("words"), F.lit("").alias("label"), F.lit(False).alias("phrase"))
    return known.unionByName(mark)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every row."""
    text = docs["text"].cast("string")
    split = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text).alias("row"), lowered_words(text).alias("w")).withColumn("n_words", F.size("w"))
    hashed = F.when(F.col("n_words") >= K, grams(F.col("w"), F.greatest(F.col("n_words"), F.lit(K)))).otherwise(F.array().cast("array<long>"))
    rolled = split.select("doc_id", "row", F.col("n_words").cast("long").alias("n_words"), F.posexplode(F.array_append(hashed, F.lit(0).cast("long"))).alias("pos", "hash"))
    key, votes = ["doc_id", "row", "n_words"], rolled.join(F.broadcast(templates(docs.sparkSession)), "hash")
    diagonal = (F.col("pos") - F.col("tpos")).alias("diagonal")
    votes = votes.groupBy(*key, "template", diagonal, "tpos", "total", "words", "label", "phrase").agg(F.count("*").alias("rows"))
    by_template = Window.partitionBy(*key, "template")
    last = F.lag("diagonal").over(by_template.orderBy("diagonal", "tpos"))
    votes = votes.withColumns({"on_diagonal": F.count("*").over(Window.partitionBy(*key, "template", "diagonal")), "opens": F.when(F.col("diagonal") - last <= SLACK, 0).otherwise(1)})
    votes = votes.withColumn("span", F.sum("opens").over(by_template.orderBy("diagonal", "tpos").rowsBetween(Window.unboundedPreceding, 0)))
    spans = Window.partitionBy(*key, "template", "span")
    start = F.col("diagonal") + F.col("tpos")
    votes = votes.withColumns({"covered": F.size(F.collect_set("tpos").over(spans)), "length": F.max(start).over(spans) + K - F.min(start).over(spans)})
    place = F.col("phrase") & (F.col("on_diagonal") == F.col("total")) & (F.col("tpos") == 0)
    verified = (F.col("template") != END) & ~F.col("phrase") & (100 * F.col("covered") >= MIN_COVERED * F.col("total")) & (F.col("length") <= MAX_STRETCH * F.col("words"))
    found = votes.groupBy(*key).agg(
        F.max(F.when(F.col("template") == END, F.col("rows"))).alias("rows"),
        F.count(F.when(place, 1)).alias("n_base"),
        F.min(F.when(place, F.col("diagonal"))).cast("long").alias("first_word"),
        F.max(F.when(place, F.col("diagonal"))).cast("long").alias("last_word"),
        _listed(place).alias("base_labels"),
        _listed(place | verified).alias("labels"),
        F.coalesce(F.max(F.when(place, F.lit(1.0)).when(verified, F.col("covered") / F.col("total"))), F.lit(0.0)).alias("score"),
    )
    each = found.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return each.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def _listed(condition: Column) -> Column:
    return F.array_join(F.array_sort(F.collect_set(F.when(condition, F.col("label")))), ",")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(common.documents(spark, sf_dir))


def _oracle() -> str:
    rows = [(t, label, True) for t, label in PHRASES.items()] + [(t, label, False) for t, label in NOTICES.items()]
    values = ", ".join(f"({i}, string_split('{t}', ' '), '{label}', {str(phrase).lower()})" for i, (t, label, phrase) in enumerate(rows))
    return rf"""
WITH texts AS (SELECT row_number() OVER () k, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w FROM documents),
listed AS (SELECT * FROM (VALUES {values}) t(template, tw, label, phrase)),
placed AS (SELECT template, label, phrase, len(tw) words, len(tw) - {K - 1} total, i - 1 tpos, tw[i:i + {K - 1}] gram FROM (SELECT *, unnest(range(1, len(tw) - {K - 2})) i FROM listed)),
rolled AS (SELECT k, i - 1 pos, w[i:i + {K - 1}] gram FROM (SELECT *, unnest(range(1, len(w) - {K - 2})) i FROM texts)),
hits AS (SELECT k, template, label, phrase, words, total, tpos, pos - tpos diagonal FROM rolled JOIN placed USING (gram)),
votes AS (SELECT *, count(*) OVER (PARTITION BY k, template, diagonal) on_diagonal, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY k, template ORDER BY diagonal, tpos) <= {SLACK} THEN 0 ELSE 1 END opens FROM hits),
spanned AS (SELECT *, sum(opens) OVER (PARTITION BY k, template ORDER BY diagonal, tpos ROWS UNBOUNDED PRECEDING) span FROM votes),
merged AS (SELECT k, template, span, count(DISTINCT tpos) covered, max(diagonal + tpos) + {K} - min(diagonal + tpos) length FROM spanned GROUP BY ALL),
judged AS (SELECT s.*, covered, phrase AND on_diagonal = total AND tpos = 0 place,
  NOT phrase AND 100 * covered >= {MIN_COVERED} * total AND length <= {MAX_STRETCH} * words verified FROM spanned s JOIN merged USING (k, template, span)),
found AS (SELECT k, count(*) FILTER (WHERE place) n_base, min(diagonal) FILTER (WHERE place) first_word, max(diagonal) FILTER (WHERE place) last_word,
  array_to_string(list_sort(list(DISTINCT label) FILTER (WHERE place)), ',') base_labels, array_to_string(list_sort(list(DISTINCT label) FILTER (WHERE place OR verified)), ',') labels,
  max(CASE WHEN place THEN 1.0::DOUBLE WHEN verified THEN covered::DOUBLE / total END) score FROM judged GROUP BY k)
SELECT doc_id, len(w)::BIGINT n_words, coalesce(n_base, 0)::BIGINT n_base, first_word::BIGINT first_word, last_word::BIGINT last_word,
  coalesce(base_labels, '') base_labels, coalesce(labels, '') labels, coalesce(score, 0.0)::DOUBLE score FROM texts LEFT JOIN found USING (k)
"""


ORACLE_SQL = _oracle()
