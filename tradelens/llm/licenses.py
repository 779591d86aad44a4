"""License scan by diagonal voting, in DataFrame and SQL functions alone.

Every pair of neighbouring words of every text is hashed and joined to the
pairs of the license templates (a fixed table, so it is broadcast). A match
votes for its diagonal, the word of the text at which the template would
begin. Votes are summed by diagonal, neighbouring diagonals (words added or
left out) are merged, and a merged span counts if it covers enough of its
template's pairs within a length near the template's. Short phrases allow no
neighbours: they count where all their words stand consecutively. Templates are
short phrases, first sentences and whole license texts, of any length: a
diagonal's votes are kept as bits of as many longs as the template needs.

Votes are dealt by document and template, so a document's matches spread over
tasks; only its few spans meet in one.

Defined results: null and empty texts have no words and score 0; repeated rows
are scanned row by row; first_word and last_word are null without a base place;
texts of any length are scanned whole; no rows give no rows; columns other than
doc_id and text are not read, whatever their names.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._shared import text_of
from .license_texts import TEXTS

# Phrases and their labels, then passages of the license texts.
BASE = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
PASSAGES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "apache"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl"),
    ("this work is licensed under a creative commons attribution", "cc"),
    ("licensed under cc by", "cc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("spdx license identifier mit", "mit"),
    ("spdx license identifier apache 2 0", "apache"),
    ("spdx license identifier gpl", "gpl"),
    ("spdx license identifier bsd", "bsd"),
]
#: A passage's least covered share, and words per neighbouring diagonal allowed.
COVER, WORDS_PER_STEP = 0.8, 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: str) -> list[str]:
    """Words as ``scan`` takes them."""
    low = text.translate(str.maketrans(UPPER, LOWER))
    return [w for w in re.split(BETWEEN, low) if w]


def all_templates() -> list[tuple[list[str], str]]:
    """(words, label), the base phrases first."""
    return [(words_of(text), label) for text, label in BASE + PASSAGES] + [(words_of(text), label) for label, text in TEXTS]


def templates(spark: SparkSession) -> DataFrame:
    """One row per pair of a template: template, label, base, pairs (how many
    it has), steps (diagonals to merge over), place, pair."""
    rows = []
    for number, (words, label) in enumerate(all_templates()):
        for place, pair in enumerate(zip(words, words[1:])):
            rows.append((number, label, number < len(BASE), len(words) - 1, len(words) // WORDS_PER_STEP, place, " ".join(pair)))
    return spark.createDataFrame(rows, "template int, label string, base boolean, pairs int, steps int, place int, pair string")


def scan(docs: DataFrame) -> DataFrame:
    """Per document row: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score."""
    spark = docs.sparkSession
    words = F.array_remove(F.split(F.translate(text_of(), UPPER, LOWER), BETWEEN), "")
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), words.alias("words"))
    pairs = F.expr("zip_with(words, slice(words, 2, greatest(size(words) - 1, 0)), (a, b) -> concat(a, ' ', b))")
    # place 0 is no pair: it keeps every row, whatever it holds
    exploded = rows.select("doc_id", "row", F.size("words").cast("long").alias("n_words"),
                           F.posexplode(F.concat(F.array(F.lit(None).cast("string")), pairs)).alias("at", "pair"))
    known = F.broadcast(templates(spark).withColumn("hash", F.xxhash64("pair")).withColumnRenamed("pair", "own"))
    hashed = exploded.withColumn("hash", F.xxhash64("pair"))
    met = hashed.join(known, (hashed["hash"] == known["hash"]) & (hashed["pair"] == known["own"]), "left") \
        .where("template IS NOT NULL OR at = 0") \
        .select("doc_id", "row", "n_words", "template", "label", "base", "pairs", "steps", "place", (F.col("at") - 1 - F.col("place")).cast("long").alias("diagonal"))
    # a document's matches with one template meet; what follows keeps that partitioning
    of = ["row", "doc_id", "n_words", "template", "label", "base", "pairs", "steps"]
    votes = met.withColumn("part", F.expr("place DIV 64")).repartition("row", "template").groupBy(*of, "diagonal", "part") \
        .agg(F.expr("bit_or(shiftleft(1L, place % 64))").alias("covered"), F.min(F.col("diagonal") + F.col("place")).alias("first"),
             F.max(F.col("diagonal") + F.col("place")).alias("last"))
    along = Window.partitionBy("row", "template").orderBy("diagonal", "part")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > F.col("steps"), F.lit(True))
    spans = votes.withColumn("apart", apart.cast("int")) \
        .withColumn("span", F.sum("apart").over(along.rowsBetween(Window.unboundedPreceding, 0))) \
        .groupBy(*of, "span", "part").agg(F.expr("bit_count(bit_or(covered))").alias("covered"), F.min("first").alias("first"), F.max("last").alias("last")) \
        .groupBy(*of, "span").agg(F.sum("covered").alias("covered"), F.min("first").alias("first"), F.max("last").alias("last"))
    cover = F.col("covered") / F.col("pairs")
    fits = F.when(F.col("steps") == 0, cover == 1).otherwise((cover >= COVER) & (F.col("last") - F.col("first") + 1 <= F.col("pairs") + 2 * F.col("steps")))
    good = spans.withColumn("good", F.coalesce(fits, F.lit(False))).withColumn("counts", F.col("good") & F.col("base"))
    named = "array_join(sort_array(collect_set(IF({}, label, NULL))), ',')"
    return good.groupBy("row", "doc_id", "n_words").agg(
        F.sum(F.when(F.col("counts"), 1).otherwise(0)).cast("long").alias("n_base"),
        F.min(F.when(F.col("counts"), F.col("first"))).alias("first_word"), F.max(F.when(F.col("counts"), F.col("first"))).alias("last_word"),
        F.expr(named.format("counts")).alias("base_labels"), F.expr(named.format("good")).alias("labels"),
        F.coalesce(F.max(F.when(F.col("good"), cover)), F.lit(0.0)).alias("score")).drop("row")
