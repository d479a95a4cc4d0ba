"""License scan by diagonal voting, in DataFrame functions only.

All rolling word pairs of all texts are joined by hash to the places where the
templates hold them. A match votes for a diagonal, its place in the text minus
its place in the template; neighbouring diagonals are merged, which allows for
words put in or left out, and the merged spans are verified by the share of the
template that they cover."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import texts

# The phrases and labels every scan reports.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
# Opening or telling words of public license notices.
NOTICES = [
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under cc by 4 0", "cc-by"),
    ("creative commons attribution", "cc-by"),
    ("all rights reserved", "proprietary"),
    ("mozilla public license", "mpl"),
    ("bsd license", "bsd"),
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
        "mit",
    ),
    (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
        "with the license you may obtain a copy of the license at",
        "apache",
    ),
    (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation",
        "gpl",
    ),
    (
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
        "bsd",
    ),
    (
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was "
        "not distributed with this file you can obtain one at",
        "mpl",
    ),
    (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
        "isc",
    ),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
]
MOST_PAIRS = 64  # of a template: its pairs are bits of a long
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: Column) -> Column:
    """Words of a text after A-Z are lower-cased: ASCII letters, digits and
    everything beyond ASCII."""
    return F.array_remove(F.split(F.translate(text, UPPER, UPPER.lower()), BREAK), "")


def pairs_of(words: Column) -> Column:
    """Each word with the one after it; the last one alone."""
    after = F.slice(words, F.lit(2), F.greatest(F.size(words), F.lit(1)))
    return F.zip_with(words, after, lambda a, b: F.concat_ws(" ", a, b))


def templates(spark: SparkSession, phrases: dict[str, str], notices: list[tuple[str, str]]) -> DataFrame:
    """One row per word pair of each template, or its word, if it has only one.
    Its size is that of the lists given."""
    rows = [(text, label, True) for text, label in phrases.items()] + [(text, label, False) for text, label in notices]
    listed = F.array(
        *(
            F.struct(F.lit(n).alias("template"), F.lit(t).alias("text"), F.lit(label).alias("label"), F.lit(base).alias("base"))
            for n, (t, label, base) in enumerate(rows)
        )
    )
    words = spark.range(1).select(F.inline(listed)).withColumn("words", words_of(F.col("text")))
    return (
        words.withColumn("pairs", F.greatest(F.size("words") - 1, F.lit(1)))
        .select("template", "label", "base", "pairs", F.posexplode(F.slice(pairs_of(F.col("words")), F.lit(1), F.col("pairs"))))
        .select("template", "label", "base", "pairs", F.col("pos").alias("at"), F.col("col").alias("pair"))
        .withColumn("hash", F.xxhash64("pair"))
    )


def _checked(phrases: dict[str, str], notices: list[tuple[str, str]]) -> bool:
    """Whether some template has one word only; those without words or with too
    many are refused."""
    sizes = [sum(bool(part) for part in re.split(BREAK, text)) for text in [*phrases, *(text for text, _ in notices)]]
    if any(not 1 <= size <= MOST_PAIRS + 1 for size in sizes):
        raise ValueError(f"templates must have 1 to {MOST_PAIRS + 1} words")
    return 1 in sizes


def scan_licenses(
    docs: DataFrame,
    phrases: dict[str, str] | None = None,
    notices: list[tuple[str, str]] | None = None,
    coverage: float = 0.6,
    shift: int = 3,
    short: int = 12,
) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score`` for every row.

    Phrases are found where all their words stand in a row; templates of fewer
    than ``short`` words likewise. Of longer ones ``coverage`` of the word pairs
    must lie on diagonals at most ``shift`` apart. The score is 1 with a phrase,
    else the largest share of a template found. A null or empty text has no
    words; rows with equal or null ids are scanned one by one; an empty table
    gives no rows; other columns are ignored; texts are read whole. Templates
    without words and those of more than 65 raise ``ValueError``."""
    phrases = PHRASES if phrases is None else phrases
    notices = NOTICES if notices is None else notices
    single = _checked(phrases, notices)
    known = F.broadcast(templates(docs.sparkSession, phrases, notices))
    # Every text leads with a row of its own, so that one without a match is kept.
    lead = F.array(F.lit(""))
    pairs = (
        texts(docs)
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("words", words_of(F.col("text")))
        .select(
            "row", "doc_id", F.size("words").alias("n_words"), F.posexplode(F.concat(lead, pairs_of(F.col("words"))))
        )
        .select("row", "doc_id", "n_words", (F.col("pos") - 1).alias("place"), F.col("col").alias("text_pair"))
    )
    if single:
        # A template of one word is met by the first word of a pair.
        word = F.substring_index("text_pair", " ", 1)
        keys = F.array_distinct(F.array("text_pair", word))
        pairs = pairs.select("row", "doc_id", "n_words", "place", F.explode(keys).alias("text_pair"))
    met = (F.xxhash64("text_pair") == F.col("hash")) & (F.col("text_pair") == F.col("pair"))
    found = pairs.join(known, met, "left").where(F.col("template").isNotNull() | (F.col("place") < 0))
    text_keys, template_keys = ["row", "doc_id", "n_words"], ["template", "label", "base", "pairs"]
    votes = (
        found.withColumn("diagonal", F.col("place") - F.col("at"))
        .groupBy(*text_keys, *template_keys, "diagonal")
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at"))).alias("votes"))
    )
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(along) > F.when(F.col("pairs") < short, 0).otherwise(shift)
    spans = (
        votes.withColumn("new", F.coalesce(apart, F.lit(False)).cast("int"))
        .withColumn("span", F.sum("new").over(along))
        .groupBy(*text_keys, *template_keys, "span")
        .agg(F.bit_or("votes").alias("votes"), F.min("diagonal").alias("start"))
        .withColumn("share", F.coalesce(F.bit_count("votes") / F.col("pairs"), F.lit(0.0)))
    )
    whole = F.col("share") == 1
    base = F.col("base") & whole
    good = whole | ((F.col("pairs") >= short) & (F.col("share") >= coverage))

    def listed(condition: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(condition, F.col("label")))), ",")

    return spans.groupBy(*text_keys).agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start").cast("long"))).alias("first_word"),
        F.max(F.when(base, F.col("start").cast("long"))).alias("last_word"),
        listed(base).alias("base_labels"),
        listed(good).alias("labels"),
        F.greatest(F.max("share"), F.max(base.cast("double"))).alias("score"),
    ).select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )
