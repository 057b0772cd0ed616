"""Licence notices in texts, found as blocks of words that contain a template.

Method: exact set-similarity join. Templates are short passages of licences, blocks are windows of 64 words that begin
at every 32nd word, so any passage of up to 33 words lies whole in one of them. Words are ordered by the number of
documents that hold them, rarest first, over the whole table. A template that must share ``need`` of its ``total`` words
with a block shares one of its ``total - need + 1`` rarest ones, its prefix: blocks meet templates in a join on those.
A pair is dropped if the block has too few template words or if the places of the first common word leave too few
words behind it on either side; the rest are verified, so every pair that meets the threshold is found, once.

Phrases of the contract are templates of which all words are asked for, and which must stand consecutively in the block.
Words that no template has can't be shared and take no part. All of it is native columns; a document's rows stay in one
task until they are counted, and only the templates, a bounded list, are broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the contract: what a word is, and the phrases with their labels.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = [("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc")]

#: Passages of public licence texts, 33 words at most.
PASSAGES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("apache-2", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc0", "the person who associated a work with this deed has dedicated the work to the public domain by waiving all rights to the work worldwide under copyright law"),
]

BLOCK, STEP = 64, 32
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Template:
    """A passage with its label; a ``phrase`` must stand word by word."""

    label: str
    words: tuple[str, ...]
    phrase: bool = False


def templates() -> list[Template]:
    return [Template(x, tuple(t.split()), True) for x, t in PHRASES] + [Template(x, tuple(t.split())) for x, t in PASSAGES]


def words_of(text_col: str) -> Column:
    """The words of a text in lower case (A-Z only); null counts as empty."""
    return F.regexp_extract_all(F.translate(F.coalesce(F.col(text_col), F.lit("")), _UPPER, _LOWER), F.lit(WORD), F.lit(0))


def rarest_first(df: DataFrame, vocabulary: list[str], text_col: str = "text") -> list[str]:
    """The templates' words by the number of documents of the whole table that hold them, ties by the word."""
    held = df.select(F.explode(F.array_intersect(F.lit(vocabulary), words_of(text_col))).alias("word")).groupBy("word").count()
    n = {r["word"]: r["count"] for r in held.collect()}  # the vocabulary is that of the templates
    return sorted(vocabulary, key=lambda w: (n.get(w, 0), w))


def _index(df: DataFrame, known: list[Template], order: list[str], percent: int) -> DataFrame:
    """A row for each prefix word of a template."""
    rank = {w: i for i, w in enumerate(order)}
    rows = []
    for number, t in enumerate(known):
        own = sorted(set(t.words), key=rank.__getitem__)
        need = len(own) if t.phrase else -(-percent * len(own) // 100)
        rows += [(w, number, t.label, i, need, own, list(t.words) if t.phrase else None) for i, w in enumerate(own[: len(own) - need + 1])]
    return df.sparkSession.createDataFrame(rows, "word string, template int, label string, i int, need int, own array<string>, phrase array<string>")


def _pairs(df: DataFrame, known: list[Template], percent: int, id_col: str, text_col: str) -> DataFrame:
    """(id, row, n_words, block, template, label, score, places): verified pairs, and a row with nulls for a text without any."""
    if any(len(t.words) > BLOCK - STEP + 1 or not t.words for t in known):
        raise ValueError(f"templates have 1 to {BLOCK - STEP + 1} words")
    order = rarest_first(df, sorted({w for t in known for w in t.words}), text_col)
    index = _index(df, known, order, percent)
    triggers = sorted(r["word"] for r in index.select("word").distinct().collect())
    texts = df.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), words_of(text_col).alias("words"))
    hits = F.filter(F.transform("words", lambda w, i: F.when(w.isin(triggers), F.floor(i / STEP).cast("int"))), lambda b: b.isNotNull())
    numbers = F.filter(F.array_distinct(F.flatten(F.transform(F.array_distinct(hits), lambda b: F.array(b - 1, b)))), lambda b: b >= 0)
    blocks = F.transform(numbers, lambda b: F.struct(b.alias("block"), F.slice("words", b * STEP + 1, BLOCK).alias("own")))
    rows = texts.select("id", "row", F.size("words").cast("long").alias("n_words"), F.explode_outer(blocks).alias("b"))
    ordered = rows.select("id", "row", "n_words", "b.block", F.col("b.own").alias("text"), F.array_intersect(F.lit(order), "b.own").alias("block_words"))
    prefix = F.filter(F.transform("block_words", lambda w, j: F.struct(w.alias("word"), j.alias("j"))), lambda x: x["word"].isin(triggers))
    met = ordered.withColumn("p", F.explode_outer(prefix)).select("*", "p.word", "p.j").drop("p").join(F.broadcast(index), "word", "left")  # a bounded list
    common = F.array_intersect("own", "block_words")
    possible = (F.size("block_words") >= F.col("need")) & (F.least(F.size("own") - F.col("i"), F.size("block_words") - F.col("j")) >= F.col("need"))
    first = F.get(common, F.lit(0)) == F.col("word")  # a pair counts at its first common word only
    starts = F.filter(F.sequence(F.lit(0), F.lit(STEP - 1)), lambda s: F.slice("text", s + 1, F.size("phrase")) == F.col("phrase"))
    found = met.withColumn("shared", F.when(possible & first, F.size(common))).withColumn("places", F.when((F.col("shared") >= F.col("need")) & F.col("phrase").isNotNull(), starts))
    score = F.when(F.col("phrase").isNull(), F.col("shared") / F.size("own")).when(F.size("places") > 0, 1.0)
    return found.withColumn("score", F.when(F.col("shared") >= F.col("need"), score)).select("id", "row", "n_words", "block", "template", "label", "score", F.transform("places", lambda s: (F.col("block") * STEP + s).cast("long")).alias("places"))


def license_blocks(df: DataFrame, known: list[Template] | None = None, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, first_word, template, label, score, places): every block that contains ``percent`` of a template's distinct words.

    ``places`` are the words at which a phrase starts, each in one block only. Texts without a match give no row.
    """
    found = _pairs(df, templates() if known is None else known, percent, id_col, text_col).where("score is not null")
    return found.select(F.col("id").alias(id_col), (F.col("block") * STEP).cast("long").alias("first_word"), "template", "label", "score", "places")


def scan_licenses(df: DataFrame, known: list[Template] | None = None, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) of each row.

    ``n_base`` counts the places of phrases, which lie between ``first_word`` and ``last_word`` (null without any).
    Labels are sorted and joined by commas; ``score`` is the highest share of a template that a block contains, if it
    meets the threshold, else 0. Null texts count as empty; null and repeated ids and repeated rows get a row each;
    an empty table gives none; other columns are ignored.
    """
    pairs = _pairs(df, templates() if known is None else known, percent, id_col, text_col)

    def joined(which: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")

    here = F.size("places") > 0
    return pairs.groupBy(F.col("id").alias(id_col), "row").agg(
        F.max("n_words").alias("n_words"), F.coalesce(F.sum(F.when(here, F.size("places"))), F.lit(0)).cast("long").alias("n_base"), F.min(F.array_min("places")).alias("first_word"), F.max(F.array_max("places")).alias("last_word"),
        joined(here).alias("base_labels"), joined(F.col("score").isNotNull()).alias("labels"), F.coalesce(F.max("score"), F.lit(0.0)).alias("score"),
    ).drop("row")
