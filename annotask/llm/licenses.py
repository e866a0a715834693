"""License scans: fixed phrases, and an exact set-similarity join of text blocks with license notices.

A notice is a set of words. A text block holds it when the block has at least
``threshold`` of the notice's words (containment). Blocks are windows of twice
a notice's length, one beginning at each length, so a passage no longer than
the notice lies whole inside a block; notices of about the same length (up to the
same power of two) share their blocks.

Only words of some notice matter. They are put in one order for the whole
corpus, by their count in all texts, rarest first. Two sets with at least
``need`` words in common share a word among the first ``size - need + 1`` of
each (prefix filter); a block with fewer words than that is left out (length filter); and
a shared word at places ``i`` and ``j`` allows at most
``min(i, j) + 1 + min(words after i, words after j)`` common words (positional
filter). What passes is counted exactly. A document without any rare word of a
notice never leaves its row: no shuffle sees its words.

The notices are a parameter, and their words the only thing the driver holds.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annotask.llm.common import text_or_empty, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Words: runs of ASCII digits, lower-case letters and anything beyond ASCII.
LICENSE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Share of a notice's words that a block has to hold. Notices of fewer than
# ten words must be there whole.
CONTAINMENT = 0.9

# Phrases whose words stand consecutively, and their labels.
PHRASES = (
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
)

# Wording of public license notices, and their labels.
NOTICES = (
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "Distributed under the terms of the Apache License"),
    ("bsd", "Licensed under the BSD License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("gpl", "Licensed under the GNU General Public License"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation"),
    ("lgpl", "Licensed under the GNU Lesser General Public License"),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
)


def split_words(text: str) -> list[str]:
    """A notice's words, by the rule of the texts."""
    return re.findall(LICENSE_WORD, text.translate(str.maketrans(UPPER, LOWER)))


def block_step(words: int) -> int:
    """Distance between the blocks for a notice of so many words: the next power of two, 4 at least."""
    return max(4, 1 << (words - 1).bit_length())


def notice_sets(notices: Sequence[tuple[str, str]], threshold: float) -> list[dict]:
    """Per notice: its label, set of words, needed number of them and block distance; notices without words left out."""
    sets = []
    for label, text in notices:
        words = split_words(text)
        if words:
            tokens = sorted(set(words))
            # The margin keeps products such as 0.7 * 10 from being rounded up.
            need = max(1, math.ceil(threshold * len(tokens) - 1e-9))
            sets.append({"label": label, "tokens": tokens, "need": need, "step": block_step(len(words))})
    return sets


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(LICENSE_WORD), 0)


def _phrase_places(words: Column, phrases: Sequence[tuple[str, str]]) -> Column:
    """Every place where a phrase's words stand consecutively, in order: (start, label)."""

    def starts(word: Column, at: Column) -> Column:
        found = []
        for label, phrase in phrases:
            first, *rest = split_words(phrase)
            here = word == first
            for k, other in enumerate(rest, 1):
                here = here & F.coalesce(F.get(words, at + k) == other, F.lit(False))
            found.append(F.when(here, F.struct(at.cast("long").alias("start"), F.lit(label).alias("label"))))
        return F.array_compact(F.array(*found))

    firsts = [split_words(phrase)[0] for _, phrase in phrases]
    near = F.transform(words, lambda w, i: F.when(w.isin(firsts), starts(w, i)))
    return F.flatten(F.array_compact(near))


def _ordered(texts: DataFrame, sets: list[dict]) -> list[str]:
    """The words of the notices, rarest in all texts first; as many as the notices have, however many texts."""
    vocabulary = sorted({t for s in sets for t in s["tokens"]})
    seen = texts.select(F.explode("words").alias("token")).where(F.col("token").isin(vocabulary))
    counts = {r["token"]: r["n"] for r in seen.groupBy("token").agg(F.count("*").alias("n")).collect()}
    return sorted(vocabulary, key=lambda t: (counts.get(t, 0), t))


def _notice_table(spark, sets: list[dict], order: list[str]) -> DataFrame:
    """One row per notice: (notice, label, step, need, tokens as ranks)."""
    rank = {t: i for i, t in enumerate(order)}
    rows = [(i, s["label"], s["step"], s["need"], sorted(rank[t] for t in s["tokens"])) for i, s in enumerate(sets)]
    return spark.createDataFrame(rows, "notice int, label string, step int, need int, tokens array<int>")


def block_matches(occurrences: DataFrame, notices: DataFrame, order: list[str], steps: list[int]) -> DataFrame:
    """Every (key, block, notice) of at least the needed words, from the places (key, at, token) of notice words.

    Returns key, notice, label, start (the block's first word), n_words (its
    length), containment.
    """
    spark = occurrences.sparkSession
    ranks = spark.createDataFrame(list(enumerate(order)), "rank int, token string")
    windows = [(step, back) for step in steps for back in (0, 1)]
    blocks_of = F.explode(
        F.array(
            *(
                F.struct(F.lit(step).alias("step"), (F.floor(F.col("at") / step) - back).alias("block"))
                for step, back in windows
            )
        )
    )
    least = notices.groupBy("step").agg(F.min("need").alias("least"))
    # A block's set has at most as many words as the notices together.
    blocks = (
        occurrences.join(F.broadcast(ranks), "token")
        .select("key", "rank", blocks_of.alias("b"))
        .select("key", "rank", F.col("b.step").alias("step"), F.col("b.block").alias("block"))
        .where("block >= 0")
        .groupBy("key", "step", "block")
        .agg(F.array_sort(F.collect_set("rank")).alias("held"))
        .join(F.broadcast(least), "step")
        .where(F.size("held") >= F.col("least"))
    )
    prefix = blocks.select(
        "key", "step", "block", "held", F.posexplode(F.slice("held", F.lit(1), F.size("held") - F.col("least") + 1)).alias("j", "rank")
    )
    wanted = notices.select(
        "notice", "label", "step", "need", "tokens",
        F.posexplode(F.slice("tokens", F.lit(1), F.size("tokens") - F.col("need") + 1)).alias("i", "rank"),
    )
    most = F.least("i", "j") + F.least(F.size("tokens") - F.col("i"), F.size("held") - F.col("j"))
    met = prefix.join(F.broadcast(wanted), ["step", "rank"]).where(most >= F.col("need"))
    common = met.withColumn("common", F.array_intersect("held", "tokens")).where(F.size("common") >= F.col("need"))
    # A block and a notice meet at each shared word of their prefixes: counted at the first.
    return common.where(F.element_at("common", 1) == F.col("rank")).select(
        "key",
        "notice",
        "label",
        (F.col("block") * F.col("step")).alias("start"),
        (F.lit(2) * F.col("step")).alias("n_words"),
        (F.size("common") / F.size("tokens")).alias("containment"),
    )


def license_scan(
    documents: DataFrame,
    notices: Sequence[tuple[str, str]] = NOTICES,
    phrases: Sequence[tuple[str, str]] = PHRASES,
    threshold: float = CONTAINMENT,
    text_col: str = "text",
) -> DataFrame:
    """``documents`` without their text, one row each, with

    * ``n_words``,
    * ``base``: every place of a phrase, (start word, label), in order,
    * ``base_labels``, ``labels``: sorted distinct labels of the phrases; of phrases and notices,
    * ``license_score``: 1 where a phrase stands, else the largest containment of a
      notice in a block that holds it, 0 without any.

    Null texts are empty: no words, no labels, score 0. Rows that repeat, or
    lack an id, are rows of their own. Columns of these names are replaced,
    all others kept, whatever they are called. An empty table gives an empty
    one; without notices only the phrases count.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the containment is above 0 and at most 1")
    phrases = [(label, phrase) for label, phrase in phrases if split_words(phrase)]
    made = {"n_words", "base", "base_labels", "labels", "license_score"}
    carried = [c for c in documents.columns if c.lower() not in made and c != text_col]
    row = F.struct(*(F.col(f"`{c}`") for c in carried)) if carried else F.struct(F.lit(None).cast("int").alias("none"))
    sets = notice_sets(notices, threshold)
    texts = documents.select(row.alias("row"), _words(text_or_empty(f"`{text_col}`")).alias("words"))

    order = _ordered(texts, sets) if sets else []
    rank = {t: i for i, t in enumerate(order)}
    telling, vocabulary = set(), [t for s in sets for t in s["tokens"]]
    for s in sets:
        telling.update(sorted(s["tokens"], key=rank.get)[: len(s["tokens"]) - s["need"] + 1])

    held = F.filter(
        F.transform("words", lambda w, i: F.struct(i.alias("at"), w.alias("token"))),
        lambda o: o["token"].isin(sorted(set(vocabulary))),
    )
    places = _phrase_places(F.col("words"), phrases) if phrases else F.expr("array()").cast("array<struct<start:bigint,label:string>>")
    facts = written(
        texts.select(
            F.monotonically_increasing_id().alias("key"),
            "row",
            F.size("words").cast("long").alias("n_words"),
            places.alias("base"),
            F.when(F.exists("words", lambda w: w.isin(sorted(telling))), held).alias("held") if sets
            else F.expr("array()").cast("array<struct<at:int,token:string>>").alias("held"),
        ),
        "license-facts",
    )
    spread = F.array_sort(F.array_distinct(F.transform("base", lambda p: p["label"])))
    out = facts.select("key", "row", "n_words", "base", spread.alias("base_labels"))
    if sets:
        steps = sorted({s["step"] for s in sets})
        occurrences = facts.select("key", F.explode("held").alias("o")).select("key", "o.at", "o.token")
        matches = block_matches(occurrences, _notice_table(documents.sparkSession, sets, order), order, steps)
        best = matches.groupBy("key").agg(F.collect_set("label").alias("more"), F.max("containment").alias("best"))
        out = out.join(best, "key", "left")
    else:
        out = out.withColumn("more", F.lit(None).cast("array<string>")).withColumn("best", F.lit(None).cast("double"))
    return out.select(
        *(F.col(f"row.`{c}`").alias(c) for c in carried),
        "n_words",
        "base",
        "base_labels",
        F.array_sort(F.array_union("base_labels", F.coalesce("more", F.expr("array()").cast("array<string>")))).alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("license_score"),
    )
