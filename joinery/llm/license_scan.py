"""Licence scans by diagonal voting: all rolling word k-gram hashes of the documents are
joined to the positions of licence templates; hits vote for the offset between document
and template, neighbouring offsets are merged, and the spans are verified. DataFrame
functions only."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .staging import staged
from .texts import item_word_array, q

#: Words of a gram.
GRAM = 3
#: Offsets that differ by no more belong to one copy of a template (words put in or left out).
SLACK = 3
#: Share of a template's grams that a span needs.
COVER = 0.6
#: Grams that the broadcast of the templates may hold; more are joined by a shuffle.
BROADCAST_GRAMS = 200_000

#: Phrases with their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Licence notices, by label.
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License',
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    "cc-by-nc-4.0": ("Licensed under CC BY-NC 4.0",),
    "cc-by-sa": ("Licensed under the Creative Commons Attribution ShareAlike License",),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    ),
    "mit": (
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ),
    "mpl-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",),
    "proprietary": ("This document is proprietary and confidential; unauthorized copying is strictly prohibited",),
}


def _words(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def template_grams(spark, templates: Mapping[str, tuple[str, ...]] = TEMPLATES, gram: int = GRAM) -> DataFrame:
    """``(template, label, j, words, size)``: every gram of every template with its position
    and the number of the template's grams."""
    rows = []
    for label, notices in templates.items():
        for notice in notices:
            words = _words(notice)
            for j in range(len(words) - gram + 1):
                rows.append((f"{label}:{' '.join(words)}", label, j, words[j:j + gram], len(words) - gram + 1))
    return spark.createDataFrame(rows, "template string, label string, j int, gram array<string>, size int")


def hits(docs: DataFrame, grams: DataFrame, id_col: str, text_col: str, phrases: Mapping[str, str] = PHRASES,
         gram: int = GRAM, broadcast_grams: int = BROADCAST_GRAMS) -> DataFrame:
    """Positions ``i`` with a phrase (``base``) or a template gram (``template, label, j,
    size``), and one row with ``i`` = -1 for every row of ``docs``.

    Positions are generated beside the document's word array and never leave the stage
    unless they hit, so the shuffle behind it moves hits only."""
    words = item_word_array(q(text_col), F.lower)
    rows = docs.select(q(id_col).alias("__id"), F.xxhash64(q(text_col).cast("string")).alias("__th"), words.alias("w"))
    rows = rows.select("__id", "__th", "w", F.size("w").alias("n_words"), F.explode(F.sequence(F.lit(-1), F.size("w") - 1)).alias("i"))
    at = lambda k: F.get("w", F.col("i") + k)
    base = F.lit(None).cast("string")
    for phrase, label in phrases.items():
        match = F.lit(True)
        for k, word in enumerate(phrase.split()):
            match = match & (at(k) == word)
        base = F.when(match, label).otherwise(base)
    own = F.xxhash64(*[at(k) for k in range(gram)])
    rows = rows.select("__id", "__th", "n_words", "i", "w", base.alias("base"), F.when(F.col("i") >= 0, own).alias("h"))
    known = grams.select(F.xxhash64(*[F.get("gram", F.lit(k)) for k in range(gram)]).alias("kh"), "gram", "template", "label", "j", "size")
    if grams.count() <= broadcast_grams:
        known = F.broadcast(known)
    found = rows.join(known, rows["h"] == known["kh"], "left")
    # the hash finds, the words decide
    true = F.col("template").isNotNull()
    for k in range(gram):
        true = true & (at(k) == F.get("gram", F.lit(k)))
    found = found.withColumn("hit", F.coalesce(true, F.lit(False))).filter("i = -1 or base is not null or hit")
    return found.select("__id", "__th", "n_words", "i", "base", *[F.when(F.col("hit"), F.col(c)).alias(c) for c in ("template", "label", "j", "size")])


def template_spans(found: DataFrame, slack: int = SLACK, cover: float = COVER, gram: int = GRAM) -> DataFrame:
    """``(__id, __th, label, start, end, score)``: verified copies of templates, in words.

    A hit at document position i and template position j votes for offset i - j. Votes of
    one document and template whose sorted offsets follow within ``slack`` make a chain. A
    span is a stretch of a chain, from one hit on and no longer than twice the template,
    whose hits cover ``cover`` of the template's grams. A chain as short as that is tried
    whole; a longer one (other text with words of the template runs into the copy) at each
    of its hits, and of stretches that overlap the one that covers most stands for them, of
    equals the shorter, then the first."""
    key = ["__id", "__th", "template"]
    votes = found.filter("template is not null").select(*key, "label", "i", "j", "size").distinct()
    votes = votes.withColumn("diagonal", F.col("i") - F.col("j"))
    diagonals = votes.groupBy(*key, "diagonal").agg(F.count(F.lit(1)).alias("votes"))
    order = Window.partitionBy(*key).orderBy("diagonal")
    diagonals = diagonals.withColumn("new", (F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order), F.lit(slack + 1)) > slack).cast("int"))
    diagonals = diagonals.withColumn("chain", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))

    def same(a: str, b: str, *more: str):
        cond = F.col(f"{a}.__id").eqNullSafe(F.col(f"{b}.__id"))
        for c in ("__th", "template", *more):
            cond = cond & (F.col(f"{a}.{c}") == F.col(f"{b}.{c}"))
        return cond

    joined = votes.alias("v").join(diagonals.alias("d"), same("v", "d", "diagonal")).select("v.*", "d.chain")
    joined = joined.select(*key, "chain", "label", "size", "i", "j", (2 * (F.col("size") + gram - 1)).alias("most"))
    chain = [*key, "chain", "label", "size", "most"]
    chains = joined.groupBy(*chain).agg(F.countDistinct("j").alias("covered"), F.min("i").alias("start"), (F.max("i") + gram).alias("end"))
    enough = lambda covered: covered / F.col("size") >= cover
    chains = chains.filter(enough(F.col("covered")))
    short = chains.filter(F.col("end") - F.col("start") <= F.col("most"))
    # long chains: every hit with those that follow it within the span's length, met by blocks of that length
    long = joined.alias("v").join(chains.filter(F.col("end") - F.col("start") > F.col("most")).select(*key, "chain").alias("d"), same("v", "d", "chain")).select("v.*")
    long = long.withColumn("block", F.floor(F.col("i") / F.col("most")))
    near = long.select(*key, "chain", F.col("i").alias("ni"), F.col("j").alias("nj"), F.explode(F.array(F.col("block") - 1, F.col("block"))).alias("block"))
    heads = long.select(*chain, "i", "block").distinct()
    after = (F.col("n.ni") >= F.col("h.i")) & (F.col("n.ni") + gram <= F.col("h.i") + F.col("h.most"))
    tried = heads.alias("h").join(near.alias("n"), same("h", "n", "chain", "block") & after).groupBy(*[F.col(f"h.{c}").alias(c) for c in chain], F.col("h.i").alias("start"), F.col("n.nj").alias("j")) \
        .agg(F.min("n.ni").alias("first"))
    tried = tried.groupBy(*chain, "start").agg(F.count(F.lit(1)).alias("covered"), (F.max("first") + gram).alias("end")).filter(enough(F.col("covered")))
    worth = F.struct(F.col("covered"), (F.col("start") - F.col("end")).alias("short"), (-F.col("start")).alias("first"))
    tried = tried.withColumn("worth", worth).withColumn("block", F.floor(F.col("start") / (F.col("size") + gram - 1)))
    best = tried.groupBy(*chain, "block").agg(F.max("worth").alias("worth"))
    along = Window.partitionBy(*key, "chain").orderBy("block")
    # the best of a block gives way to a better one of the next block that it overlaps
    start, end = -F.col("worth.first"), -F.col("worth.first") - F.col("worth.short")
    best = best.select(*chain, start.alias("start"), end.alias("end"), F.col("worth.covered").alias("covered"), "worth", "block")
    beaten = lambda o, s, e: F.coalesce((o > F.col("worth")) & (s < F.col("end")) & (e > F.col("start")), F.lit(False))
    best = best.withColumn("beaten", beaten(F.lag("worth").over(along), F.lag("start").over(along), F.lag("end").over(along))
                           | beaten(F.lead("worth").over(along), F.lead("start").over(along), F.lead("end").over(along)))
    spans = short.unionByName(best.filter("not beaten").select(*short.columns))
    return spans.select("__id", "__th", "label", "start", "end", (F.col("covered") / F.col("size")).alias("score"))


def scan_licenses(docs: DataFrame, templates: Mapping[str, tuple[str, ...]] = TEMPLATES, id_col: str = "doc_id",
                  text_col: str = "text", phrases: Mapping[str, str] = PHRASES) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n_words``, ``n_base`` (places of the
    phrases), ``first_word`` and ``last_word`` (their smallest and largest start; null
    without one), ``base_labels``, ``labels`` (with the templates'; both distinct, sorted,
    joined by commas, empty without any), ``score`` (1 with a phrase, else the best
    coverage of a template, else 0) and ``spans`` (label, start, end, score, in words).

    Null text has no words. Rows that repeat id and text are counted once and given back
    as often as they came."""
    grams = template_grams(docs.sparkSession, templates)
    found = staged(hits(docs, grams, id_col, text_col, phrases), "lic_hits")
    # a phrase's place may have several template hits beside it
    places = found.groupBy("__id", "__th", "i").agg(F.max("n_words").alias("n_words"), F.max("base").alias("base"), F.count(F.lit(1)).alias("rows"))
    base = F.col("base").isNotNull()
    rows = places.groupBy("__id", "__th").agg(
        F.max("n_words").alias("n_words"), F.sum(F.when(F.col("i") == -1, F.col("rows"))).alias("copies"),
        F.count(F.when(base, 1)).alias("n_base"), F.min(F.when(base, F.col("i"))).alias("first_word"),
        F.max(F.when(base, F.col("i"))).alias("last_word"), F.collect_set("base").alias("base_set"))
    spans = template_spans(found).groupBy("__id", "__th").agg(
        F.max("score").alias("best"), F.collect_set("label").alias("label_set"),
        F.sort_array(F.collect_list(F.struct("start", "end", "label", "score"))).alias("spans"))
    spans = spans.select(F.col("__id").alias("__sid"), F.col("__th").alias("__sth"), "best", "label_set", "spans")
    both = rows.join(spans, F.col("__id").eqNullSafe(F.col("__sid")) & (F.col("__th") == F.col("__sth")), "left")
    labels = F.array_union("base_set", F.coalesce("label_set", F.expr("cast(array() as array<string>)")))
    return both.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        F.col("__id").alias(id_col), F.col("n_words").cast("long").alias("n_words"), F.col("n_base").cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        F.array_join(F.array_sort("base_set"), ",").alias("base_labels"), F.array_join(F.array_sort(labels), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"), "spans")
