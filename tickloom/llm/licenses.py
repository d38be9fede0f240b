"""License scans by diagonal voting.

Every rolling 4-word hash of every text is joined with the positions of that hash in the license
templates. A hit at text position p and template position t lies on the diagonal p - t; hits on one
diagonal are one uninterrupted match, and neighbouring diagonals are one match with a few words added
or left out. A merged span counts as verified by the share of the template's words that its hits cover.

The templates are a fixed list of a few hundred words, so their side of the join is broadcast. Texts
never move: what is shuffled are the hits and one slim row per document.

Defined cases: a null text has no words; rows equal in id and text share their hits, which count once;
a null id is an id like any other; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import let

K = 4  # words per hash
GAP = 6  # diagonals this far apart still belong to one span
VERIFIED = 0.6  # share of a template's words that a span has to cover

# ASCII characters that separate words; all others, and all of them beyond ASCII, are in words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases and their labels.
PHRASES = [
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
]

# License notices as published, lower case, without punctuation and version numbers.
TEMPLATES = [
    ("mit-notice", "released under the mit license"),
    ("mit-notice", "licensed under the mit license"),
    ("mit-text",
     "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction including without limitation the "
     "rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("apache-notice", "licensed under the apache license version"),
    ("apache-text",
     "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl-notice", "licensed under the gnu general public license version"),
    ("gpl-text",
     "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation"),
    ("cc-by-notice", "licensed under cc by"),
    ("cc-by-nc-notice", "licensed under cc by nc"),
    ("cc-by-notice", "licensed under a creative commons attribution"),
    ("bsd-text",
     "redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met"),
    ("isc-text",
     "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl-notice", "this source code form is subject to the terms of the mozilla public license"),
    ("proprietary-notice", "all rights reserved no part of this publication may be reproduced"),
]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def gram(words: Column, i: Column) -> Column:
    return F.xxhash64(*[F.get(words, i + j) for j in range(K)])


def phrase_places(words: Column) -> Column:
    """Array of (start, label): where the words of a phrase stand consecutively."""
    split = [(p.split(), label) for p, label in PHRASES]
    last = sorted({p[-1] for p, _ in split})

    def places(w: Column) -> Column:
        marked = F.transform(w, lambda x, i: F.when(x.isin(last), i))
        ends = F.filter(marked, lambda i: i.isNotNull())

        def of(ends: Column, phrase: list[str], label: str) -> Column:
            def here(e: Column) -> Column:
                same = F.lit(True)
                for back, word in enumerate(reversed(phrase)):
                    same = same & (F.get(w, e - back) == word)
                return F.coalesce(same, F.lit(False))

            return F.transform(F.filter(ends, here), lambda e: F.struct((e - len(phrase) + 1).alias("start"), F.lit(label).alias("label")))

        return let(ends, lambda ends: F.concat(*[of(ends, p, label) for p, label in split]))

    return let(words, places)


def template_grams(spark) -> DataFrame:
    """hash, template, length, t: a few hundred rows, whatever the data."""
    rows = [(i, text.split()) for i, (_, text) in enumerate(TEMPLATES)]
    texts = spark.createDataFrame(rows, "template int, words array<string>")
    return texts.select(
        "template",
        F.size("words").alias("length"),
        F.posexplode(F.transform(F.sequence(F.lit(0), F.size("words") - K), lambda i: gram(F.col("words"), i))).alias("t", "hash"),
    )


def hits(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, text_hash, template, length, p, t: equal K-word runs of texts and templates, each once."""
    grams = let(
        words_of(F.col(text)),
        lambda w: F.when(F.size(w) < K, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.slice(w, F.lit(1), F.size(w) - (K - 1)), lambda x, i: gram(w, i))
        ),
    )
    rolled = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), F.posexplode(grams).alias("p", "hash"))
    return rolled.join(F.broadcast(template_grams(docs.sparkSession)), "hash").drop("hash").distinct()


def spans(found: DataFrame) -> DataFrame:
    """doc_id, text_hash, template, first, last, coverage: merged diagonals, verified or not."""
    key = ["doc_id", "text_hash", "template"]
    diagonals = (
        found.withColumn("diagonal", F.col("p") - F.col("t"))
        .groupBy(*key, "length", "diagonal")
        .agg(F.count("*").alias("votes"), F.min("p").alias("first"), F.max("p").alias("last"), F.collect_set("t").alias("ts"))
    )
    order = Window.partitionBy(*key).orderBy("diagonal")
    new = F.when(F.col("diagonal") - F.lag("diagonal").over(order) <= GAP, 0).otherwise(1)
    covered = F.array_distinct(F.flatten(F.transform("ts", lambda t: F.sequence(t, t + (K - 1)))))
    return (
        diagonals.withColumn("new", new)
        .withColumn("span", F.sum("new").over(order))
        .groupBy(*key, "length", "span")
        .agg(F.sum("votes").alias("votes"), F.min("first").alias("first"), F.max("last").alias("last"),
             F.array_distinct(F.flatten(F.collect_list("ts"))).alias("ts"))
        .select(*key, "votes", "first", (F.col("last") + (K - 1)).alias("last"), (F.size(covered) / F.col("length")).alias("coverage"))
    )


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per document: word count, phrase places, labels, best coverage, verified spans."""
    named = F.element_at(F.array(*[F.lit(label) for label, _ in TEMPLATES]), F.col("template") + 1)
    verified = (
        spans(hits(docs, text))
        .withColumn("ok", F.col("coverage") >= VERIFIED)
        .withColumn("label", named)
        .groupBy("doc_id", "text_hash")
        .agg(
            F.max("coverage").alias("score"),
            F.collect_set(F.when(F.col("ok"), F.col("label"))).alias("found"),
            F.sort_array(F.collect_list(F.when(F.col("ok"), F.struct("first", "last", "label", "coverage")))).alias("spans"),
        )
        .select(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash"), "score", "found", "spans")
    )
    basics = let(words_of(F.col(text)), lambda w: F.struct(F.size(w).alias("n"), phrase_places(w).alias("places")))
    slim = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), basics.alias("b")).select(
        "doc_id", "text_hash", F.col("b.n").cast("long").alias("n_words"), F.col("b.places").alias("places")
    )
    joined = slim.join(
        verified, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_hash") == F.col("of_hash")), "left"
    )
    base = F.array_sort(F.array_distinct("places.label"))
    return joined.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places.start").cast("long").alias("first_word"),
        F.array_max("places.start").cast("long").alias("last_word"),
        base.alias("base"),
        F.array_sort(F.array_union(base, F.coalesce("found", F.array().cast("array<string>")))).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
        "spans",
    )
