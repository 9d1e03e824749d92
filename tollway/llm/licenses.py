"""License scan by diagonal voting.

All rolling three-word hashes of the documents are joined to the positions of the same hashes in license
templates; hits vote for a diagonal (document position minus template position); neighbouring diagonals, which
a few added or dropped words set apart, are merged; a merged group counts by the longest chain of hits that ascend
in document and template, and is a label when the chain covers enough of the template, the words that tell its
license from others are among the hits, and no span that overlaps it covers its own template better. Phrases are
templates that must stand complete on one diagonal.

Nulls: a null text has no words. A document without hits has empty labels and score 0. Repeated rows get equal
results, one each. Extra columns are not read."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tollway.llm.common import lower_ascii, row_key

K = 3
#: Diagonals at most so far apart are one group.
MERGE = 3
#: A group counts from this share of its template's windows.
COVER = 0.6

# Phrases that label a document wherever they stand.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# One-line notices, openings and long notices of public licenses.
TEMPLATES = [
    ("gpl", "licensed under the GNU General Public License"),
    ("lgpl", "licensed under the GNU Lesser General Public License"),
    ("mit", "licensed under the MIT License"),
    ("bsd", "licensed under the BSD License"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("mpl-2", "licensed under the Mozilla Public License, v. 2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("unlicense", "released under the Unlicense"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("cc-by-nc", "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software"),
]

# Windows that tell a license from others; a span has those that stand in its template.
NEEDED = {
    "mit": ("the mit license",), "bsd": ("the bsd license",), "apache-2": ("apache license version", "license version 2"), "mpl-2": ("mozilla public license", "license v 2"),
    "gpl": ("gnu general public", "general public license"), "lgpl": ("gnu lesser general", "general public license"), "unlicense": ("under the unlicense",),
    "cc-by-nc": ("commons attribution noncommercial", "cc by nc"), "cc-by-sa": ("commons attribution sharealike", "cc by sa"),
}

BREAKS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words(c: Column) -> Column:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the text with A-Z in lower case."""
    return F.filter(F.split(lower_ascii(F.coalesce(c, F.lit(""))), BREAKS), lambda x: x != "")


def grams(w: Column) -> Column:
    some = F.transform(F.sequence(F.lit(0), F.size(w) - K), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))
    return F.when(F.size(w) >= K, some).otherwise(F.array().cast("array<bigint>"))


def template_grams(spark: SparkSession, phrases: dict[str, str], templates: list[tuple[str, str]]) -> DataFrame:
    """hash, g (its words), tid, label, whole (phrase), m (windows), t (position), need (in NEEDED), needs (how many are); as many rows as the templates have windows."""
    rows = [(i, label, whole, text) for i, (label, whole, text) in enumerate([(v, True, k) for k, v in phrases.items()] + [(a, False, b) for a, b in templates])]
    df = spark.createDataFrame(rows, "tid int, label string, whole boolean, text string").withColumn("w", words(F.col("text")))
    df = df.select("tid", "label", "whole", (F.size("w") - K + 1).alias("m"), "w", F.posexplode(grams(F.col("w"))).alias("t", "hash"))
    df = df.select("hash", F.slice("w", F.col("t") + 1, F.lit(K)).alias("g"), "tid", "label", "whole", "m", "t")
    df = df.withColumn("need", F.concat_ws(" ", "label", F.array_join("g", " ")).isin([f"{k} {g}" for k, v in NEEDED.items() for g in v]))
    return df.withColumn("needs", F.count_if("need").over(W.partitionBy("tid")))


def chain(hits: Column) -> Column:
    """Length of the longest chain of hits (i, back, ..), sorted, in which i ascends and back descends strictly."""

    # ends: of each length, the smallest template position that a chain of that length ends with
    def step(ends: Column, hit: Column) -> Column:
        t = -hit["back"]
        n = F.size(F.filter(ends, lambda e: e < t))
        return F.concat(F.slice(ends, F.lit(1), n), F.array(t), F.slice(ends, n + 2, F.size(ends)))

    return F.size(F.aggregate(hits, F.array().cast("array<int>"), step))


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_spans."""
    spark = docs.sparkSession
    doc = docs.select("doc_id", *row_key(F.col("text")), words(F.col("text")).alias("w"))
    doc = doc.withColumn("h", grams(F.col("w")))
    # one more element for each document stands for the document itself
    each = doc.select("doc_id", "k1", "k2", "w", F.size("w").alias("n_words"), F.posexplode(F.concat(F.col("h"), F.array(F.lit(None).cast("bigint")))).alias("i", "hash"))
    hit = each.join(F.broadcast(template_grams(spark, phrases, templates)), "hash", "left")
    true = (F.col("w")[F.col("i")] == F.col("g")[0]) & (F.col("w")[F.col("i") + 1] == F.col("g")[1]) & (F.col("w")[F.col("i") + 2] == F.col("g")[2])
    hit = hit.where(F.col("hash").isNull() | (F.col("tid").isNotNull() & true))
    key = ["doc_id", "k1", "k2"]
    vote = hit.withColumn("d", F.col("i") - F.col("t")).groupBy(*key, "tid", "d").agg(
        F.first("label").alias("label"), F.first("whole").alias("whole"), F.first("m").alias("m"), F.max("n_words").alias("n_words"),
        F.first("needs").alias("needs"), F.count_if(F.col("hash").isNull()).alias("copies"), F.count_distinct("t").alias("votes"),
        F.collect_set(F.when(~F.col("whole"), F.struct("i", (-F.col("t")).alias("back"), "need"))).alias("hits"),
    )
    by = W.partitionBy(*key, "tid").orderBy("d")
    apart = F.col("d") - F.lag("d").over(by)
    part = vote.withColumn("part", F.sum(F.when(apart > MERGE, 1).otherwise(0)).over(by))
    # a phrase that stands complete on its diagonal is a place
    place = F.col("whole") & (F.col("votes") == F.col("m"))
    span = part.groupBy(*key, "tid", "part").agg(
        F.first("label").alias("label"), F.first("whole").alias("whole"), F.first("m").alias("m"), F.max("n_words").alias("n_words"),
        F.first("needs").alias("needs"), F.sum("copies").alias("copies"), F.array_sort(F.flatten(F.collect_list("hits"))).alias("hits"),
        F.count_if(place).alias("n_base"), F.min(F.when(place, F.col("d"))).alias("first_word"), F.max(F.when(place, F.col("d"))).alias("last_word"),
    )
    span = span.withColumn("cover", chain(F.col("hits")) / F.col("m"))
    present = F.size(F.array_distinct(F.transform(F.filter("hits", lambda x: x["need"]), lambda x: x["back"]))) == F.col("needs")
    sure = ~F.col("whole") & (F.col("cover") >= COVER) & present
    rank = F.when(sure, F.struct("cover", "m", (-F.col("tid")).alias("tid"), F.array_min("hits")["i"].alias("start"), F.array_max("hits")["i"].alias("end")))
    span = span.withColumn("rank", rank).withColumn("ranks", F.collect_list("rank").over(W.partitionBy(*key)))
    beaten = F.exists("ranks", lambda x: (x > F.col("rank")) & (x["tid"] != F.col("rank.tid")) & (x["start"] < F.col("rank.end") + K) & (F.col("rank.start") < x["end"] + K))
    good = F.col("rank").isNotNull() & ~F.coalesce(beaten, F.lit(False))
    span, cover = span.withColumn("good", good), F.col("cover")
    good = F.col("good")
    labels = lambda keep: F.array_join(F.array_sort(F.collect_set(F.when(keep, F.col("label")))), ",")
    out = span.groupBy(*key).agg(
        F.max("n_words").cast("long").alias("n_words"), F.sum("n_base").cast("long").alias("n_base"),
        F.min("first_word").cast("long").alias("first_word"), F.max("last_word").cast("long").alias("last_word"),
        labels(F.col("n_base") > 0).alias("base_labels"), labels((F.col("n_base") > 0) | good).alias("labels"),
        F.coalesce(F.max(F.when(F.col("n_base") > 0, 1.0).when(~F.col("whole"), cover)), F.lit(0.0)).alias("score"),
        F.count_if(good).alias("n_spans"), F.sum("copies").alias("copies"),
    )
    rows = out.select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy"))
    return rows.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_spans")
