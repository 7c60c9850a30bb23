"""License scans by diagonal voting.

All rolling word pairs of a text are joined by hash to their places in license
templates.  A match votes for the diagonal (its place in the text less that in
the template); votes are counted by diagonal, neighbouring diagonals (a word
put in or left out) are merged, and a span is kept if it holds enough of its
template.  Pairs are also compared word by word in the join, so a span is
verified by the words themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import PLACE, placed

K = 2
WORD = r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"

# The base phrases with their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Opening words of public license notices with the labels that the method adds.
NOTICES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction", "mit-text"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met", "bsd-text"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
     "the license", "apache-2.0-notice"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
     "license as published by the free software foundation", "gpl-notice"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("licensed under cc by sa 4 0", "cc-by-sa-4.0"),
    ("released under the mit license", "mit-release"),
)


def templates() -> list[tuple[int, str, bool, list[str]]]:
    """(number, label, whether it is a base phrase, words)."""
    rows = [(p, label, True) for p, label in PHRASES] + [(p, label, False) for p, label in NOTICES]
    return [(i, label, base, p.split()) for i, (p, label, base) in enumerate(rows)]


def template_grams(spark: SparkSession) -> DataFrame:
    """A few hundred rows, whatever the input: a row for each K words of each template."""
    rows = [(i, label, base, len(w), at, " ".join(w[at:at + K]))
            for i, label, base, w in templates() for at in range(len(w) - K + 1)]
    d = spark.createDataFrame(rows, "template int, label string, base boolean, template_words int, at int, template_gram string")
    return d.withColumn("hash", F.xxhash64("template_gram"))


def matches(docs: DataFrame, text: str = "text") -> DataFrame:
    """place, doc_id, n_words, pos, template, label, base, template_words, at: a
    row for each pair of words that text and template share, and one row without
    template for each text."""
    # Lower-casing letters other than A-Z leaves word bounds and all template words as they are.
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(WORD), F.lit(1))
    d = placed(docs, F.col("doc_id").alias("doc_id"), words.alias("words"))
    grams = F.when(F.size("words") >= K, F.transform(F.sequence(F.lit(0), F.size("words") - K), lambda i: F.concat_ws(
        " ", *[F.get("words", i + j) for j in range(K)]))).otherwise(F.array().cast("array<string>"))
    d = d.select("doc_id", *PLACE, F.size("words").cast("long").alias("n_words"),
                 F.posexplode(F.concat(F.array(F.lit("")), grams)).alias("pos", "gram"))
    d = d.select("*", F.xxhash64("gram").alias("hash"))
    t = template_grams(docs.sparkSession)
    mark = docs.sparkSession.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name not in ("template_gram", "hash")
                                               else (F.lit("") if f.name == "template_gram" else F.xxhash64(F.lit(""))).alias(f.name)
                                               for f in t.schema.fields])
    t = t.unionByName(mark)
    return d.join(F.broadcast(t.withColumnRenamed("hash", "template_hash")), (F.col("hash") == F.col("template_hash"))
                  & (F.col("gram") == F.col("template_gram"))).select(
        "doc_id", *PLACE, "n_words", (F.col("pos") - 1).alias("pos"), "template", "label", "base", "template_words", "at")


def spans(docs: DataFrame, least_share: float = 0.75, strong: float = 0.25, gap: int = 2, text: str = "text") -> DataFrame:
    """Verified spans, and one row without template for each text: doc_id, place,
    n_words, template, label, base, first, last (words of the text), share (of
    the template's pairs that the span holds).

    A base phrase counts where all its words stand consecutively on one diagonal.
    Diagonals of a notice need a ``strong`` share of its pairs, and two votes;
    those ``gap`` or less apart are merged, and ``least_share`` of the pairs must
    be there together.
    """
    pairs = F.col("template_words") - (K - 1)
    key = [*PLACE, "doc_id", "n_words", "template", "label", "base", "template_words"]
    # one shuffle, by text: a text's matches are bounded by its length
    found = matches(docs, text).repartition(*PLACE).withColumn("diagonal", F.col("pos") - F.col("at"))
    d = found.groupBy(*key, "diagonal").agg(F.count(F.lit(1)).alias("votes"), F.min("pos").alias("lo"), F.max("pos").alias("hi"))
    d = d.where(F.col("template").isNull() | F.when(F.col("base"), F.col("votes") == pairs).otherwise(
        F.col("votes") >= F.greatest(F.lit(2.0), strong * pairs)))
    w = W.partitionBy(*PLACE, "template").orderBy("diagonal")
    before = F.lag("diagonal").over(w)
    d = d.withColumn("run", F.coalesce(F.col("base") | (F.col("diagonal") - before > gap), F.lit(True)).cast("int"))
    d = d.withColumn("run", F.sum("run").over(w))
    d = d.groupBy(*key, "run").agg(F.sum("votes").alias("votes"), F.min("lo").alias("first"), (F.max("hi") + K - 1).alias("last"))
    share = F.least(F.lit(1.0), F.col("votes") / pairs)
    return d.withColumn("share", F.when(F.col("template").isNotNull(), share)).where(
        "template is null or share >= %s" % least_share).drop("votes", "run", "template_words")


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """For each row: place, doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score (the best share of any template; 0 without).

    Null and empty texts have no words, no labels (empty strings) and score 0;
    null ids, repeated rows and ties are told apart by place; further columns
    are left out; an empty table gives no rows.
    """
    start = F.when(F.col("base"), F.col("first"))
    joined = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")
    return spans(docs, text=text).groupBy(*PLACE, "doc_id", "n_words").agg(
        F.count(start).alias("n_base"), F.min(start).cast("long").alias("first_word"), F.max(start).cast("long").alias("last_word"),
        joined(F.when(F.col("base"), F.col("label"))).alias("base_labels"), joined("label").alias("labels"),
        F.coalesce(F.max("share"), F.lit(0.0)).alias("score"))
