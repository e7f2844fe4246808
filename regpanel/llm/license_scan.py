"""License scan by diagonal voting, with DataFrame functions only.

Every word k-gram of every text is joined to the positions of that k-gram in
the license templates (a fixed table, broadcast: its size is that of the
template list).  A hit votes for the diagonal ``text position - template
position``; hits are aggregated by (document, template, diagonal), which Spark
combines on the map side, then neighbouring diagonals are merged into spans.
Grams are joined on their hash and verified on their text, so a diagonal that
holds all of a template's grams is an exact occurrence.

Defined cases: a null text counts as empty (no words, no span); repeated rows
give one result row each; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

K = 3
GAP = 3  # diagonals this close belong to one occurrence with words added or left out
COVER = 0.8  # part of a template's grams that a span must hold
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The phrases whose exact occurrences make the base labels.
BASE = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
# Passages of public license texts, for the labels of the method.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files"),
    ("mit", "released under the mit license"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license"),
    ("gpl-3", "under the gnu general public license version 3"),
    ("gpl", "under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("agpl", "gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by", "creative commons attribution 4 0 international license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)


def template_grams(spark: SparkSession, base=BASE, templates=TEMPLATES, k: int = K) -> DataFrame:
    """(t_gram, template, label, is_base, tpos, n_grams, bit): one row per template position."""
    rows = []
    for i, (label, text) in enumerate([*base, *templates]):
        w = text.split()
        if len(w) < k:
            raise ValueError(f"a template needs {k} words or more: {text}")
        n = len(w) - k + 1
        if n > 63:  # a diagonal's votes are the bits of one long
            raise ValueError(f"split the template, it has more than 63 grams: {text}")
        rows += [(" ".join(w[p:p + k]), i, label, i < len(base), p, n, 1 << p) for p in range(n)]
    return spark.createDataFrame(
        rows, "t_gram string, template int, label string, is_base boolean, tpos int, n_grams int, bit long")


def _hits(docs: DataFrame, grams: DataFrame, k: int) -> DataFrame:
    """One row per (document, gram hit), and one with template -1 per document."""
    t = F.translate(F.coalesce(F.col("text"), F.lit("")), UPPER, LOWER)
    d = docs.select("doc_id", F.xxhash64("text").alias("fp"),
                    F.filter(F.split(t, BREAK, -1), lambda w: w != "").alias("words"))
    w, n = F.col("words"), F.size("words")
    item = lambda i: F.struct(i.alias("pos"), F.concat_ws(" ", *[F.get(w, i + j) for j in range(k)]).alias("gram"))
    own = F.array(F.struct((-1 - n).alias("pos"), F.lit("").alias("gram")))  # the document itself: no words
    # outer: the filter that Spark infers for explode would split the text anew for every gram
    d = d.withColumn("items", F.when(n >= k, F.concat(own, F.transform(F.sequence(F.lit(0), n - k), item))).otherwise(own))
    e = d.select("doc_id", "fp", F.explode_outer("items").alias("x")).select("doc_id", "fp", "x.pos", "x.gram")
    spark = docs.sparkSession
    mark = spark.createDataFrame([("", -1, None, False, 0, 1, 1)], grams.schema)
    g = grams.unionAll(mark).withColumn("h", F.xxhash64("t_gram"))
    e = e.withColumn("h", F.xxhash64("gram"))
    return e.join(F.broadcast(g), (e["h"] == g["h"]) & (e["gram"] == g["t_gram"])).drop("h", "gram", "t_gram")


def license_spans(docs: DataFrame, grams: DataFrame | None = None, k: int = K, gap: int = GAP,
                  cover: float = COVER) -> DataFrame:
    """One row per (doc_id, fp): n_words, copies (input rows) and ``spans``, an
    array of (template, label, is_base, exact, first, last, score)."""
    grams = template_grams(docs.sparkSession, k=k) if grams is None else grams
    key = ["doc_id", "fp"]
    diag = (_hits(docs, grams, k)
            .groupBy(*key, "template", (F.col("pos") - F.col("tpos")).alias("diag"))
            .agg(F.first("label").alias("label"), F.first("is_base").alias("is_base"), F.first("n_grams").alias("n_grams"),
                 F.bit_or("bit").alias("grams"),
                 F.min("pos").alias("first"), F.max("pos").alias("last"), F.count("*").alias("rows"))
            .withColumn("votes", F.bit_count("grams")))
    w = Window.partitionBy(*key, "template").orderBy("diag")
    new = F.coalesce(F.col("diag") - F.lag("diag").over(w) > gap, F.lit(True)).cast("int")
    diag = diag.withColumn("new", new).withColumn("island", F.sum("new").over(w))
    # an exact occurrence is a span by itself; the rest of an island is one merged span
    exact = (F.col("votes") == F.col("n_grams")) & (F.col("template") >= 0)
    diag = diag.withColumn("exact", exact).withColumn("at", F.when(exact, F.col("diag")).otherwise(F.lit(None)))
    spans = (diag.groupBy(*key, "template", "island", "exact", "at")
             .agg(F.first("label").alias("label"), F.first("is_base").alias("is_base"),
                  F.min("first").alias("first"), (F.max("last") + k).alias("last"),
                  (F.bit_count(F.bit_or("grams")) / F.first("n_grams")).alias("score"),
                  F.max("rows").alias("rows")))
    own = F.col("template") < 0
    span = F.struct("template", "label", "is_base", "exact", "first", "last", "score")
    return (spans.where(own | F.col("exact") | (~F.col("is_base") & (F.col("score") >= cover)))
            .groupBy(*key)
            .agg((-1 - F.max(F.when(own, F.col("first")))).cast("long").alias("n_words"),
                 F.max(F.when(own, F.col("rows"))).alias("copies"),
                 F.collect_list(F.when(~own, span)).alias("spans")))


def license_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row with the base counts and the labels."""
    d = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    s = license_spans(d)
    base = F.filter("spans", lambda x: x["is_base"])
    names = lambda a: F.array_join(F.array_sort(F.array_distinct(F.transform(a, lambda x: x["label"]))), ",")
    at = F.transform(base, lambda x: x["first"])
    return (s.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
                    F.array_min(at).cast("long").alias("first_word"), F.array_max(at).cast("long").alias("last_word"),
                    names(base).alias("base_labels"), names(F.col("spans")).alias("labels"),
                    F.coalesce(F.array_max(F.transform("spans", lambda x: x["score"])), F.lit(0.0)).alias("score")))
