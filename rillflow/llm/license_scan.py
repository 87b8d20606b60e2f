"""License scan by diagonal voting, with DataFrame functions only.

Every rolling word bigram of every text is looked up by its hash among the bigrams of the
templates (a fixed table of a few hundred rows, broadcast).  A hit votes for the diagonal
``position in the text - position in the template``; votes are counted per (text, template,
diagonal).  Diagonals that lie close to each other are one find with words put in or left out: they
are merged, and the find is kept if the template's bigrams that it covers are at least the
template's share ``MIN_COVER`` of all.  Short phrases need all their bigrams on one diagonal, which
together with the exact comparison of the words makes them exact.

A text's hits meet in one task, never those of several texts: a line that all documents share makes
one small group in each.  Null text counts as empty; every input row gives one output row, repeated
rows included; columns other than the id are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillflow.llm.common import LOWER, UPPER, whole_text

# Phrases that must stand word for word, and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# Sentences by which texts name their license, and labels of their own.
TEMPLATES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software "
    "and associated documentation files": "mit",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "this program is free software you can redistribute it and or modify it under the terms of the "
    "gnu general public license as published by the free software foundation": "gpl-any",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "licensed under cc by 4 0": "cc-by-4.0",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-4.0",
    "redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met": "bsd",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "gnu lesser general public license version 2 1": "lgpl-2.1",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MIN_COVER = 0.85
#: Diagonals this near to each other belong to one find.
NEAR = 3


def lower_words(text: Column) -> Column:
    """Words of the lower-cased text; the first or last may be empty, which no template has."""
    return F.split(F.translate(text, UPPER, LOWER), SEPARATORS, -1)


def template_bigrams(spark: SparkSession) -> DataFrame:
    """``(h, gram, template, at, bit, of, label, exact)``: one row for each bigram of each template."""
    rows = []
    for number, (text, label, exact) in enumerate(
        [(t, v, True) for t, v in PHRASES.items()] + [(t, v, False) for t, v in TEMPLATES.items()]
    ):
        words = text.split(" ")
        rows += [
            (f"{a} {b}", number, at, 1 << at, len(words) - 1, label, exact)
            for at, (a, b) in enumerate(zip(words, words[1:]))
        ]
    schema = "gram string, template int, at int, bit long, of int, label string, exact boolean"
    return spark.createDataFrame(rows, schema).withColumn("h", bigram_hash(
        F.substring_index("gram", " ", 1), F.substring_index("gram", " ", -1)))


def bigram_hash(a: Column, b: Column) -> Column:
    return F.xxhash64(a, b)


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: the id, n_words, ``finds`` (array of structs, sorted)."""
    spark = docs.sparkSession
    templates = F.broadcast(template_bigrams(spark))  # a fixed table
    words = F.col("_words")
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.monotonically_increasing_id().alias("_row"),
        lower_words(whole_text(text)).alias("_words"),
    ).withColumns(
        {
            # an empty first word shifts all positions by one
            "_shift": (F.get(words, F.lit(0)) == "").cast("int"),
            "_all": F.size(words)
            - (F.get(words, F.lit(0)) == "").cast("int")
            - ((F.size(words) > 1) & (F.element_at(words, -1) == "")).cast("int"),
        }
    )
    # Position -1 is the row itself, which stays when it has no hit at all.
    at, left, right = F.col("_at"), F.get(words, F.col("_at")), F.get(words, F.col("_at") + 1)
    placed = rows.withColumn("_at", F.explode(F.sequence(F.lit(-1), F.size("_words") - 2))).withColumns(
        {
            "_h": F.when(at >= 0, bigram_hash(left, right)),
            "_n": F.when(at < 0, F.col("_all")),
        }
    )
    hits = placed.join(templates, placed["_h"] == templates["h"], "left").where(
        (at < 0) | (F.col("h").isNotNull() & (F.concat_ws(" ", left, right) == F.col("gram")))
    )
    # Votes per diagonal; the bits say which of the template's bigrams were seen on it.
    votes = hits.groupBy(
        "doc_id", "_row", "template", "label", "exact", "of",
        (F.col("_at") - F.col("at")).alias("diagonal"),
    ).agg(
        F.max("_n").alias("_n"),
        F.max("_shift").alias("_shift"),
        F.min("_at").alias("_from"),
        F.max("_at").alias("_to"),
        F.bit_or("bit").alias("_seen"),
    )
    # Neighbouring diagonals, as far as they also lie side by side in the text, are one find.
    order = Window.partitionBy("_row", "template").orderBy("diagonal", "_from")
    gap = F.col("diagonal") - F.lag("diagonal").over(order)
    marked = votes.withColumn(
        "_new",
        F.when(F.col("exact") | gap.isNull() | (gap > NEAR), 1).otherwise(0),
    ).withColumn("_find", F.sum("_new").over(order))
    finds = marked.groupBy("doc_id", "_row", "template", "label", "exact", "of", "_find").agg(
        F.max("_n").alias("_n"),
        F.max("_shift").alias("_shift"),
        F.min("_from").alias("_from"),
        F.max("_to").alias("_to"),
        F.bit_count(F.bit_or("_seen")).alias("_cover"),
    )
    # Verified: enough of the template, in a stretch not much longer than it.
    share = F.col("_cover") / F.col("of")
    good = F.when(F.col("exact"), F.col("_cover") == F.col("of")).otherwise(
        (share >= MIN_COVER) & (F.col("_to") - F.col("_from") + 1 <= 2 * F.col("of") + NEAR)
    )
    one = F.when(
        F.col("template").isNotNull() & good,
        F.struct(
            (F.col("_from") - F.col("_shift")).cast("long").alias("first_word"),
            (F.col("_to") + 1 - F.col("_shift")).cast("long").alias("last_word"),
            "label",
            "exact",
            share.alias("score"),
        ),
    )
    return finds.groupBy("doc_id", "_row").agg(
        F.max("_n").cast("long").alias("n_words"),
        F.sort_array(F.collect_list(one)).alias("finds"),
    ).select("doc_id", "n_words", "finds")


def digest(found: DataFrame) -> DataFrame:
    base = F.filter("finds", lambda x: x["exact"])
    labels = lambda finds: F.array_join(
        F.array_sort(F.array_distinct(F.transform(finds, lambda x: x["label"]))), ","
    )
    starts = F.transform(base, lambda x: x["first_word"])
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("finds")).alias("labels"),
        F.coalesce(F.array_max(F.transform("finds", lambda x: x["score"])), F.lit(0.0)).alias("score"),
    )
