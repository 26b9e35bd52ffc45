"""License texts found by diagonal voting.

All runs of k consecutive words of every text are hashed and joined to the positions at which
license templates have the same run. A match votes for its diagonal, the difference of the
two positions: a template that stands in a text puts its votes on one diagonal, or on
neighbouring ones if words were added or left out. Votes are summed per diagonal, neighbouring
diagonals are merged, and the span is verified: every vote compares the words themselves, and
enough of the template has to be covered.

Short phrases are templates, too, and need all their votes on one diagonal: those are the places
where the phrase stands. DataFrame operations only; the templates are constants, so the side
that is broadcast has a fixed size (a few hundred rows).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelkit.llm.common import quoted

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SHORT, LONG = 2, 4  # words of a gram of a phrase and of a notice
NEAR = 6  # diagonals this close are one place of a notice
COVERED = 0.6  # share of a notice's grams that has to be found


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrase: bool = False  # has to stand word for word

    @property
    def words(self) -> list[str]:
        return re.findall(WORD, self.text.translate(str.maketrans(UPPER, LOWER)))

    @property
    def size(self) -> int:
        return SHORT if self.phrase else LONG


# Phrases and their labels.
PHRASES = (
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
)

# Notices in the wording of the licenses, and short statements.
NOTICES = (
    Template(
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in"
        " compliance with the License. You may obtain a copy of the License at",
    ),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files (the Software), to deal in the Software without restriction, including"
        " without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell"
        " copies of the Software",
    ),
    Template("mit", "Released under the MIT License"),
    Template(
        "gpl-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version",
    ),
    Template("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met",
    ),
    Template("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
)


def words_of(text: Column) -> Column:
    """The words of a text in lower case (A-Z); NULL has none."""
    plain = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(plain, F.lit(f"({WORD})"), F.lit(1))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _neighbours(hashes: Column, gap: int) -> Column:
    """A hash of each element and the one ``gap`` places on."""
    n = F.greatest(F.size(hashes) - gap, F.lit(0))
    return F.zip_with(F.slice(hashes, 1, n), F.slice(hashes, gap + 1, n), lambda a, b: F.xxhash64(a, b))


def grams_of(words: Column) -> Column:
    """Hashes of the text's two-word runs, then those of its four-word runs."""
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return _let(hashed, lambda h: _let(_neighbours(h, 1), lambda g: F.concat(g, _neighbours(g, 2))))


def template_grams(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """``hash, t, k, at, gram``: each gram of each template."""
    rows = [
        (t, x.size, at, x.words[at : at + x.size])
        for t, x in enumerate(templates)
        for at in range(len(x.words) - x.size + 1)
    ]
    grams = spark.createDataFrame(rows, "t int, k int, at int, gram array<string>")
    at = F.when(F.col("k") == SHORT, 0).otherwise(F.size("gram") - 1)
    return grams.withColumn("hash", F.element_at(grams_of(F.col("gram")), (at + 1).cast("int")))


def votes(df: DataFrame, doc_id: str, text: str, templates: tuple[Template, ...]) -> DataFrame:
    """``row, doc_id, n_words, t, diagonal, votes, first, last``, gathered per diagonal.

    ``votes`` are the places in the template, at most as many as it has, that were found.
    Every row of ``df`` also gives one row with template -1, so texts without a match and
    their sizes come through the same join.
    """
    spark = df.sparkSession
    texts = df.select(
        F.monotonically_increasing_id().alias("row"), quoted(doc_id).alias("doc_id"), words_of(quoted(text)).alias("words")
    )
    texts = texts.withColumn("grams", F.concat(F.array(F.lit(-1).cast("long")), grams_of(F.col("words"))))
    each = texts.select("row", "doc_id", "words", F.posexplode("grams").alias("p", "hash"))
    marker = spark.range(1).select(
        F.lit(-1).alias("t"), F.lit(0).alias("k"), F.lit(0).alias("at"),
        F.array().cast("array<string>").alias("gram"), F.lit(-1).cast("long").alias("hash"),
    )
    known = F.broadcast(template_grams(spark, templates).unionByName(marker))
    pairs = F.greatest(F.size("words") - 1, F.lit(0))
    place = F.when(F.col("k") == SHORT, F.col("p") - 1).otherwise(F.col("p") - 1 - pairs)
    inside = F.when(F.col("k") == SHORT, F.col("p") <= pairs).otherwise(F.col("p") > pairs)
    same = (F.col("p") > 0) & inside & (F.slice(F.col("words"), place + 1, F.col("k")) == F.col("gram"))
    hits = each.join(known, "hash").filter(F.when(F.col("t") < 0, F.col("p") == 0).otherwise(same))
    hits = hits.select(
        "row", "doc_id", F.size("words").cast("long").alias("n_words"), "t",
        F.when(F.col("t") < 0, 0).otherwise(place - F.col("at")).alias("diagonal"),
        F.when(F.col("t") < 0, 0).otherwise(place).alias("place"), "k", "at",
    )
    return hits.groupBy("row", "doc_id", "n_words", "t", "diagonal").agg(
        F.collect_set("at").alias("votes"), F.min("place").alias("first"), (F.max("place") + F.max("k")).alias("last")
    )


def spans(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Verified places: ``row, doc_id, n_words, t, label, phrase, start, stop, score``.

    A row with template -1 stands for each row of ``df``. ``start`` and ``stop`` are word numbers
    from 0, ``stop`` is the first word after the span.
    """
    templates = (*PHRASES, *NOTICES)
    summed = votes(df, doc_id, text, templates)
    facts = [(t, x.label, x.phrase, len(x.words) - x.size + 1, len(x.words)) for t, x in enumerate(templates)]
    facts = df.sparkSession.createDataFrame(
        [*facts, (-1, None, False, 1, 0)], "t int, label string, phrase boolean, grams int, length int"
    )
    summed = summed.join(F.broadcast(facts), "t")
    key = Window.partitionBy("row", "t").orderBy("diagonal")
    apart = F.col("phrase") | (F.col("diagonal") - F.lag("diagonal").over(key) > NEAR)
    summed = summed.withColumn("begins", F.coalesce(apart, F.lit(True)).cast("int"))
    summed = summed.withColumn("place", F.sum("begins").over(key))
    merged = summed.groupBy("row", "doc_id", "n_words", "t", "label", "phrase", "grams", "length", "place").agg(
        F.collect_list("votes").alias("votes"), F.min("first").alias("start"), F.max("last").alias("stop")
    )
    # a place in the template counts once, however often a text repeats it
    merged = merged.withColumn("votes", F.size(F.array_distinct(F.flatten("votes"))))
    covered = F.least(F.col("votes") / F.col("grams"), F.lit(1.0))
    whole = F.when(F.col("phrase"), F.col("votes") == F.col("grams")).otherwise(
        (covered >= COVERED) & (F.col("stop") - F.col("start") <= 2 * F.col("length"))
    )
    merged = merged.withColumn("score", covered).filter((F.col("t") < 0) | whole)
    return merged.select("row", "doc_id", "n_words", "t", "label", "phrase", "start", "stop", "score")


def scan(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Licenses of each text, one row per row of ``df``.

    ``doc_id, n_words, n_base`` (all places of a phrase)``, first_word, last_word`` (the first and
    last start of a phrase, NULL without one)``, base_labels, labels`` (of phrases, and of
    phrases and notices; distinct, sorted, joined by commas)``, n_spans`` (places of notices)``,
    score`` (the best coverage, 1 for a phrase, 0 without a match). A NULL or wordless text
    has no words and no label. Repeated rows give a row each. An empty table gives an
    empty result; other columns are not read.
    """
    found = F.col("t") >= 0
    phrase = found & F.col("phrase")

    def joined(which: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")

    start = F.when(phrase, F.col("start").cast("long"))
    return (
        spans(df, doc_id, text)
        .groupBy("row")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.max("n_words").alias("n_words"),
            F.count(F.when(phrase, 1)).alias("n_base"),
            F.min(start).alias("first_word"),
            F.max(start).alias("last_word"),
            joined(phrase).alias("base_labels"),
            joined(found).alias("labels"),
            F.count(F.when(found & ~F.col("phrase"), 1)).alias("n_spans"),
            F.max(F.when(found, F.col("score")).otherwise(0.0)).alias("score"),
        )
        .drop("row")
    )
