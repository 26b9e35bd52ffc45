"""Bounded samples of labelled texts for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LONGEST = 20_000  # code points; longer texts are not drawn, so a sample is bounded in bytes too


def labelled_sample(texts: DataFrame, label: str, per_label: int, total: int) -> list[tuple]:
    """At most ``total`` pairs (text, label), at most ``per_label`` of each label.

    ``texts`` has ``doc_id, text`` and the label. Rows are drawn in the order of a hash of
    their id, so the sample is uniform and the same on every run. Only ids and labels are
    shuffled; the drawn ids, whose number is bounded, are then joined to the texts.
    """
    ids = texts.filter(F.length("text") <= LONGEST).select("doc_id", label).filter(F.col(label).isNotNull())
    place = F.xxhash64("doc_id")
    ranked = ids.withColumn("r", F.row_number().over(Window.partitionBy(label).orderBy(place, "doc_id")))
    drawn = ranked.filter(F.col("r") <= per_label).orderBy("r", label).limit(total).select("doc_id").distinct()
    chosen = texts.join(F.broadcast(drawn), "doc_id").filter(F.length("text") <= LONGEST)
    rows = chosen.select("doc_id", "text", label).filter(F.col(label).isNotNull()).orderBy("doc_id", "text").limit(total)
    return [(r["text"], r[label]) for r in rows.collect()]


def uniform_sample(texts: DataFrame, label: str, total: int) -> list[tuple]:
    """At most ``total`` pairs (text, label) with the labels in their natural proportions.

    Drawn as in :func:`labelled_sample`; each task sends at most ``total`` ids.
    """
    ids = texts.filter(F.length("text") <= LONGEST).select("doc_id")
    drawn = ids.distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(total)
    chosen = texts.join(F.broadcast(drawn), "doc_id").filter(F.length("text") <= LONGEST)
    rows = chosen.select("doc_id", "text", label).orderBy("doc_id", "text").limit(total)
    return [(r["text"], r[label]) for r in rows.collect()]
