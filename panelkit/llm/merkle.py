"""Document fingerprints that are Merkle trees.

A text is cut into paragraphs at line ends, and a paragraph into sentences; the hashes of the
sentences are the leaves. A paragraph's hash is that of its leaves, and paragraphs are grouped
into sections that end where a paragraph's hash says so, so an insertion moves no other border.
A section's hash is that of its paragraphs, the root is that of the sections. Equal roots mean
equal texts; where roots differ, only branches with different hashes have to be followed
to find what was edited. The cuts drop exactly one character each, which the shape of the tree
gives back, so different texts have different trees.

DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm.common import quoted

SECTION_ENDS = "0123"  # first hash digits of a paragraph that ends a section: one in four
SENTENCE_ENDS = (".", "!", "?")
DIGITS = 16  # of an inner node or leaf; the root has 64


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _node(content: Column) -> Column:
    return F.substring(F.md5(content.cast("binary")), 1, DIGITS)


def _sentences(paragraph: Column) -> Column:
    """A paragraph cut at the space after a full stop; it has no line end that could be in the way."""
    for mark in SENTENCE_ENDS:
        paragraph = F.replace(paragraph, F.lit(mark + " "), F.lit(mark + "\n"))
    return F.split(paragraph, "\n", -1)


def tree(text: Column) -> Column:
    """``struct(root, sections, paragraphs, leaves)`` of a text; NULL is an empty text.

    ``leaves`` are arrays per paragraph; ``sections`` are ``(hash, first, size)`` in paragraphs.
    """
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    leaves = F.transform(lines, lambda p: F.transform(_sentences(p), _node))

    def with_paragraphs(leaf: Column) -> Column:
        nodes = F.transform(leaf, lambda x: _node(F.array_join(x, ",")))
        return _let(nodes, lambda n: with_sections(leaf, n))

    def with_sections(leaf: Column, nodes: Column) -> Column:
        ends = F.filter(
            F.transform(
                nodes,
                lambda x, i: F.when(
                    F.substring(x, 1, 1).isin(*SECTION_ENDS) | (i == F.size(nodes) - 1), i + 1
                ),
            ),
            lambda i: i.isNotNull(),
        )

        def section(begin: Column, end: Column) -> Column:
            part = F.slice(nodes, begin + 1, end - begin)
            return F.struct(_node(F.array_join(part, ";")).alias("hash"), begin.alias("first"), (end - begin).alias("size"))

        def whole(stops: Column) -> Column:
            starts = F.concat(F.array(F.lit(0)), F.slice(stops, 1, F.size(stops) - 1))
            found = F.zip_with(starts, stops, section)
            return _let(
                found,
                lambda s: F.struct(
                    _root(s).alias("root"), s.alias("sections"), nodes.alias("paragraphs"), leaf.alias("leaves")
                ),
            )

        return _let(ends, whole)

    return _let(leaves, with_paragraphs)


def _root(sections: Column) -> Column:
    return F.sha2(F.array_join(F.transform(sections, lambda s: s["hash"]), "|").cast("binary"), 256)


def printed(node: Column) -> Column:
    """The tree as text: its root, then the leaves by paragraph (``;``) and section (``|``)."""

    def paragraph(leaf: Column) -> Column:
        return F.array_join(leaf, ",")

    def section(s: Column) -> Column:
        own = F.slice(node["leaves"], s["first"] + 1, s["size"])
        return F.array_join(F.transform(own, paragraph), ";")

    return F.concat_ws(":", node["root"], F.array_join(F.transform(node["sections"], section), "|"))


def likeness(a: Column, b: Column) -> Column:
    """The share of distinct leaves that two trees have in common, 1 for equal roots."""
    one, two = F.flatten(a["leaves"]), F.flatten(b["leaves"])
    shared = F.size(F.array_intersect(one, two))
    return F.when(a["root"] == b["root"], 1.0).otherwise(shared / F.size(F.array_union(one, two)))


def changed_sections(a: Column, b: Column) -> Column:
    """``(first, size)`` in paragraphs of the branches of ``a`` that ``b`` does not have."""
    there = F.transform(b["sections"], lambda s: s["hash"])
    branches = F.filter(a["sections"], lambda s: ~F.array_contains(there, s["hash"]))
    places = F.transform(branches, lambda s: F.struct(s["first"], s["size"]))
    return F.when(a["root"] == b["root"], F.slice(places, 1, 0)).otherwise(places)


def with_next(df: DataFrame, key: str, text: str) -> DataFrame:
    """``df`` with ``next``, the text of the row with the next larger key; the last has the first.

    Rows are dealt into ranges of keys of about equal size (quantiles of the keys, a fixed
    number of values on the driver). Each range is a group of one window, and the first row of
    a range also visits the range before it, so every text moves once and no task sees more
    than its range. Equal keys are in the order of their texts; a NULL key is the smallest.
    """
    spark = df.sparkSession
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.coalesce(F.col(key).cast("long"), F.lit(-(2**63)))
    quantiles = [i / parts for i in range(1, parts)]
    bounds = df.agg(F.percentile_approx(F.col(key).cast("long"), quantiles, 100 * parts).alias("b")).first()["b"]
    bounds = sorted(set(bounds or []))
    steps = max(1, len(bounds)).bit_length()
    table = F.array(*[F.lit(b).cast("long") for b in bounds]) if bounds else F.array(F.lit(2**63 - 1).cast("long"))

    def halve(at: Column, step: Column) -> Column:  # binary search: how many bounds are <= order
        up = at + step
        return F.when((up <= F.size(table)) & (F.get(table, up - 1) <= order), up).otherwise(at)

    widths = F.array(*[F.lit(2**i) for i in range(steps, -1, -1)])
    dealt = df.withColumn("__order", order).withColumn("__range", F.aggregate(widths, F.lit(0), halve))
    firsts = dealt.groupBy("__range").agg(F.min("__order").alias("first")).orderBy("__range").collect()
    first = {r["__range"]: r["first"] for r in firsts}
    ranges = sorted(first)
    before = {r: ranges[i - 1] for i, r in enumerate(ranges)}
    width = (ranges[-1] if ranges else 0) + 1
    first_of = F.array(*[F.lit(first.get(r)).cast("long") for r in range(width)])
    before_of = F.array(*[F.lit(before.get(r)).cast("int") for r in range(width)])
    here = F.struct(F.lit(0).alias("visit"), F.col("__range").alias("range"))
    visit = F.struct(F.lit(1).alias("visit"), F.get(before_of, F.col("__range")).alias("range"))
    places = F.when(F.get(first_of, F.col("__range")) == F.col("__order"), F.array(here, visit)).otherwise(F.array(here))
    dealt = dealt.withColumn("__at", F.explode(places))
    window = Window.partitionBy("__at.range").orderBy("__at.visit", "__order", text)
    dealt = dealt.withColumn("next", F.lead(text).over(window)).filter("__at.visit = 0")
    return dealt.drop("__order", "__range", "__at")


def fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` (the printed tree) of each row; NULL is an empty text."""
    return df.select(quoted(doc_id).alias("doc_id"), printed(tree(quoted(text))).alias("fingerprint"))


def compare_with_edit(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of an edited one, and how alike they are.

    The edit replaces the last quarter of the code points (rounded down) by the first as many,
    or all, of the next text. ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, edited_from`` (the first paragraph of a branch that the edit
    changed, NULL without one). A NULL text is empty. Repeated ids follow each other in the
    order of their texts. A table of one row is its own next. An empty table gives an empty
    result; other columns are not read.
    """
    slim = df.select(quoted(doc_id).alias("doc_id"), F.coalesce(quoted(text), F.lit("")).alias("text"))
    paired = with_next(slim, "doc_id", "text")
    n = F.length("text")
    tail = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - tail), F.substring("next", F.lit(1), tail))
    paired = paired.select("doc_id", n.cast("long").alias("n_chars"), "text", "next", edited.alias("edited"))
    trees = paired.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        tree(F.col("text")).alias("own"),
        tree(F.col("edited")).alias("other"),
        tree(F.col("next")).alias("after"),
    )
    own, other, after = F.col("own"), F.col("other"), F.col("after")
    return trees.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        printed(own).alias("fingerprint"),
        printed(other).alias("edited_fingerprint"),
        likeness(own, other).alias("near_edited"),
        likeness(own, after).alias("near_next"),
        F.get(changed_sections(own, other), F.lit(0))["first"].cast("long").alias("edited_from"),
    )
