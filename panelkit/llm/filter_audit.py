"""How corpus filters interact: what each would remove in every order of running them.

Each filter's failing rows are stored once as a table of row ids. What a filter finds left
after others have run is then a question about those tables: its ids without (left anti) or
with (left semi) an id among the earlier filters'. The outcome depends on which filters ran
before, not on their order, so every set of earlier filters is asked once and the orders are
put together from the answers.
"""

from __future__ import annotations

from itertools import combinations, permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import durable, quoted

# Filters as conditions on the measures; a text fails where the condition is true.
RULES = {
    "A": "n_words < 200",
    "B": "100 * n_distinct < 50 * n_words",
    "C": "100 * n_upper > 2 * n_chars",
    "D": "has_mark",
}
COPIES = "E"  # a text that a smaller id has, too

_SPACE = r"[\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BUCKETS = 64  # a group of copies is dealt out to so many keys

_COUNTS = ["removed", "redundant", "good_lost", "toxic_lost"]


def measured(df: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``row, doc_id, part, digest`` and whether the text fails each rule, written once.

    ``row`` numbers the rows of this table, so rows that share an id stay apart.
    """
    texts = df.select(
        quoted(doc_id).alias("doc_id"),
        F.coalesce(quoted(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(quoted(text), F.lit("")).alias("text"),
    )
    words = F.array_remove(F.split("text", _SPACE), "")
    found = texts.withColumn("words", words).select(
        "doc_id",
        "part",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        F.size("words").alias("n_words"),
        F.size(F.array_distinct("words")).alias("n_distinct"),
        F.length("text").alias("n_chars"),
        (F.length("text") - F.length(F.translate("text", _UPPER, ""))).alias("n_upper"),
        F.rlike("text", F.lit("[#$%&*|]")).alias("has_mark"),
    )
    flags = [F.expr(sql).alias(name) for name, sql in RULES.items()]
    return durable(found.select(F.monotonically_increasing_id().alias("row"), "doc_id", "part", "digest", *flags))


def copies(rows: DataFrame) -> DataFrame:
    """The rows whose text also stands under a smaller id; rows without an id are not compared.

    The smallest id is found per text and bucket, then per text, and goes back to the buckets,
    so a text that a third of all rows share is spread over many keys.
    """
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(_BUCKETS)))
    held = dealt.groupBy("digest", "bucket").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    firsts = held.groupBy("digest").agg(F.min("least").alias("first"), F.max("most").alias("last"))
    firsts = firsts.filter("first < last")
    known = held.join(firsts, "digest").select(
        F.col("digest").alias("held_digest"), F.col("bucket").alias("held_bucket"), "first"
    )
    same = (F.col("digest") == F.col("held_digest")) & (F.col("bucket") == F.col("held_bucket"))
    return dealt.join(known, same & (F.col("doc_id") > F.col("first")), "left_semi").select(*rows.columns)


def id_tables(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``row, part, name``, stored in a folder per name: the failing rows of each filter, and
    under ``good`` and ``toxic`` the rows with these labels.

    A document with conflicting labels is in both. Labels without an id, or of no document,
    are in none.
    """
    tables = {name: rows.filter(name) for name in RULES} | {COPIES: copies(rows)}
    for name, condition in (("good", "quality = 1"), ("toxic", "toxic = 1")):
        marked = labels.filter(condition).select(F.col("doc_id").alias("labelled")).distinct()
        tables[name] = rows.join(marked, F.col("doc_id") == F.col("labelled"), "left_semi")
    named = [df.select("row", "part", F.lit(name).alias("name")) for name, df in tables.items()]
    out = named[0]
    for df in named[1:]:
        out = out.unionByName(df)
    return durable(out, by="name")


def survivors(rows: DataFrame, tables: DataFrame, prefix: str) -> DataFrame:
    """The rows that are left after the filters of ``prefix`` have run, in any order."""
    failing = tables.filter(F.col("name").isin(list(prefix))).select(F.col("row").alias("failing"))
    return rows.join(failing, F.col("row") == F.col("failing"), "left_anti")


def _sets(letters: list[str]) -> list[str]:
    return ["".join(c) for n in range(len(letters) + 1) for c in combinations(letters, n)]


def after_prefixes(tables: DataFrame) -> DataFrame:
    """``part, name, prefix`` and, for the rows that fail ``name``, how many are removed and how
    many redundant after the filters of the set ``prefix``, and the labels lost by removals.

    The id tables are dealt out by row once; the sets are asked behind that, inside the tasks.
    """
    letters = [*RULES, COPIES]
    others = F.create_map(
        *[x for f in letters for x in (F.lit(f), F.array(*map(F.lit, _sets([o for o in letters if o != f]))))]
    )
    ids = tables.filter(F.col("name").isin(letters))
    hits = ids.select(F.col("row").alias("hit"), F.col("name").alias("earlier")).repartition("hit")

    def asked(failing: DataFrame) -> DataFrame:
        dealt = failing.repartition("row")
        return dealt.select("row", "part", "name", F.explode(others[F.col("name")]).alias("prefix"))

    def marked(label: str) -> DataFrame:
        listed = tables.filter(F.col("name") == label).select(F.col("row").alias("marked"))
        return ids.join(listed, F.col("row") == F.col("marked"), "left_semi")

    before = (F.col("row") == F.col("hit")) & F.contains("prefix", "earlier")
    found = {
        "removed": asked(ids).join(hits, before, "left_anti"),
        "redundant": asked(ids).join(hits, before, "left_semi"),
        "good_lost": asked(marked("good")).join(hits, before, "left_anti"),
        "toxic_lost": asked(marked("toxic")).join(hits, before, "left_anti"),
    }
    counted = None
    for kind, df in found.items():
        own = [(F.count(F.lit(1)) if c == kind else F.lit(0).cast("long")).alias(c) for c in _COUNTS]
        one = df.groupBy("part", "name", "prefix").agg(*own)
        counted = one if counted is None else counted.unionByName(one)
    return counted.groupBy("part", "name", "prefix").agg(*[F.sum(c).alias(c) for c in _COUNTS])


def audit(
    df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source"
) -> DataFrame:
    """A row per part, order of the filters and step; see the columns below.

    ``filter_order`` is the order in which the filters run, ``step`` (from 1) names one of
    them. ``kept``: rows left after it; ``removed``: rows it removes; ``redundant``: rows that fail it
    but went earlier; ``unique_fails``: rows that fail nothing else; ``good_lost``, ``toxic_lost``:
    removed rows with label quality 1, toxic 1; ``shapley``: rows it removes, summed over all
    orders. Rows without a part are the part with the empty name. A NULL text is empty:
    it fails A, and E if a smaller id has an empty text. Rows without an id neither are copies
    nor make others copies; of rows that share id and text none is the other's copy, and each
    counts. An empty table gives an empty result; other columns are not read.
    """
    rows = measured(df, doc_id, text, part)
    cells = after_prefixes(id_tables(rows, labels))
    letters = [*RULES, COPIES]
    n = len(letters)
    orders = ["".join(p) for p in permutations(letters)]

    size = F.length("prefix")
    ways = F.element_at(F.array(*[F.lit(factorial(k) * factorial(n - 1 - k)) for k in range(n)]), size + 1)
    shapley = [F.sum(F.when(F.col("name") == f, F.col("removed") * ways)).alias(f"shapley_{f}") for f in letters]
    counts = F.struct(*_COUNTS)
    # a part has at most one entry per filter and set of the others
    entries = F.collect_list(F.struct(F.concat_ws("|", "name", "prefix"), counts))
    per_part = cells.groupBy("part").agg(F.map_from_entries(entries).alias("cells"), *shapley)
    total = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    whole = total.join(per_part.withColumnRenamed("part", "cell_part"), F.col("part") == F.col("cell_part"), "left")

    steps = whole.withColumn("filter_order", F.explode(F.split(F.lit(",".join(orders)), ",")))
    steps = steps.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n))))
    name = F.substr("filter_order", F.col("step"), F.lit(1))

    def place(f: str) -> Column:
        return F.locate(f, F.col("filter_order"))

    def cell(f: Column, prefix: Column, count: str) -> Column:
        return F.coalesce(F.try_element_at("cells", F.concat_ws("|", f, prefix))[count], F.lit(0))

    def earlier_than(at: Column) -> Column:
        return F.concat(*[F.when(place(o) < at, o).otherwise("") for o in letters])

    gone = [
        F.when(place(f) <= F.col("step"), cell(F.lit(f), earlier_than(place(f)), "removed")).otherwise(0)
        for f in letters
    ]
    rest = F.concat(*[F.when(name != o, o).otherwise("") for o in letters])
    own = F.coalesce(*[F.when(name == f, F.col(f"shapley_{f}")) for f in letters], F.lit(0))
    found = [cell(name, earlier_than(F.col("step")), c).cast("long").alias(c) for c in _COUNTS]
    return steps.select(
        "part",
        "filter_order",
        "step",
        (F.col("n") - sum(gone[1:], gone[0])).alias("kept"),
        *found[:2],
        cell(name, rest, "removed").alias("unique_fails"),
        *found[2:],
        own.cast("long").alias("shapley"),
    )
