"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.session import durable


def _spread(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: a node's neighbours are linked to the smallest of them.

    The large step looks at all neighbours and moves the larger ones, the small step
    looks at the smaller ones and moves them and the node itself. The smallest neighbour
    is an aggregate and joined back, so the neighbours of one node are never gathered.
    """
    if large:
        flipped = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
        around = edges.unionByName(flipped)
    else:
        around = edges
    least = around.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    joined = around.join(least, F.col("u") == F.col("w"))
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return out.filter("u <> v").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node that some edge ``(a, b)`` touches.

    ``root`` is the smallest node that can be reached. Alternating large and small star
    steps (Kiveris et al., 2014) until every edge points at a root; each round is written
    to the shared folder, so a lost executor costs one round. Edges with a NULL end and
    loops are ignored; an empty table gives an empty result. Node type: a number.
    """
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    now = durable(now.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct())
    seen = _state(now)
    while seen[0]:
        now = durable(_spread(_spread(now, True), False))
        state = _state(now)
        if state == seen:
            break
        seen = state
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), digest).first())
