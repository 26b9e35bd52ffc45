"""Shards of bounded size by extendible hashing.

A directory is indexed by the leading bits of a row's hash. It starts with one bucket, and a
bucket whose rows exceed the byte limit, and only such a bucket, splits on one more bit, until
every bucket fits. Shards stay as large as the limit allows, and a table that grows splits a
few more buckets while all others keep their rows.

DataFrame operations only. Buckets are split over a histogram: bytes per hash prefix of
``STEP`` bits, one aggregate that combines before the shuffle; only rows of buckets that are
too large even then go into a finer histogram of the next ``STEP`` bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import durable, own, quoted

STEP = 12  # bits looked at in a round
BITS = 60  # bits of the hash


def hash_bits(key: Column) -> Column:
    """The first 60 bits of the MD5 of a key as text, as a string of 0 and 1; NULL is empty."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, BITS // 4)
    return F.lpad(F.conv(digits, 16, 2), BITS, "0")


def assign(
    df: DataFrame, limit: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, shard, depth, shard_bytes, fits``, one row per row of ``df``.

    ``n_bytes`` is the size of the text in UTF-8, 0 for NULL. ``shard`` holds the hash bits of
    the bucket, ``depth`` their number; ``shard_bytes`` is at most ``limit`` unless all
    bits are used up: rows with one key cannot be told apart, so they stay together in a shard
    of their own, and ``fits`` is false if they exceed the limit. An empty table gives an
    empty result; other columns are not read.
    """
    rows = df.select(
        quoted(key).alias("doc_id"),
        F.coalesce(F.octet_length(quoted(text)).cast("long"), F.lit(0).cast("long")).alias("n_bytes"),
        hash_bits(quoted(key)).alias("bits"),
    )
    rows = durable(rows)
    open_rows = rows.select("bits", "n_bytes")
    found = None
    for base in range(0, BITS, STEP):
        top = min(base + STEP, BITS)
        shards, open_rows = _round(open_rows, limit, base, top)
        found = shards if found is None else found.unionByName(shards)
        if top == BITS or open_rows.isEmpty():
            break
    found = durable(found)
    # A row's shard is the one whose bits begin its own: one equality join on the fine prefix
    # of the round in which the bucket was closed.
    out = None
    for base in range(0, top, STEP):
        width = min(base + STEP, BITS)
        here = found.filter(F.col("round") == base).drop("round")
        part = rows.withColumn("prefix", F.substring("bits", 1, width)).join(here, "prefix")
        part = part.select("doc_id", "n_bytes", "shard", "depth", "shard_bytes")
        out = part if out is None else out.unionByName(part)
    return out.withColumn("fits", F.col("shard_bytes") <= limit)


def _round(rows: DataFrame, limit: int, base: int, top: int) -> tuple[DataFrame, DataFrame]:
    """Shards closed with ``base`` to ``top`` bits, by fine prefix, and the rows left open."""
    last = top == BITS
    cells = rows.groupBy(F.substring("bits", 1, top).alias("prefix")).agg(F.sum("n_bytes").alias("bytes"))
    cells = durable(cells)
    depths = F.explode(F.sequence(F.lit(base if base == 0 else base + 1), F.lit(top))).alias("depth")
    sums = cells.select("prefix", "bytes", depths).withColumn("shard", F.expr("substring(prefix, 1, depth)"))
    sums = sums.groupBy("shard", "depth").agg(F.sum("bytes").alias("shard_bytes"))
    fit = sums.filter((F.col("shard_bytes") <= limit) | (F.col("depth") == BITS if last else F.lit(False)))
    each = cells.select("prefix", depths).withColumn("shard", F.expr("substring(prefix, 1, depth)"))
    closed = each.join(fit, ["shard", "depth"]).groupBy("prefix")
    closed = closed.agg(F.min(F.struct("depth", "shard", "shard_bytes")).alias("first"))
    closed = closed.select("prefix", "first.shard", "first.depth", "first.shard_bytes", F.lit(base).alias("round"))
    closed = durable(closed)
    if last:
        return closed, rows.limit(0)
    left = cells.join(closed.select("prefix"), "prefix", "left_anti").select("prefix")
    open_rows = rows.withColumn("prefix", F.substring("bits", 1, top)).join(left, "prefix", "left_semi")
    return closed, open_rows.drop("prefix")


def write_shards(df: DataFrame, path: str, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the rows of ``df``, whole, in a Parquet folder per shard; returns the directory.

    The directory has ``shard, depth, shard_bytes, fits``, a row per shard. Folders are named
    after the column ``shard``, or ``shard_`` where ``df`` has one of that name. Rows that share a
    key, or have none, are together in one shard, which may not fit then; no row is lost or
    doubled. An empty table writes no folder.
    """
    placed = durable(assign(df, limit, key, text))
    name, found = own("shard", df.columns), own("placed_key", df.columns)
    keys = placed.select(F.col("doc_id").alias(found), F.col("shard").alias(name)).distinct()
    rows = df.join(keys, quoted(key).eqNullSafe(F.col(found))).drop(found)
    rows.repartition(name).write.partitionBy(name).parquet(path)
    return placed.select("shard", "depth", "shard_bytes", "fits").distinct()
