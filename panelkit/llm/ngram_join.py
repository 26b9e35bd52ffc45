"""Near duplicates: documents whose word n-gram sets have a high Jaccard similarity.

Rare-first prefix filtering. All n-grams are put in one order, rarest first. Two sets that
are similar enough must then share an n-gram among the first few of each, so documents are
joined on those prefix n-grams only, and most pairs of unlike documents never meet. A pair
that meets has to pass, in this order, the length filter (the sizes are close enough), the
positional filter (enough n-grams are left after the shared one) and the suffix filter (parity
signatures of the two sets do not differ in too many bits). The rest is verified exactly,
each pair once.

How it stays linear in a group of copies:

* Documents with equal sets are one class from the start; copies are never paired.
* The pairs of a prefix n-gram are first those with its leader, the class that has it
  earliest. What these verified pairs connect is a component. Then only classes of different
  components that still pass all filters are paired. A link is left out only if both of its
  ends are connected already, so the components are exact.

Frequencies come from a count sketch of a fixed number of counters over all n-grams of all
documents. Their only use is the order, and any common order is correct; collisions cost
candidates, never links. N-grams are 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm import flat
from panelkit.llm.common import durable, own, python_ready, quoted
from panelkit.llm.components import components

SKETCH_BITS = 22  # 4 million counters: 16 MB in a task, 4 MB broadcast as levels
PARTS = 256  # rows in which a sketch travels
SEEN = 500_000  # classes a task remembers, to pass on each only once
HOT = 20_000  # estimated documents of a prefix n-gram from which its rows are spread

_U64 = np.uint64
_DIGEST = "part int, doc_id bigint, cls bigint, size bigint, sig array<bigint>, brief array<bigint>, counts binary"
_POSTING = "gram bigint, salt int, cls bigint, size bigint, pos bigint"
_SET = "cls bigint, grams array<bigint>"


# --- sets -------------------------------------------------------------------


def gram_sets(column, k: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    data, offsets = flat.flatten(column)
    data = flat.LOWER[data]
    starts, ends, docs = flat.spans(data, offsets, flat.SPACE)
    words = flat.hash_spans(data, starts, ends)
    grams, first = flat.windows(words, docs, k)
    n = len(offsets) - 1
    at = np.searchsorted(docs[first], np.arange(n + 1))
    word_at = np.searchsorted(docs, np.arange(n + 1))
    out = []
    for i in range(n):
        if at[i + 1] > at[i]:
            g = np.sort(grams[at[i] : at[i + 1]])
            keep = np.ones(len(g), bool)
            np.not_equal(g[1:], g[:-1], out=keep[1:])
            out.append(g[keep])
        else:
            few = words[word_at[i] : word_at[i + 1]]
            whole = np.zeros(len(few), np.int64)
            out.append(flat.windows(few, whole, len(few))[0] ^ _U64(len(few)) if len(few) else few)
    return out


def _class_of(grams: np.ndarray) -> int:
    """One number for a set: equal sets, and in effect only those, share it."""
    salted = flat.mix(grams ^ _U64(0xA5A5A5A5A5A5A5A5))
    both = np.array([grams.sum(dtype=_U64) ^ _U64(len(grams)), np.bitwise_xor.reduce(salted)])
    return int(flat.mix(both[:1] + flat.mix(both[1:])).view(np.int64)[0])


def _signature(grams: np.ndarray) -> np.ndarray:
    """Parity bits, about one per n-gram, as 64-bit words; halves can be folded by XOR."""
    words = 1 << max(0, int(len(grams) - 1).bit_length() - 6)
    bits = np.zeros(words * 64, np.uint8)
    places, times = np.unique(grams & _U64(words * 64 - 1), return_counts=True)
    bits[places.astype(np.int64)] = times & 1
    return np.packbits(bits, bitorder="little").view(np.int64)


def _folded(signature: np.ndarray, words: int = 4) -> np.ndarray:
    """A signature folded to at most ``words`` words."""
    if len(signature) <= words:
        return signature
    return np.bitwise_xor.reduce(signature.reshape(-1, words), axis=0)


class _Once:
    """Which classes this task has passed on; forgets all when it is full."""

    def __init__(self):
        self.seen: set[int] = set()

    def new(self, cls: int) -> bool:
        if cls in self.seen:
            return False
        if len(self.seen) >= SEEN:
            self.seen.clear()
        self.seen.add(cls)
        return True


def _arrays(values: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(values) + 1, np.int32)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    # one dtype: mixed signed and unsigned arrays would become floats
    joined = np.concatenate([v.view(np.int64) for v in values]) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(joined))


def _batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[f.name] for f in schema], schema=schema)


_DIGEST_ARROW = pa.schema(
    [("part", pa.int32()), ("doc_id", pa.int64()), ("cls", pa.int64()), ("size", pa.int64())]
    + [("sig", pa.list_(pa.int64())), ("brief", pa.list_(pa.int64())), ("counts", pa.binary())]
)
_POSTING_ARROW = pa.schema(
    [("gram", pa.int64()), ("salt", pa.int32())] + [(c, pa.int64()) for c in ("cls", "size", "pos")]
)
_SET_ARROW = pa.schema([("cls", pa.int64()), ("grams", pa.list_(pa.int64()))])


# --- a sketch of counters, made by tasks and added up by parts -----------------


def _sketch_rows(counts: np.ndarray):
    """Lists of up to 16 parts that are not all zero, each in the narrowest type that holds it."""
    width = len(counts) // PARTS
    rows = []
    for i in range(PARTS):
        piece = counts[i * width : (i + 1) * width]
        if top := piece.max():
            rows.append((i, piece.astype(np.min_scalar_type(top)).tobytes()))
            if len(rows) == 16:
                yield rows
                rows = []
    if rows:
        yield rows


def _add_up(bits: int):
    """Sums the sketches of a partition's parts; memory is at most one whole sketch."""
    width = (1 << bits) // PARTS

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = counts.as_buffer()
                piece = np.frombuffer(data, f"u{len(data) // width}").astype(np.uint64)
                sums[part] = sums[part] + piece if part in sums else piece
        for part, total in sums.items():
            level = np.minimum(8 * np.log2(1.0 + total), 255).astype(np.uint8).tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([level], pa.binary())], ["part", "counts"]
            )

    return run


def _levels(parts: DataFrame, bits: int) -> np.ndarray:
    """The added-up sketch, each counter as 8 * log2(1 + count) in a byte: 2 ** bits bytes in all."""
    summed = parts.select("part", "counts").repartition("part").mapInArrow(_add_up(bits), "part int, counts binary")
    width = (1 << bits) // PARTS
    out = np.zeros(1 << bits, np.uint8)
    for row in summed.collect():
        out[row.part * width : (row.part + 1) * width] = np.frombuffer(row.counts, np.uint8)
    return out


# --- passes over the texts ----------------------------------------------------


def _texts(batches):
    for batch in batches:
        yield from flat.slices(batch, "text")


def _digest(k: int, bits: int):
    def run(batches):
        counts, once = np.zeros(1 << bits, np.uint32), _Once()
        for batch in _texts(batches):
            sets = gram_sets(batch.column(1), k)
            classes = [_class_of(g) if len(g) else 0 for g in sets]
            new = [g for g, c in zip(sets, classes) if len(g) and once.new(c)]
            if new:
                places = (np.concatenate(new) >> _U64(64 - bits)).astype(np.int64)
                np.add.at(counts, places, np.uint32(1))
            n = len(sets)
            signatures = [_signature(g) if len(g) else g for g in sets]
            yield _batch(
                {
                    "part": pa.array([-1] * n, pa.int32()),
                    "doc_id": batch.column(0),
                    "cls": pa.array(classes, pa.int64()),
                    "size": pa.array([len(g) for g in sets], pa.int64()),
                    "sig": _arrays(signatures),
                    "brief": _arrays([_folded(x) for x in signatures]),
                    "counts": pa.nulls(n, pa.binary()),
                },
                _DIGEST_ARROW,
            )
        for rows in _sketch_rows(counts):
            n = len(rows)
            empty = pa.nulls(n, pa.int64())
            yield _batch(
                {
                    "part": pa.array([i for i, _ in rows], pa.int32()),
                    "doc_id": empty,
                    "cls": empty,
                    "size": empty,
                    "sig": pa.nulls(n, pa.list_(pa.int64())),
                    "brief": pa.nulls(n, pa.list_(pa.int64())),
                    "counts": pa.array([b for _, b in rows], pa.binary()),
                },
                _DIGEST_ARROW,
            )

    return run


def _postings(k: int, bits: int, levels, num: int, den: int):
    def run(batches):
        once, level = _Once(), levels.value
        hot = max(HOT, 50 * float(np.exp2(level / 8.0).mean()))
        for batch in _texts(batches):
            grams, salts, classes, sizes, places = [], [], [], [], []
            for g in gram_sets(batch.column(1), k):
                n = len(g)
                if not n or not once.new(cls := _class_of(g)):
                    continue
                common = level[(g >> _U64(64 - bits)).astype(np.int64)]
                order = np.argsort((common.astype(_U64) << _U64(56)) | (g >> _U64(8)), kind="stable")
                prefix = order[: n - -(-num * n // den) + 1]
                about = np.exp2(common[prefix] / 8.0)
                salt = np.where(about >= hot, 1 + abs(cls) % np.maximum(1, about // (hot / 2)), 0)
                grams.append(g[prefix])
                salts.append(salt.astype(np.int32))
                classes.append(np.full(len(prefix), cls, np.int64))
                sizes.append(np.full(len(prefix), n, np.int64))
                places.append(np.arange(len(prefix), dtype=np.int64))
            if grams:
                yield _batch(
                    {
                        "gram": pa.array(np.concatenate(grams).view(np.int64)),
                        "salt": pa.array(np.concatenate(salts)),
                        "cls": pa.array(np.concatenate(classes)),
                        "size": pa.array(np.concatenate(sizes)),
                        "pos": pa.array(np.concatenate(places)),
                    },
                    _POSTING_ARROW,
                )

    return run


def _wanted_sets(k: int, bits: int, wanted):
    def run(batches):
        once, marks = _Once(), wanted.value
        for batch in _texts(batches):
            classes, sets = [], []
            for g in gram_sets(batch.column(1), k):
                if not len(g):
                    continue
                cls = _class_of(g)
                if marks[_mark(np.array([cls]), bits)[0]] and once.new(cls):
                    classes.append(cls)
                    sets.append(g)
            if classes:
                yield _batch({"cls": pa.array(classes, pa.int64()), "grams": _arrays(sets)}, _SET_ARROW)

    return run


def _mark(classes: np.ndarray, bits: int) -> np.ndarray:
    return (flat.mix(classes.view(np.uint64)) >> _U64(64 - bits)).astype(np.int64)


def _marks(bits: int):
    def run(batches):
        counts = np.zeros(1 << bits, np.uint8)
        for batch in batches:
            counts[_mark(batch.column(0).to_numpy(zero_copy_only=False), bits)] = 1
        for rows in _sketch_rows(counts):
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in rows], pa.int32()), pa.array([b for _, b in rows], pa.binary())],
                ["part", "counts"],
            )

    return run


# --- filters --------------------------------------------------------------------


def _sided(num: int, den: int):
    """Filters on a pair of prefix entries, as SQL over x and y with x the smaller set.

    A pair is similar when shared / union >= num / den, that is when
    (num + den) * shared >= num * (x.size + y.size).
    """
    need = f"CAST(ceil({num} * (x.size + y.size) / {num + den}) AS BIGINT)"
    order = "(x.size < y.size OR x.size = y.size AND x.cls < y.cls)"
    length = f"{den} * x.size >= {num} * y.size"
    prefix = f"x.pos <= x.size - CAST(ceil({2 * num} * x.size / {num + den}) AS BIGINT)"
    positional = f"least(x.size - x.pos, y.size - y.pos) >= {need}"
    return " AND ".join((order, length, prefix, positional))


def _suffix(num: int, den: int) -> str:
    """The signatures of x and y differ in no more bits than similar sets can.

    The wider signature (at most twice as wide, or cut down to the same width) is folded first. With equal parity bits a
    common n-gram cancels out, so differing bits are a lower bound of differing n-grams.
    """
    fold = "zip_with(slice({0}.sig, 1, size({0}.sig) div 2), slice({0}.sig, size({0}.sig) div 2 + 1, size({0}.sig) div 2), (p, q) -> p ^ q)"
    x = f"CASE WHEN size(x.sig) > size(y.sig) THEN {fold.format('x')} ELSE x.sig END"
    y = f"CASE WHEN size(y.sig) > size(x.sig) THEN {fold.format('y')} ELSE y.sig END"
    bits = f"aggregate(zip_with({x}, {y}, (p, q) -> bit_count(p ^ q)), 0, (n, m) -> n + m)"
    return f"{bits} <= x.size + y.size - 2 * CAST(ceil({num} * (x.size + y.size) / {num + den}) AS BIGINT)"


def _verify(texts: DataFrame, pairs: DataFrame, k: int, bits: int, num: int, den: int) -> DataFrame:
    """Those pairs (a, b) of classes that are similar; each pair is counted once, exactly."""
    spark = texts.sparkSession
    ends = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    wanted = _levels(ends.mapInArrow(_marks(bits), "part int, counts binary"), bits)
    wanted = spark.sparkContext.broadcast(wanted > 0)
    sets = texts.mapInArrow(_wanted_sets(k, bits, wanted), _SET).groupBy("cls").agg(F.first("grams").alias("g"))
    x = sets.select(F.col("cls").alias("a"), F.col("g").alias("ga"))
    y = sets.select(F.col("cls").alias("b"), F.col("g").alias("gb"))
    shared = F.size(F.array_intersect("ga", "gb"))
    similar = (num + den) * shared >= num * (F.size("ga") + F.size("gb"))
    return pairs.join(x, "a").join(y, "b").filter(similar).select("a", "b")


# --- the operator -----------------------------------------------------------------


def similar_groups(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = 5,
    num: int = 3,
    den: int = 4,
    sketch_bits: int = SKETCH_BITS,
) -> DataFrame:
    """``doc_id, n_shingles, component_id``: one row per row of ``df``.

    A text is lower-cased (A-Z) and cut at ASCII white space; its set holds the distinct
    runs of ``words`` words, or the whole sequence if it is shorter. Rows with
    ``shared / union >= num / den`` are linked; ``component_id`` is the smallest id that links
    reach. NULL or wordless texts have an empty set and are linked with nothing, so their
    component is their own id. Repeated rows are copies of each other. A NULL id stays NULL
    and takes no part in the smallest id. An empty table gives an empty result; other
    columns of ``df`` are not read.
    """
    python_ready(df.sparkSession)
    sc = df.sparkSession.sparkContext
    texts = df.select(quoted(doc_id).cast("long").alias("doc_id"), quoted(text).alias("text"))
    digest = durable(texts.mapInArrow(_digest(words, sketch_bits), _DIGEST))
    levels = sc.broadcast(_levels(digest.filter("part >= 0"), sketch_bits))
    rows = digest.filter("part < 0")
    found = texts.mapInArrow(_postings(words, sketch_bits, levels, num, den), _POSTING)
    found = durable(_repeated(found))
    classes = rows.filter("size > 0").groupBy("cls")
    classes = classes.agg(F.min("doc_id").alias("least"), F.first("sig").alias("sig"), F.first("brief").alias("brief"))
    classes = durable(classes)
    signatures = classes.select("cls", "sig", "brief")
    filters, suffix = _sided(num, den), _suffix(num, den)

    first = durable(_leader_pairs(found, signatures, filters, suffix))
    links = durable(_verify(texts, first, words, sketch_bits, num, den))
    roots = components(links)
    rest = durable(_rest_pairs(found, signatures, roots, first, filters, suffix))
    if not rest.isEmpty():
        more = _verify(texts, rest, words, sketch_bits, num, den)
        roots = components(links.unionByName(more))
    least = classes.join(roots, F.col("cls") == F.col("node"), "left")
    least = least.select("cls", F.coalesce("root", "cls").alias("root"), "least")
    smallest = least.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = least.join(smallest, "root").select(F.col("cls").alias("node"), "component_id")
    joined = rows.join(of_class, (F.col("cls") == F.col("node")) & (F.col("size") > 0), "left")
    return joined.select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def keep_first(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **params) -> DataFrame:
    """One row of each group of :func:`similar_groups`, with the columns of ``df``.

    Rows are told apart by id and text together, so rows that share an id are judged by their
    own texts. The row with the smallest id stays; among equal ids that of the smallest
    hash of id and text, and a row without an id only if none in its group has one. Of rows
    with the same id and text one stays, whatever their other columns. Texts without a word
    are linked with nothing, so all of them stay, repeated rows too. An empty table gives an
    empty result.
    """
    key = own("row_key", df.columns)
    keyed = df.withColumn(key, F.xxhash64(quoted(doc_id), quoted(text)))
    groups = similar_groups(keyed, key, text, **params).groupBy(F.col("doc_id").alias("k"))
    groups = groups.agg(F.max("n_shingles").alias("size"), F.min("component_id").alias("component"))
    rows = keyed.groupBy(F.col(key).alias("r")).agg(
        F.min(quoted(doc_id)).alias("id"), F.count(F.lit(1)).alias("times")
    )
    judged = durable(groups.join(rows, F.col("k") == F.col("r")).drop("r"))
    order = F.struct(F.col("id").isNull().alias("unnamed"), "id", "k", "times")
    leaders = judged.filter("size > 0").groupBy("component").agg(F.min(order).alias("first"))
    leaders = leaders.select(F.col("first.k").alias("k"), F.col("first.times").alias("times"))
    wordless = judged.filter("size = 0").select("k", F.lit(1).cast("long").alias("times"))
    kept_key, times = own("kept_key", [*df.columns, key]), own("times", [*df.columns, key])
    verdict = leaders.unionByName(wordless).toDF(kept_key, times)
    kept = keyed.join(verdict, F.col(key) == F.col(kept_key))
    columns = [quoted(c) for c in df.columns]
    again = kept.filter(F.col(times) > 1).dropDuplicates([key])
    return kept.filter(F.col(times) == 1).select(columns).unionByName(again.select(columns))


def _with_signatures(pairs: DataFrame, signatures: DataFrame, suffix: str) -> DataFrame:
    x = signatures.select(F.col("cls").alias("a"), F.col("sig").alias("sa"))
    y = signatures.select(F.col("cls").alias("b"), F.col("sig").alias("sb"))
    joined = pairs.join(x, "a").join(y, "b").select(
        F.struct(F.col("a").alias("cls"), F.col("sa").alias("sig"), F.col("size_a").alias("size")).alias("x"),
        F.struct(F.col("b").alias("cls"), F.col("sb").alias("sig"), F.col("size_b").alias("size")).alias("y"),
    )
    return joined.filter(suffix).select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b"))


def _repeated(found: DataFrame) -> DataFrame:
    """Prefix entries of n-grams that several classes have, with the n-gram's leader ``top``.

    Equal entries (of copies that different tasks met) become one. The entries of a frequent
    n-gram are spread over several groups; all of them stay, and their leader is an aggregate.
    """
    key = Window.partitionBy("gram", "salt")
    entry = F.struct("pos", "size", "cls")
    found = (
        found.withColumn("before", F.lag("cls").over(key.orderBy("cls")))
        .withColumn("top", F.min(entry).over(key))
        .withColumn("high", F.max("cls").over(key))
        .withColumn("low", F.min("cls").over(key))
        .filter("(before IS NULL OR before <> cls) AND (low <> high OR salt > 0)")
        .select("gram", "salt", "cls", "size", "pos", "top")
    )
    return found


def _leader_pairs(found, signatures, filters: str, suffix: str) -> DataFrame:
    """Each class with the leader of each of its prefix n-grams, smaller set first."""
    spread = found.filter("salt > 0").drop("top")
    leaders = spread.groupBy("gram").agg(F.min(F.struct("pos", "size", "cls")).alias("top"))
    both = found.filter("salt = 0").unionByName(spread.join(leaders, "gram")).filter("cls <> top.cls")
    one = F.struct("cls", "size", "pos")
    two = F.struct("top.cls", "top.size", "top.pos")
    ahead = F.expr("size < top.size OR size = top.size AND cls < top.cls")
    sided = both.select(F.when(ahead, one).otherwise(two).alias("x"), F.when(ahead, two).otherwise(one).alias("y"))
    pairs = sided.filter(filters).select(
        F.col("x.cls").alias("a"), F.col("y.cls").alias("b"), F.col("x.size").alias("size_a"), F.col("y.size").alias("size_b")
    )
    return _with_signatures(pairs.distinct(), signatures, suffix)


def _rest_pairs(found, signatures, roots, done, filters: str, suffix: str) -> DataFrame:
    """Pairs of different components that share a prefix n-gram and pass all filters.

    N-grams whose entries are all of one component drop out before anything is paired.
    """
    named = found.drop("top").join(roots.withColumnRenamed("node", "cls"), "cls", "left")
    named = named.withColumn("root", F.coalesce("root", "cls"))
    key = Window.partitionBy("gram", "salt")
    named = named.withColumn("r0", F.min("root").over(key)).withColumn("r1", F.max("root").over(key))
    named = named.filter("r0 <> r1 OR salt > 0").drop("r0", "r1", "salt")
    named = durable(named.join(signatures.select("cls", F.col("brief").alias("sig")), "cls"))
    on = f"x.gram = y.gram AND x.root <> y.root AND {filters} AND {suffix}"
    pairs = named.alias("x").join(named.alias("y"), F.expr(on)).select(
        F.col("x.cls").alias("a"), F.col("y.cls").alias("b"), F.col("x.size").alias("size_a"), F.col("y.size").alias("size_b")
    )
    pairs = pairs.distinct().join(done, ["a", "b"], "left_anti")
    return _with_signatures(pairs, signatures, suffix)
