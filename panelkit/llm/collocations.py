"""Collocations from a weighted de Bruijn graph of word trigrams.

A node is a bigram, an edge a trigram that leads from its first to its last two words, its
weight the number of its occurrences. Only edges are counted in the texts. A piece's end counts
as an edge to nowhere, so that what flows out of a node is the bigram's count, and what flows
out of all nodes that begin with a word is that word's count. Edges lighter than the least count
of a candidate are added up into their node's flow as soon as their weight is known. Nodes that
all the flow enters by one edge and leaves by one edge are compacted into paths: an inner node of
a path always gives way to the longer phrases around it.

Edges meet by a hash of the whole edge, then flows by a hash of the node, so no frequent node or
word is gathered anywhere. Most edges are rare, and there are nearly as many as words. They travel
in compressed blocks, one per slice of text and bucket, sorted, and a task adds up one bucket at
a time; the number of buckets grows with the bytes of text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm import flat
from panelkit.llm.common import durable, python_ready, quoted
from panelkit.operators.ranks import ranked

MIN_COUNT = 10  # least count of a candidate
TOP = 2_000  # phrases reported per language
SHARE = 50  # percent of a candidate's count from which a longer one replaces it
_SALTS = 8  # the rows of a frequent node or word are dealt out to so many keys
_SLICE = 4 << 20  # bytes of text whose edges a task adds up at a time, and per bucket on average
_ROWS = 200_000  # rows of a batch

_BLOCKS = "bucket bigint, lang string, grams binary, weights binary"
_FOUND = "kind int, lang string, node string, next string, weight bigint, other bigint"
_NODE, _EDGE, _WORD = 0, 1, 2

_PIECE = np.zeros(256, bool)
_PIECE[[*map(ord, ".,;:!?"), *range(0x0A, 0x0E)]] = True
_GAP = _PIECE.copy()
_GAP[[0x20, 0x09]] = True


@dataclass(frozen=True)
class Graph:
    """The graph of each language; counts below the least count are left out.

    ``edges``: ``lang, node, next, a, before``, the trigram ``node next``, its count and that of ``node``. ``nodes``: ``lang, node,
    f, unary, top`` and ``path_words``: the bigram's count, whether it lies inside a path, the count of
    the most frequent trigram that contains it, and the words of its path. ``paths``:
    ``lang, node, root, place``: the place of each inner node in its path, from 0, and the path's first
    inner node. ``words``: ``lang, word, f``. ``totals``: ``lang, n``, all words.
    """

    edges: DataFrame
    nodes: DataFrame
    paths: DataFrame
    words: DataFrame
    totals: DataFrame


def partial_edges(langs: pa.Array, texts: pa.Array) -> tuple[list, np.ndarray, pa.Array, np.ndarray]:
    """Languages, and for each distinct edge its language's number, its words and its weight.

    A gram of two words is the end of a piece behind them, one word the last of a piece. The
    grams of a language are sorted.
    """
    data, offsets = flat.flatten(texts)
    data = flat.LOWER[data]
    starts, ends, docs = flat.spans(data, offsets, _GAP)
    if not len(starts):
        return [], np.zeros(0, np.int64), pa.array([], pa.large_string()), np.zeros(0, np.int64)
    piece = flat.counts_between(_PIECE[data], starts)
    joined = np.zeros(len(starts) + 1, bool)  # with the next word
    joined[:-2] = (docs[1:] == docs[:-1]) & (piece[1:] == piece[:-1])

    places = np.concatenate([[0], np.cumsum(ends - starts)])
    solid = np.ascontiguousarray(data[~_GAP[data]])
    every = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(solid))
    coded = every.dictionary_encode()
    order = pc.array_sort_indices(coded.dictionary)
    names = coded.dictionary.take(order)
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    word, size = rank[coded.indices.to_numpy()], len(names)
    lang = langs.dictionary_encode()
    first = lang.indices.to_numpy()[docs].astype(np.int64) * size + word  # with its language

    pairs = np.flatnonzero(joined)
    nodes, of_pair = np.unique(first[pairs] * size + word[pairs + 1], return_inverse=True)
    goes_on = joined[pairs + 1]
    edges, weight = np.unique(of_pair[goes_on] * size + word[pairs[goes_on] + 2], return_counts=True)
    stops = np.bincount(of_pair[~goes_on], minlength=len(nodes))
    stopped = np.flatnonzero(stops)
    alone, alone_weight = np.unique(first[~joined[:-1]], return_counts=True)

    node_first = nodes // size
    node_names = _joined(names.take(pa.array(node_first % size)), names.take(pa.array(nodes % size)))
    edge_node = edges // size
    grams = [
        _joined(node_names.take(pa.array(edge_node)), names.take(pa.array(edges % size))),
        node_names.take(pa.array(stopped)),
        names.take(pa.array(alone % size)),
    ]
    own = np.concatenate([(node_first // size)[edge_node], (node_first // size)[stopped], alone // size])
    whole = pa.chunked_array(grams, pa.large_string()).combine_chunks()
    return lang.dictionary.to_pylist(), own, whole, np.concatenate([weight, stops[stopped], alone_weight])


def _joined(a: pa.Array, b: pa.Array) -> pa.Array:
    return pc.binary_join_element_wise(a, b, pa.scalar(" ", pa.large_string()))


def _blocks(langs: list, own: np.ndarray, grams: pa.Array, weights: np.ndarray, bucket: np.ndarray):
    """A row per language and bucket: its grams, a line each, and their weights, both compressed."""
    if not len(grams):
        return
    span = int(bucket.max()) + 1
    key = own * span + bucket
    order = np.argsort(key, kind="stable")
    key, packer = key[order], zstandard.ZstdCompressor(level=3)
    lines = pc.binary_join_element_wise(
        grams.take(pa.array(order)), pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string())
    )
    data, at = flat.flatten(lines)
    weights = weights[order].astype(np.int64)
    heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    rows = []
    for low, high in zip(heads.tolist(), np.append(heads[1:], len(key)).tolist()):
        lang, number = divmod(int(key[low]), span)
        text = packer.compress(data[at[low] : at[high]].tobytes())
        rows.append((number, langs[lang], text, packer.compress(weights[low:high].tobytes())))
    kinds = [pa.int64(), pa.string(), pa.binary(), pa.binary()]
    for low in range(0, len(rows), 1_000):
        columns = [pa.array(c, kind) for c, kind in zip(zip(*rows[low : low + 1_000]), kinds)]
        yield pa.RecordBatch.from_arrays(columns, ["bucket", "lang", "grams", "weights"])


def _buckets(batches):
    """``lang, grams, weights`` of each bucket and language, added up; blocks come sorted by bucket."""
    unpacker = zstandard.ZstdDecompressor()
    key, held = None, []
    for batch in batches:
        columns = [batch.column(i) for i in range(4)]
        for i in range(batch.num_rows):
            now = (columns[0][i].as_py(), columns[1][i].as_py())
            if now != key and held:
                yield key[1], *_added(held)
                held = []
            key = now
            block = [unpacker.decompress(memoryview(columns[c][i].as_buffer())) for c in (2, 3)]
            held.append((block[0], np.frombuffer(block[1], np.int64)))
    if held:
        yield key[1], *_added(held)
    flat.give_back()


def _added(blocks: list[tuple[bytes, np.ndarray]]) -> tuple[pa.Array, np.ndarray]:
    data = np.frombuffer(b"".join(text for text, _ in blocks), np.uint8)
    ends = np.flatnonzero(data == 10)
    places = np.concatenate([[0], ends + 1 - np.arange(1, len(ends) + 1)])  # line ends are left out
    solid = np.ascontiguousarray(data[data != 10])
    grams = pa.LargeStringArray.from_buffers(len(ends), pa.py_buffer(places), pa.py_buffer(solid))
    coded = grams.dictionary_encode()
    total = np.zeros(len(coded.dictionary), np.int64)
    np.add.at(total, coded.indices.to_numpy(), np.concatenate([w for _, w in blocks]))
    return coded.dictionary, total


def _parts(grams: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """The node and the next word of each gram, and the number of its words.

    The node of a gram of one or two words is the gram, and no word is next.
    """
    data, offsets = flat.flatten(grams)
    gaps = np.flatnonzero(data == 0x20)
    upto = np.searchsorted(gaps, offsets)
    words = np.diff(upto) + 1
    cut = offsets[1:].copy()
    three = np.flatnonzero(words == 3)
    cut[three] = gaps[upto[1:][three] - 1]
    after = np.minimum(cut + 1, offsets[1:])
    return _cut(data, offsets[:-1], cut), _cut(data, after, offsets[1:]), words


def _cut(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    size = ends - starts
    places = np.concatenate([[0], np.cumsum(size)])
    where = np.arange(places[-1]) - np.repeat(places[:-1] - starts, size)
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(places), pa.py_buffer(data[where]))


def _hash(grams: pa.Array, buckets: int) -> np.ndarray:
    data, offsets = flat.flatten(grams)
    return (flat.hash_spans(data, offsets[:-1], offsets[1:]) % np.uint64(buckets)).astype(np.int64)


def _slices_to_edges(buckets: int):
    def run(batches):
        for batch in batches:
            for piece in flat.slices(batch, "text", _SLICE):
                langs, own, grams, weights = partial_edges(piece.column(0), piece.column(1))
                yield from _blocks(langs, own, grams, weights, _hash(grams, buckets))

    return run


def _edges_to_nodes(buckets: int, least: int):
    """Heavy edges stay grams of three words; all others become part of their node's flow."""

    def run(batches):
        for lang, grams, weights in _buckets(batches):
            node, _, words = _parts(grams)
            heavy = (words == 3) & (weights >= least)
            kept = pa.array(np.flatnonzero(heavy))
            coded = node.filter(pa.array(~heavy)).dictionary_encode()
            flow = np.bincount(coded.indices.to_numpy(), weights=weights[~heavy], minlength=len(coded.dictionary))
            whole = pa.chunked_array([grams.take(kept), coded.dictionary], pa.large_string()).combine_chunks()
            total = np.concatenate([weights[heavy], flow.astype(np.int64)])
            bucket = np.concatenate([_hash(node.take(kept), buckets), _hash(coded.dictionary, buckets)])
            yield from _blocks([lang], np.zeros(len(total), np.int64), whole, total, bucket)

    return run


def _nodes_to_rows(least: int):
    """Heavy nodes and edges, and what the bucket's nodes add to the counts of their first words."""

    def run(batches):
        for lang, grams, weights in _buckets(batches):
            node, after, words = _parts(grams)
            coded = node.dictionary_encode()
            code, names = coded.indices.to_numpy(), coded.dictionary
            flow = np.bincount(code, weights=weights, minlength=len(names)).astype(np.int64)
            edge = np.flatnonzero(words == 3)
            out = np.zeros(len(names), np.int64)
            np.maximum.at(out, code[edge], weights[edge])
            data, offsets = flat.flatten(names)
            gaps = np.flatnonzero(data == 0x20)
            upto = np.searchsorted(gaps, offsets)
            pair = np.diff(upto) > 0
            head = offsets[1:].copy()
            head[pair] = gaps[upto[:-1][pair]]
            first = _cut(data, offsets[:-1], head).dictionary_encode()
            count = np.bincount(first.indices.to_numpy(), weights=flow, minlength=len(first.dictionary))
            heavy = np.flatnonzero(pair & (flow >= least))
            yield from _rows(_NODE, lang, names.take(pa.array(heavy)), None, flow[heavy], out[heavy])
            yield from _rows(
                _EDGE, lang, node.take(pa.array(edge)), after.take(pa.array(edge)), weights[edge], flow[code[edge]]
            )
            yield from _rows(_WORD, lang, first.dictionary, None, count.astype(np.int64), None)

    return run


def _rows(kind: int, lang: str, node: pa.Array, after: pa.Array | None, weight: np.ndarray, other):
    n = len(node)
    columns = [
        pa.array(np.full(n, kind, np.int32)),
        pa.repeat(pa.scalar(lang, pa.string()), n),
        node.cast(pa.string()),
        pa.nulls(n, pa.string()) if after is None else after.cast(pa.string()),
        pa.array(weight),
        pa.nulls(n, pa.int64()) if other is None else pa.array(other),
    ]
    whole = pa.RecordBatch.from_arrays(columns, ["kind", "lang", "node", "next", "weight", "other"])
    for at in range(0, n, _ROWS):
        yield whole.slice(at, _ROWS)


def graph(df: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT) -> Graph:
    """The compacted graph of all texts; writes its tables once to the shared folder.

    A NULL text is empty, a NULL language is ``und``.
    """
    spark = df.sparkSession
    python_ready(spark)
    slim = df.select(F.coalesce(quoted(lang), F.lit("und")).alias("lang"), quoted(text).alias("text"))
    size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // _SLICE))  # a bucket holds about as much as a slice of text
    parts = min(buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def dealt(blocks: DataFrame) -> DataFrame:
        even = blocks.repartitionById(parts, (F.col("bucket") % parts).cast("int"))
        return even.sortWithinPartitions("bucket", "lang")

    edges = dealt(slim.mapInArrow(_slices_to_edges(buckets), _BLOCKS))
    nodes = dealt(edges.mapInArrow(_edges_to_nodes(buckets, min_count), _BLOCKS))
    found = durable(nodes.mapInArrow(_nodes_to_rows(min_count), _FOUND))

    first = found.filter(F.col("kind") == _WORD)
    totals = first.groupBy("lang").agg(F.sum("weight").alias("n"))
    words = first.groupBy("lang", F.col("node").alias("word")).agg(F.sum("weight").alias("f"))
    words = words.filter(F.col("f") >= min_count)
    edges = found.filter(F.col("kind") == _EDGE)
    edges = edges.select("lang", "node", "next", F.col("weight").alias("a"), F.col("other").alias("before"))
    nodes = found.filter(F.col("kind") == _NODE)
    nodes = nodes.select("lang", "node", F.col("weight").alias("f"), F.nullif("other", F.lit(0)).alias("out"))
    entered = edges.groupBy(F.col("lang").alias("in_lang"), _suffix().alias("in_node")).agg(F.max("a").alias("into"))
    joined = nodes.join(entered, (F.col("lang") == F.col("in_lang")) & (F.col("node") == F.col("in_node")), "left")
    unary = (F.col("into") == F.col("f")) & (F.col("out") == F.col("f"))
    nodes = durable(
        joined.select("lang", "node", "f", F.coalesce(unary, F.lit(False)).alias("unary"), F.greatest("into", "out").alias("top"))
    )
    paths = _compacted(nodes.filter("unary"), edges)
    sizes = paths.groupBy("lang", "root").agg((F.count(F.lit(1)) + 3).alias("path_words"))
    sized = paths.join(sizes, ["lang", "root"]).select(
        F.col("lang").alias("path_lang"), F.col("node").alias("path_node"), "path_words"
    )
    same = (F.col("lang") == F.col("path_lang")) & (F.col("node") == F.col("path_node"))
    nodes = durable(nodes.join(sized, same, "left").drop("path_lang", "path_node"))
    return Graph(edges, nodes, paths, durable(words), totals)


def _suffix() -> F.Column:
    """The node to which an edge leads."""
    return F.concat_ws(" ", F.substring_index("node", " ", -1), "next")


def _compacted(inner: DataFrame, edges: DataFrame) -> DataFrame:
    """``lang, node, root, place`` of the inner nodes of paths.

    Every node points to the inner node before it, the first of a path to itself; pointers
    are then followed to double length until they all end at a first node. A path lies within
    a piece, so the number of rounds is the logarithm of the longest piece at most.
    """
    into = edges.select(F.col("lang").alias("l"), _suffix().alias("to"), F.col("node").alias("before"), "a")
    one = (F.col("lang") == F.col("l")) & (F.col("node") == F.col("to")) & (F.col("f") == F.col("a"))
    inner = inner.select("lang", "node", "f")
    linked = inner.join(into, one).select("lang", "node", "before")
    also = inner.select(F.col("lang").alias("l"), F.col("node").alias("b"), F.lit(1).alias("found"))
    linked = linked.join(also, (F.col("lang") == F.col("l")) & (F.col("before") == F.col("b")), "left")
    inside = F.col("found").isNotNull()
    now = durable(
        linked.select(
            "lang",
            "node",
            F.when(inside, F.col("before")).otherwise(F.col("node")).alias("root"),
            inside.cast("int").alias("place"),
        )
    )
    while True:
        ahead = now.select(
            F.col("lang").alias("l"), F.col("node").alias("at"), F.col("root").alias("far"), F.col("place").alias("more")
        )
        moved = now.filter("place > 0").join(ahead, (F.col("lang") == F.col("l")) & (F.col("root") == F.col("at")))
        moved = moved.select("lang", "node", F.col("far").alias("root"), (F.col("place") + F.col("more")).alias("place"), "more")
        moved = durable(moved)
        if moved.filter("more > 0").isEmpty():
            return now
        now = durable(now.filter("place = 0").unionByName(moved.drop("more")))


def path_texts(found: Graph) -> DataFrame:
    """``lang, phrase, a, words``: each compacted path of four words or more, and its count.

    A path is not longer than the longest piece.
    """
    inner = found.paths.join(found.nodes.select("lang", "node", "f"), ["lang", "node"])
    last = F.substring_index("node", " ", -1)
    gathered = inner.groupBy("lang", "root").agg(
        F.array_sort(F.collect_list(F.struct("place", last.alias("w")))).alias("inner"),
        F.max("f").alias("a"),
        F.max_by("node", "place").alias("tail"),
    )
    into = found.edges.select(
        F.col("lang").alias("l"), _suffix().alias("to"), F.substring_index("node", " ", 1).alias("head"), F.col("a").alias("x")
    )
    out = found.edges.select(F.col("lang").alias("m"), F.col("node").alias("from"), "next", F.col("a").alias("y"))
    whole = gathered.join(into, (F.col("lang") == F.col("l")) & (F.col("root") == F.col("to")) & (F.col("a") == F.col("x")))
    whole = whole.join(out, (F.col("lang") == F.col("m")) & (F.col("tail") == F.col("from")) & (F.col("a") == F.col("y")))
    phrase = F.concat_ws(
        " ", "head", F.substring_index("root", " ", 1), F.transform("inner", lambda x: x["w"]), "next"
    )
    return whole.select("lang", phrase.alias("phrase"), "a", (F.size("inner") + 3).cast("long").alias("words"))


def _with(df: DataFrame, values: DataFrame, key: F.Column, **names: str) -> DataFrame:
    """Columns of ``values`` (``lang, key, ...``) for the rows of ``df``, which have a ``salt``.

    A key with very many rows is dealt out: the other side stands under each salt.
    """
    salts = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)))
    other = values.select(
        F.col("lang").alias("__lang"),
        F.col("key").alias("__key"),
        salts.alias("__salt"),
        *[F.col(c).alias(new) for c, new in names.items()],
    )
    same = (F.col("lang") == F.col("__lang")) & (key == F.col("__key")) & (F.col("salt") == F.col("__salt"))
    return df.join(other, same).drop("__lang", "__key", "__salt")


def candidates(found: Graph, share: int = SHARE) -> DataFrame:
    """``lang, phrase, a, l, r, score, path_words``: candidates that no longer one replaces."""
    nodes, words = found.nodes.withColumnRenamed("node", "key"), found.words.withColumnRenamed("word", "key")
    salt = F.pmod(F.xxhash64("phrase"), F.lit(_SALTS)).cast("int").alias("salt")
    head, tail = F.substring_index("phrase", " ", 1), F.substring_index("phrase", " ", -1)

    three = found.edges.select("lang", "node", F.concat_ws(" ", "node", "next").alias("phrase"), "a", "before", _suffix().alias("after"))
    three = three.select("*", salt)
    three = _with(three, nodes, F.col("node"), path_words="path_before")
    three = _with(three, nodes, F.col("after"), f="f_after", path_words="path_after")
    three = _with(_with(three, words, head, f="f_head"), words, tail, f="f_tail")
    three = three.withColumn("score_1", _score("f_head", "f_after")).withColumn("score_2", _score("before", "f_tail"))
    early = F.col("score_1") <= F.col("score_2")
    three = three.select(
        "lang",
        "phrase",
        "a",
        F.when(early, F.col("f_head")).otherwise(F.col("before")).alias("l"),
        F.when(early, F.col("f_after")).otherwise(F.col("f_tail")).alias("r"),
        F.least("score_1", "score_2").alias("score"),
        F.coalesce("path_after", "path_before", F.lit(3)).cast("long").alias("path_words"),
    )

    stays = F.coalesce(100 * F.col("top") < share * F.col("f"), F.lit(True))
    two = found.nodes.filter(~F.col("unary") & stays).select("lang", F.col("node").alias("phrase"), F.col("f").alias("a"))
    two = two.select("*", salt)
    two = _with(_with(two, words, head, f="l"), words, tail, f="r")
    two = two.withColumn("score", _score("l", "r"))
    return three.unionByName(two.select("lang", "phrase", "a", "l", "r", "score", F.lit(2).cast("long").alias("path_words")))


def _score(left: str, right: str) -> F.Column:
    """Exact as long as a million times the square of the count has at most 38 digits."""
    big = "cast({} AS decimal(38, 0))"
    a, l, r = (big.format(c) for c in ("a", left, right))
    return F.expr(f"(cast(1000000 AS decimal(38, 0)) * {a} * {a}) div ({l} * {r})")


def mine(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    min_count: int = MIN_COUNT,
    top: int = TOP,
    share: int = SHARE,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score, path_words``: each language's best phrases.

    Texts are lower-cased (A-Z) and cut into pieces at punctuation and line ends; phrases of two
    and three words inside a piece that occur ``min_count`` times are candidates. ``a`` is a
    phrase's count, ``l`` and ``r`` those of its parts at the cut with the lowest score, ``n`` the
    language's words. A candidate inside a longer one with ``share`` percent of its count is left
    out. ``path_words`` is the length of the compacted path on which a phrase of three words
    lies: 3 if it stands for itself, more if it is part of a longer fixed passage, 2 for phrases of two words.

    A NULL text is empty, a NULL language is ``und``; repeated rows count again. Ties are ranked
    by count and phrase. An empty table, or one without candidates, gives an empty result;
    other columns are not read.
    """
    found = graph(df, text, lang, min_count)
    best = ranked(
        durable(candidates(found, share)),
        [F.col("score").desc(), F.col("a").desc(), F.col("phrase")],
        by=["lang"],
    ).filter(F.col("rank") <= top)
    totals = found.totals.withColumnRenamed("lang", "total_lang")
    joined = best.join(totals, F.col("lang") == F.col("total_lang"))
    return joined.select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "path_words")
