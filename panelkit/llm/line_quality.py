"""Document quality from its lines.

A linear-chain conditional random field labels every line good or bad. A line is described
by its own counts (words, word lengths, symbols, capitals, digits, marks, distinct words, first
and last character, whether an earlier line is equal) and by some of those of the lines before
and after it. The marginals of forward-backward, weighted by line length, give the share of
the text that is good; a logistic curve fitted on the training sample turns the share into the
probability that the document's label is 1.

The field is fitted on the driver, on a bounded sample (``SAMPLE`` labelled texts of at most
``sample.LONGEST`` code points); every line of a training text has the label of its text.
Prediction is one pass over the texts without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from panelkit.llm import chain, flat
from panelkit.llm.common import fold_of, own, python_ready, quoted
from panelkit.llm.sample import LONGEST, uniform_sample

SAMPLE = 2_500  # labelled texts
WIDTH = 16  # values of a feature

_SHARES = np.array([1e-9, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.65, 0.8, 0.95, 1.0, 1.5, 2.0, 3.0])


def _bytes(text: str) -> np.ndarray:
    mask = np.zeros(256, bool)
    mask[list(text.encode())] = True
    return mask


_UPPER = _bytes("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOWER = _bytes("abcdefghijklmnopqrstuvwxyz")
_DIGIT = _bytes("0123456789")
_SYMBOL = _bytes("#*$%&<>")
_BAR = _bytes("|")
_SHOUT = _bytes("!?")
_END = _bytes(".!?:;\"')")
_OTHER = _bytes(",;:()[]{}'\"/\\-_+=~^`@")
_KIND = np.select(
    [_UPPER, _LOWER, _DIGIT, _END, _SYMBOL | _BAR, np.arange(256) >= 128], [1, 2, 3, 4, 5, 6], 0
)

# Features that also describe the neighbouring lines.
_AROUND = (2, 3, 4, 6, 7, 10)
_OWN = 12
FEATURES = (_OWN + 2 * len(_AROUND)) * WIDTH


@dataclass
class Model:
    field: chain.Chain
    slope: float
    offset: float
    prior: float  # probability for a text without a line


def line_features(column) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Feature numbers (a row per line), length and text number of each line with a word."""
    data, offsets = flat.flatten(column)
    n = len(offsets) - 1
    starts, ends, docs = flat.spans(data, offsets, flat.NEWLINE)
    word_start, word_end, _ = flat.spans(data, offsets, flat.SPACE)
    left, right = np.searchsorted(word_start, starts), np.searchsorted(word_start, ends)
    filled = right > left
    starts, ends, docs = starts[filled], ends[filled], docs[filled]
    words = (right - left)[filled]
    if not len(starts):
        return np.zeros((0, _OWN + 2 * len(_AROUND)), np.int64), ends, docs, n
    positions = np.stack([starts, ends], axis=1).ravel()

    def count(mask: np.ndarray) -> np.ndarray:
        at = flat.counts_between(mask[data], positions)
        return at[1::2] - at[::2]

    size = ends - starts
    hashes = flat.hash_spans(data, word_start, word_end)
    line = np.repeat(np.arange(len(starts)), words)
    key = flat.mix(hashes ^ flat.mix(line.astype(np.uint64)))
    order = np.argsort(key)
    repeat = key[order][1:] == key[order][:-1]
    distinct = words - np.bincount(line[order][1:][repeat], minlength=len(starts))
    text = flat.hash_spans(data, starts, ends)
    key = flat.mix(text ^ flat.mix(docs.astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    earlier = np.zeros(len(starts), np.int64)
    earlier[order[1:]] = key[order][1:] == key[order][:-1]

    upper, lower = count(_UPPER), count(_LOWER)
    first, last = data[word_start[left[filled]]], data[word_end[right[filled] - 1] - 1]

    def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return np.searchsorted(_SHARES, part / np.maximum(whole, 1), "right")

    own_columns = [
        np.minimum(np.log2(words + 1).astype(np.int64) + 1, WIDTH - 1),
        np.minimum(size // np.maximum(words, 1), WIDTH - 1),
        share(count(_SYMBOL), words),
        share(upper, upper + lower),
        share(count(_BAR), words),
        share(count(_DIGIT), size),
        share(count(_SHOUT), words),
        share(distinct, words),
        _KIND[first],
        _KIND[last],
        earlier,
        share(count(_OTHER), words),
    ]
    own_table = np.stack(own_columns, axis=1)
    around = own_table[:, list(_AROUND)]
    before, after = np.full_like(around, WIDTH - 1), np.full_like(around, WIDTH - 1)
    same = docs[1:] == docs[:-1]
    before[1:][same] = around[:-1][same]
    after[:-1][same] = around[1:][same]
    table = np.concatenate([own_table, before, after], axis=1)
    return table + WIDTH * np.arange(table.shape[1]), size, docs, n


def _chains(docs: np.ndarray) -> np.ndarray:
    """The number of lines of each text that has one."""
    sizes = np.bincount(docs) if len(docs) else np.zeros(0, np.int64)
    return sizes[sizes > 0]


def good_share(field: chain.Chain, column) -> tuple[np.ndarray, np.ndarray]:
    """The length-weighted marginal of label good of each text, and whether it has a line."""
    table, size, docs, n = line_features(column)
    total = np.bincount(docs, weights=size, minlength=n)
    if not len(docs):
        return np.zeros(n), total > 0
    counts = np.full(len(table), table.shape[1], np.int64)
    emission = chain.scores(field, table.ravel(), counts)
    both = chain.marginals(field, emission, _chains(docs))
    good = np.bincount(docs, weights=both[:, 1] * size, minlength=n)
    return good / np.maximum(total, 1), total > 0


def fit(pairs: list[tuple[str, int]]) -> Model | None:
    """A model from (text, label 0 or 1) pairs; None without pairs."""
    if not pairs:
        return None
    column = pa.array([t for t, _ in pairs], pa.string())
    gold = np.array([q for _, q in pairs], np.int64)
    table, _, docs, _ = line_features(column)
    counts = np.full(len(table), table.shape[1], np.int64)
    field = chain.train(
        table.ravel(), counts, gold[docs], _chains(docs), FEATURES, 2, epochs=12, batch=6_000, rate=0.1
    )
    share, has = good_share(field, column)
    x, y = _logit(share[has]), gold[has]
    slope, offset = 1.0, 0.0
    for _ in range(100):  # Newton steps of a logistic regression on one number
        p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -30, 30)))
        w = p * (1 - p) + 1e-6
        g0, g1 = (p - y).sum() + 1e-3 * offset, ((p - y) * x).sum() + 1e-3 * (slope - 1)
        a, b, c = (w * x * x).sum() + 1e-3, (w * x).sum(), w.sum() + 1e-3
        det = a * c - b * b
        slope -= float(np.clip((c * g1 - b * g0) / det, -1, 1))
        offset -= float(np.clip((a * g0 - b * g1) / det, -1, 1))
    prior = (gold.sum() + 1) / (len(gold) + 2)
    return Model(field, max(slope, 1e-3), offset, float(prior))


def _logit(share: np.ndarray) -> np.ndarray:
    s = np.clip(share, 1e-4, 1 - 1e-4)
    return np.log(s / (1 - s))


def predict(model: Model | None, column) -> np.ndarray:
    """The probability of label 1 of each text."""
    if model is None:
        return np.full(len(column), 0.5)
    share, has = good_share(model.field, column)
    z = np.clip(model.slope * _logit(share) + model.offset, -30, 30)
    return np.where(has, 1 / (1 + np.exp(-z)), model.prior)


def learn(df: DataFrame, labels: DataFrame, doc_id: str, text: str) -> Model | None:
    """A model from the rows of ``df`` that have a label and are not held out."""
    known = labels.filter(F.col("quality").isin(0, 1) & (fold_of("doc_id") != 1))
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    texts = df.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text")).filter(F.col("text").isNotNull())
    ids = texts.filter(fold_of("doc_id") != 1).filter(F.length("text") <= LONGEST).select("doc_id")
    drawn = known.join(ids, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    labelled = texts.join(F.broadcast(drawn), "doc_id")
    return fit(uniform_sample(labelled, "quality", SAMPLE))


def score(
    df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row per row of ``df``.

    Learns from rows of ``labels`` (``doc_id, quality``) outside the held-out fold; a document
    with both labels counts as label 1. A score sees the text only. NULL, empty and wordless texts get the share of label 1 in the
    sample; without any label every score is 0.5. Equal texts get equal scores. An empty
    table gives an empty result; other columns are not read.
    """
    spark = df.sparkSession
    python_ready(spark)
    model = spark.sparkContext.broadcast(learn(df, labels, doc_id, text))
    slim = df.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))

    def run(batches):
        for batch in batches:
            for piece in flat.slices(batch, "text"):
                found = predict(model.value, piece.column(2))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(1), pa.array(found), pa.array((found >= 0.5).astype(np.int32))],
                    ["doc_id", "held_out", "score", "predicted"],
                )

    held = F.coalesce(fold_of("doc_id") == 1, F.lit(False)).alias("held_out")
    kind = dict(slim.dtypes)["doc_id"]
    schema = f"doc_id {kind}, held_out boolean, score double, predicted int"
    return slim.select("doc_id", held, "text").mapInArrow(run, schema)


def keep_good(
    df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``df`` that are predicted to have label 1, with its columns.

    Judged as in :func:`score`: a NULL, empty or wordless text goes if label 1 is rarer than
    label 0 in the sample; repeated rows and equal texts stay or go together; without any label
    everything stays. An empty table gives an empty result.
    """
    spark = df.sparkSession
    python_ready(spark)
    model = spark.sparkContext.broadcast(learn(df, labels, doc_id, text))
    name = own("quality_score", df.columns)
    at = df.columns.index(text)

    def run(batches):
        for batch in batches:
            for piece in flat.slices(batch, batch.schema.names[at]):
                found = pa.array(predict(model.value, piece.column(at)))
                yield pa.RecordBatch.from_arrays([*piece.columns, found], [*piece.schema.names, name])

    schema = StructType([*df.schema.fields, StructField(name, DoubleType())])
    scored = df.mapInArrow(run, schema)
    return scored.filter(F.col(name) >= 0.5).drop(name)
