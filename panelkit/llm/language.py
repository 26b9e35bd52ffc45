"""Language identification, word by word.

A linear-chain conditional random field labels every word of a text with a language. Its
features are the word's affixes (first and last one to three bytes), its character n-grams
(two and three bytes) and its entry in a lexicon of words that are frequent in the training
sample. The transitions are learned from code-switched sequences made by joining short
stretches of sampled texts of different languages. The language of a text is the one with the
largest sum of word marginals; the words of a text with several languages keep their own.

The field is fitted on the driver, on a bounded sample (``PER_LANGUAGE`` and ``TOTAL`` texts
of at most ``sample.LONGEST`` code points). Prediction is one pass over the texts without a
shuffle. Features are computed once per distinct word of a batch.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm import chain, flat
from panelkit.llm.common import fold_of, python_ready, quoted
from panelkit.llm.sample import labelled_sample

PER_LANGUAGE = 120  # sampled texts per language
TOTAL = 2_000  # sampled texts in all
LEXICON = 20_000  # words
BITS = 17  # affixes and n-grams are hashed to 2 ** BITS features
CHAIN = 256  # words of a training sequence
STRETCH = 20  # mean words between switches in training sequences

UNKNOWN = "und"

# Letters: A-Z, a-z and all bytes of multi-byte characters.
_OTHER = np.ones(256, bool)
_OTHER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False
_PAD = 3


@dataclass
class Model:
    languages: list[str]
    lexicon: np.ndarray  # sorted word hashes
    field: chain.Chain


def _words(column):
    data, offsets = flat.flatten(column)
    data = flat.LOWER[data]
    starts, ends, docs = flat.spans(data, offsets, _OTHER)
    return data, offsets, starts, ends, docs, flat.hash_spans(data, starts, ends)


def word_features(data, starts, ends, hashes, lexicon) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of the given words, one word after the other, and how many each has."""
    padded = np.concatenate([data, np.zeros(_PAD, np.uint8)]).astype(np.uint32)
    size = ends - starts
    owners, numbers = [], []

    def add(kind: int, owner: np.ndarray, at: np.ndarray, width: int) -> None:
        code = np.full(len(at), kind, np.uint32)
        for i in range(width):
            code = (code * np.uint32(257)) ^ padded[at + i]
        code *= np.uint32(2654435761)
        owners.append(owner)
        numbers.append((code >> np.uint32(32 - BITS)).astype(np.int64))

    everyone = np.arange(len(starts))
    for width in (1, 2, 3):
        long = everyone[size >= width]
        add(width, long, starts[long], width)
        add(10 + width, long, ends[long] - width, width)
    for width in (2, 3):
        times = np.maximum(size - width + 1, 0)
        owner = np.repeat(everyone, times)
        add(20 + width, owner, chain._ranges(starts, times), width)
    if len(lexicon):
        place = np.minimum(np.searchsorted(lexicon, hashes), len(lexicon) - 1)
        known = np.flatnonzero(lexicon[place] == hashes)
        owners.append(known)
        numbers.append((1 << BITS) + place[known])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(numbers)[order], np.bincount(owner, minlength=len(starts))


def fit(pairs: list[tuple[str, str]], seed: int = 7) -> Model:
    """A model from (text, language) pairs. Without pairs it knows no language."""
    languages = sorted({lang for _, lang in pairs})
    data, offsets, starts, ends, docs, hashes = _words(pa.array([t for t, _ in pairs], pa.string()))
    distinct, at, back, times = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
    frequent = np.argsort(-times, kind="stable")[:LEXICON]
    lexicon = np.sort(distinct[frequent[times[frequent] >= 3]])
    numbers, counts = word_features(data, starts[at], ends[at], distinct, lexicon)
    feature_at = np.cumsum(counts) - counts

    of_text = np.array([languages.index(lang) for _, lang in pairs], np.int64)
    random = np.random.default_rng(seed)
    pieces = []
    edges = np.searchsorted(docs, np.arange(len(pairs) + 1))
    for low, high in zip(edges[:-1], edges[1:]):
        while low < high:
            end = min(high, low + random.geometric(1 / STRETCH))
            pieces.append((low, end))
            low = end
    words = np.zeros(0, np.int64)
    if pieces:
        random.shuffle(pieces)
        words = np.concatenate([np.arange(a, b) for a, b in pieces])
    lengths = np.full(-(-len(words) // CHAIN), CHAIN, np.int64)
    if len(lengths):
        lengths[-1] = len(words) - CHAIN * (len(lengths) - 1)
    rows = back[words]
    field = chain.train(
        numbers[chain._ranges(feature_at[rows], counts[rows])],
        counts[rows],
        of_text[docs[words]] if len(words) else words,
        lengths,
        (1 << BITS) + max(1, len(lexicon)),
        max(1, len(languages)),
        epochs=3,
        batch=16_000,
    )
    return Model(languages, lexicon, field)


def label_words(model: Model, column):
    """Word positions ``(starts, ends, docs)`` and the marginals of each word."""
    data, offsets, starts, ends, docs, hashes = _words(column)
    if not len(starts):
        return starts, ends, docs, np.zeros((0, len(model.languages)))
    distinct, at, back = np.unique(hashes, return_index=True, return_inverse=True)
    emission = np.empty((len(distinct), len(model.languages)), np.float32)
    step = 50_000
    for low in range(0, len(distinct), step):
        part = slice(low, low + step)
        numbers, counts = word_features(data, starts[at[part]], ends[at[part]], distinct[part], model.lexicon)
        emission[part] = chain.scores(model.field, numbers, counts)
    sizes = np.bincount(docs)
    return starts, ends, docs, chain.marginals(model.field, emission[back], sizes[sizes > 0])


def predict(model: Model, column) -> tuple[list[str], np.ndarray]:
    """The language of each text and its share of all words' marginals."""
    n = len(column)
    if not model.languages or not n:
        return [UNKNOWN] * n, np.zeros(n)
    _, _, docs, both = label_words(model, column)
    sums = np.stack([np.bincount(docs, weights=both[:, i], minlength=n) for i in range(both.shape[1])], axis=1)
    total = sums.sum(axis=1)
    best = sums.argmax(axis=1)
    score = np.where(total > 0, sums.max(axis=1) / np.maximum(total, 1e-12), 0.0)
    names = [model.languages[b] if t > 0 else UNKNOWN for b, t in zip(best, total)]
    data, offsets = flat.flatten(column)
    latin = flat.per_text(~_OTHER[data] & (data < 128), offsets)
    for i in np.flatnonzero((latin == 0) & (total > 0)):
        if not any(c.isalpha() for c in column[i].as_py()):
            names[i], score[i] = UNKNOWN, 0.0
    return names, np.clip(score, 0.0, 1.0)


def identify(df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score``, one row per row of ``df``.

    Learns from rows with a language whose id is not in the held-out fold; a prediction sees
    the text only. NULL, empty and letterless texts are ``und`` with score 0, as is every text
    if there is nothing to learn from. Equal texts get equal results. An empty table gives an
    empty result; other columns are not read.
    """
    spark = df.sparkSession
    python_ready(spark)
    slim = df.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"), quoted(lang).alias("lang"))
    learn = slim.filter((fold_of("doc_id") != 1) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    model = spark.sparkContext.broadcast(fit(labelled_sample(learn, "lang", PER_LANGUAGE, TOTAL)))

    def run(batches):
        for batch in batches:
            for piece in flat.slices(batch, "text"):
                names, score = predict(model.value, piece.column(2))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(1), pa.array(names, pa.string()), pa.array(score)],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )

    held = F.coalesce(fold_of("doc_id") == 1, F.lit(False)).alias("held_out")
    kind = dict(slim.dtypes)["doc_id"]
    schema = f"doc_id {kind}, held_out boolean, lang_pred string, score double"
    return slim.select("doc_id", held, "text").mapInArrow(run, schema)
