"""Marginals of the chain against enumeration, and of long chains against single steps."""

from itertools import product

import numpy as np
import pyarrow as pa
import pytest

from panelkit.llm import chain, language, line_quality


def field(labels, seed, features=5):
    rng = np.random.default_rng(seed)
    return chain.Chain(*(rng.normal(size=s).astype(np.float32) for s in ((features, labels), (labels, labels), labels)))


def enumerated(c, emission):
    """Marginals by adding up all label sequences."""
    n, labels = emission.shape
    out = np.zeros((n, labels))
    for path in product(range(labels), repeat=n):
        score = c.starts[path[0]] + sum(emission[i, x] for i, x in enumerate(path))
        score += sum(c.moves[a, b] for a, b in zip(path, path[1:]))
        out[range(n), path] += np.exp(float(score))
    return out / out.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("labels, block", [(2, 256), (3, 2), (2, 1), (4, 3)])
def test_against_enumeration(monkeypatch, labels, block):
    monkeypatch.setattr(chain, "BLOCK", block)
    c, rng = field(labels, block), np.random.default_rng(9)
    lengths = np.array([1, 5, 2, 6, 3, 1, 4])
    emission = rng.normal(size=(lengths.sum(), labels)).astype(np.float32)
    got, at = chain.marginals(c, emission, lengths), 0
    for n in lengths:
        assert np.allclose(got[at : at + n], enumerated(c, emission[at : at + n]), atol=1e-6)
        at += n


def test_a_long_chain_is_one_chain():
    c, rng = field(4, 1), np.random.default_rng(2)
    c.moves[np.arange(4), np.arange(4)] += 4  # labels that hold on, so that far positions matter
    lengths = np.array([3, 100_000, 256, 257, 1, 512, 70_001])
    emission = (0.2 * rng.normal(size=(lengths.sum(), 4))).astype(np.float32)
    whole, _, _ = chain.marginals(c, emission, lengths, expect=True)  # single steps
    assert np.abs(chain.marginals(c, emission, lengths) - whole).max() < 1e-9


def test_moves_and_starts_are_expected_counts():
    c, rng = field(3, 5), np.random.default_rng(6)
    emission = rng.normal(size=(4, 3)).astype(np.float32)
    _, moved, started = chain.marginals(c, emission, np.array([4]), expect=True)
    want, total, first = np.zeros((3, 3)), 0.0, np.zeros(3)
    for path in product(range(3), repeat=4):
        score = c.starts[path[0]] + sum(emission[i, x] for i, x in enumerate(path))
        p = np.exp(float(score + sum(c.moves[a, b] for a, b in zip(path, path[1:]))))
        total += p
        first[path[0]] += p
        for a, b in zip(path, path[1:]):
            want[a, b] += p
    assert np.allclose(moved, want / total, atol=1e-6) and np.allclose(started, first / total, atol=1e-6)


def test_language_of_small_texts_against_enumeration():
    pairs = [("the and of to with from", "en"), ("der die und nicht mit auf", "de"), ("les des une pour", "fr")] * 15
    model = language.fit(pairs)
    texts = ["the und les", "der die of", "x", "pour une nicht mit", "and", "the the die", None, "12"]
    names, score = language.predict(model, pa.array(texts))
    for text, name, own in zip(texts, names, score):
        words = [w for w in (text or "").split() if w.isalpha()]
        if not words:
            assert (name, own) == ("und", 0.0)
            continue
        data, _, starts, ends, _, hashes = language._words(pa.array([text]))
        emission = chain.scores(model.field, *language.word_features(data, starts, ends, hashes, model.lexicon))
        shares = enumerated(model.field, emission).sum(axis=0) / len(words)
        assert name == model.languages[shares.argmax()] and abs(own - shares.max()) < 1e-5


def test_quality_of_small_texts_against_enumeration():
    good, bad = "A line of plain words that ends well.\nAnother line, as plain as that.", "### $$$ %%%\n| x | y |\n!!!! ????"
    model = line_quality.fit([(good, 1), (bad, 0)] * 20)
    texts = [good, bad, good + "\n" + bad, "one", bad + "\n\n" + good, "a\nb\nc"]
    got = line_quality.predict(model, pa.array(texts))
    for text, own in zip(texts, got):
        table, size, _, _ = line_quality.line_features(pa.array([text]))
        emission = chain.scores(model.field, table.ravel(), np.full(len(table), table.shape[1]))
        share = (enumerated(model.field, emission)[:, 1] * size).sum() / size.sum()
        z = np.clip(model.slope * line_quality._logit(np.array([share])) + model.offset, -30, 30)
        assert abs(own - 1 / (1 + np.exp(-z[0]))) < 1e-5
