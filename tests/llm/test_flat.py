"""The byte-level helpers against plain Python."""

import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from panelkit.llm import chain, flat, ngram_join, pretokens
from panelkit.llm.ngram_join import _folded, _signature, gram_sets
from panelkit.llm.vocabulary import PATTERN

TEXT = st.lists(st.one_of(st.none(), st.text(alphabet="ab 's\n\t é漢1٣!\x85 re", max_size=25)), max_size=8)


def test_pattern_is_the_public_one():
    assert PATTERN == public_tokenizers.PATTERN


@settings(max_examples=200, deadline=None)
@given(TEXT)
def test_words_and_pieces(texts):
    data, offsets = flat.flatten(pa.array(texts, pa.string()))
    starts, ends, docs = flat.spans(data, offsets, flat.SPACE)
    got = [(d, bytes(data[a:b]).decode()) for a, b, d in zip(starts, ends, docs)]
    assert got == [(i, w) for i, t in enumerate(texts) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
    hashes = dict(zip((w for _, w in got), flat.hash_spans(data, starts, ends).tolist()))
    assert len(set(hashes.values())) == len(hashes)
    a, b, d, _ = pretokens.pieces(data, offsets)
    own = [(i, bytes(data[x:y]).decode()) for x, y, i in zip(a, b, d)]
    assert own == [(i, p) for i, t in enumerate(texts) for p in regex.findall(PATTERN, t or "")]


def test_long_runs_hash_alike():
    run = "q" * (3 * flat.BLOCK + 5)
    data, offsets = flat.flatten(pa.array([run + " z", "z " + run, run[:-1]]))
    starts, ends, _ = flat.spans(data, offsets, flat.SPACE)
    h = flat.hash_spans(data, starts, ends)
    assert h[0] == h[3] and h[1] == h[2] and h[4] != h[0]


def test_signatures_bound_differences():
    random = np.random.default_rng(0)
    for n in (3, 64, 65, 700):
        a = np.unique(random.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[n // 10 :], random.integers(0, 2**63, n // 10).astype(np.uint64)]))
        apart = len(np.setxor1d(a, b))
        for x, y in ((_signature(a), _signature(b)), (_folded(_signature(a)), _folded(_signature(b)))):
            if len(x) == len(y):
                bits = np.unpackbits((x ^ y).view(np.uint8)).sum()
                assert bits <= apart
    assert len(gram_sets(pa.array(["a b c d e e e e e e e"]), 5)[0]) == 5


def test_marginals_against_enumeration():
    random = np.random.default_rng(0)
    model = chain.Chain(np.zeros((1, 3)), random.normal(size=(3, 3)), random.normal(size=3))
    lengths = np.array([3, 1, 4])
    emission = random.normal(size=(8, 3)).astype(np.float32)
    got, moved, started = chain.marginals(model, emission, lengths, expect=True)
    at, moves = 0, np.zeros((3, 3))
    for n in lengths:
        weights = np.zeros((n, 3))
        total, pairs = 0.0, np.zeros((3, 3))
        for path in np.ndindex(*[3] * n):
            s = model.starts[path[0]] + sum(emission[at + i, p] for i, p in enumerate(path))
            s += sum(model.moves[a, b] for a, b in zip(path, path[1:]))
            w = np.exp(s)
            total += w
            for i, p in enumerate(path):
                weights[i, p] += w
            for a, b in zip(path, path[1:]):
                pairs[a, b] += w
        assert np.allclose(got[at : at + n], weights / total, atol=1e-5)
        moves += pairs / total
        at += n
    assert np.allclose(moved, moves, atol=1e-5) and np.isclose(started.sum(), 3)


@pytest.mark.parametrize("top", [0, 1, 255, 256, 65_535, 65_536, 3_000_000_000])
def test_sketches_add_up_in_any_width(top):
    bits = 12
    rng = np.random.default_rng(top)
    tables = [rng.integers(0, top, 1 << bits, np.uint32, endpoint=True) for _ in range(3)]
    tables[1][: 1 << (bits - 1)] = 0
    batches = [
        pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int32()), pa.array([b for _, b in rows], pa.binary())], ["part", "counts"])
        for table in tables
        for rows in ngram_join._sketch_rows(table)
    ]
    assert all(b.num_rows <= 16 for b in batches)
    width = (1 << bits) // ngram_join.PARTS
    found = np.zeros(1 << bits, np.uint8)
    for batch in ngram_join._add_up(bits)(batches):
        for part, level in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found[part * width : (part + 1) * width] = np.frombuffer(level, np.uint8)
    total = np.sum([t.astype(np.uint64) for t in tables], axis=0)
    assert (found == np.minimum(8 * np.log2(1.0 + total), 255).astype(np.uint8)).all()
