"""Batched merge rounds against the tokenizers library and against plain merging."""

import hashlib
import os
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer as Library

import __spark_entry__ as contract
from panelkit.llm import merge_rounds
from panelkit.llm.common import table
from panelkit.llm.queries import vocabulary_file

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
FILE = "byte_bpe_50k.json"


@pytest.fixture(scope="module")
def library():
    return Library.from_file(public_tokenizers.path(FILE))


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def test_odd_texts(library):
    rng = random.Random(5)
    texts = [
        None, "", " ", "\n\n  \n", "<|endoftext|>", "a<|endoftext|><|endoftext|> b<|endoftext", "aaaa aaaaa aaaaaa" * 9,
        "Grüße, 漢字 😀! it's 'll we'LL\x00", "x" * 40_000, "".join(rng.choice("abcdefgh") for _ in range(9_000)),
    ]
    for _ in range(300):
        kinds = [(32, 127), (0xA0, 0x3000), (0x10000, 0x1F800), (9, 14)]
        texts.append("".join(chr(rng.randrange(*rng.choice(kinds))) for _ in range(rng.randrange(150))))
    own = merge_rounds.tokenizer(vocabulary_file(FILE))
    ids, counts = own.encode(pa.array(texts))
    at = 0
    for text, n, decoded in zip(texts, counts.tolist(), own.decode(ids, counts)):
        assert (ids[at : at + n].tolist(), decoded.decode()) == expected(library, text)
        at += n
    assert at == len(ids)


def plain(piece, pairs):
    """One merge at a time: the lowest rank, and of its places the first."""
    out = list(piece)
    while True:
        found = [(pairs[p][0], i) for i, p in enumerate(zip(out, out[1:])) if p in pairs]
        if not found:
            return out
        i = min(found)[1]
        out[i : i + 2] = [pairs[out[i], out[i + 1]][1]]


@pytest.mark.parametrize("ordered", [True, False])
def test_rounds_against_single_merges(ordered):
    rng = random.Random(ordered)
    for _ in range(40):
        pairs, size = {}, 4
        for rank in range(30):
            pair = (rng.randrange(size), rng.randrange(size))
            if pair not in pairs:
                pairs[pair] = (rank, size)
                size += 1
        if not ordered:
            ranks = [r for r, _ in pairs.values()]
            rng.shuffle(ranks)
            pairs = {p: (r, new) for r, (p, (_, new)) in zip(ranks, pairs.items())}
        rounds = merge_rounds.Rounds(np.arange(256), pairs)
        pieces = [bytes(rng.randrange(4) for _ in range(rng.randrange(1, 40))) for _ in range(30)]
        data = np.frombuffer(b"".join(pieces), np.uint8)
        ids, counts = rounds(data, np.array([len(p) for p in pieces]))
        assert rounds.ordered or not ordered
        want = [plain(p, pairs) for p in pieces]
        assert counts.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]


def test_broken_bytes_decode_as_in_the_library(library):
    own = merge_rounds.tokenizer(vocabulary_file(FILE))
    rng = random.Random(3)
    for _ in range(200):
        ids = [rng.randrange(50257) for _ in range(rng.randrange(12))]
        assert own.decode(np.array(ids, np.int64), np.array([len(ids)]))[0].decode() == library.decode(
            ids, skip_special_tokens=False
        )


def test_odd_rows(odd, none, library):
    rows = merge_rounds.encode_and_decode(odd, vocabulary_file(FILE)).collect()
    source = {(r.doc_id, r.text) for r in odd.collect()}
    assert len(rows) == odd.count()
    assert {(r.doc_id, r.decoded) for r in rows} == {(i, text or "") for i, text in source}
    by_text = {r.decoded: r.ids for r in rows}
    assert all(by_text[text or ""] == expected(library, text)[0] for _, text in source)
    assert merge_rounds.digests(none, vocabulary_file(FILE)).collect() == []


def test_query_against_the_library(spark, library):
    documents = {r.doc_id: r.text for r in table(spark, SF_DIR, "documents").collect()}
    rows = contract.queries()["op13_merge_rounds"](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(documents)
    for r in rows:
        ids, decoded = expected(library, documents[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
