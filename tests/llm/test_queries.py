"""The registered queries on the smallest tables: against SQL, brute force or held-out rows."""

import hashlib
import os
import zlib

import numpy as np
import public_tokenizers
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from panelkit.llm import line_quality, ngram_join, quality_rules, queries
from panelkit.llm.common import table
from tools.check import canonical, connect, type_differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in table(spark, SF_DIR, "documents").collect()}


def test_all_are_registered():
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted({int(n[2:].split("_")[0]) for n in names}) == list(range(1, 14))
    assert "pipeline" in contract.queries()


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_against_sql(spark, name):
    df = contract.queries()[name](spark, SF_DIR)
    rel = connect(SF_DIR).sql(contract.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert not type_differences(df, rel)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    assert got == canonical(rel.columns, rel.fetchall())


def test_language_on_held_out_rows(spark, documents):
    rows = contract.queries()["op5_language"](spark, SF_DIR).collect()
    assert len(rows) == len(documents)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r.lang_pred == documents[r.doc_id].lang for r in rows if r.held_out]
    assert np.mean(held) > 0.95


def test_quality_on_held_out_rows(spark, documents):
    rows = {r.doc_id: r for r in contract.queries()["op8_line_quality"](spark, SF_DIR).collect()}
    assert len(rows) == len(documents)
    labels = table(spark, SF_DIR, "labels").collect()
    held = [rows[x.doc_id].predicted == x.quality for x in labels if rows[x.doc_id].held_out]
    assert np.mean(held) > 0.9


def _ids_of(text):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    _ids_of.tool = getattr(_ids_of, "tool", None) or Tokenizer.from_file(path)
    return _ids_of.tool.encode(text or "", add_special_tokens=False).ids + [0]


def check_packing(rows, texts):
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert pieces.keys() == texts.keys()
    for doc_id, own in pieces.items():
        ids, at = np.array(_ids_of(texts[doc_id]), "<u4"), 0
        for r in sorted(own, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    padding = 0
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        total = sum(r.length for r in own)
        assert [r.offset for r in own] == [sum(x.length for x in own[:i]) for i in range(len(own))]
        assert total <= 1024
        padding += 0 if total & (total - 1) == 0 else 1024 - total
    assert padding <= 1024 * 8


def test_packing_against_the_tokenizer(spark, documents):
    rows = contract.queries()["op6_packing"](spark, SF_DIR).collect()
    check_packing(rows, {i: d.text for i, d in documents.items()})


def test_byte_bpe_against_the_library(spark, documents):
    import base64

    import tiktoken

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    tool = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in contract.queries()["op7_byte_bpe"](spark, SF_DIR).collect():
        text = documents[r.doc_id].text or ""
        ids = np.array(tool.encode_ordinary(text), "<u4")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_pipeline_against_its_operators(spark, documents):
    """Each stage's decisions, taken from the operators' own results on what came before."""
    docs = table(spark, SF_DIR, "documents")
    good = line_quality.score(docs, table(spark, SF_DIR, "labels")).filter("predicted = 1")
    docs = docs.join(good.select("doc_id"), "doc_id", "left_semi")
    kept = quality_rules.judge(docs).filter("kept")
    docs = docs.join(kept.select("doc_id"), "doc_id", "left_semi")
    first = {r.doc_id for r in ngram_join.similar_groups(docs).collect() if r.doc_id == r.component_id}
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert 0 < len(first) < len(documents)
    check_packing(rows, {i: documents[i].text for i in first})
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "rules", "near_duplicates", "packing"]
