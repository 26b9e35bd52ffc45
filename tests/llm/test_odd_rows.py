"""NULLs, empty and long texts, repeated rows, empty tables and clashing names."""

import hashlib

import public_tokenizers
import pytest

from panelkit.llm import (
    language,
    license_scan,
    line_quality,
    merkle,
    ngram_join,
    packing,
    quality_rules,
    sentencepieces,
    sharding,
    warc,
)
from panelkit.llm.queries import vocabulary_file

from .conftest import LONG, TEXTS

N = len(TEXTS)


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_license_scan(odd, none):
    rows = license_scan.scan(odd).collect()
    assert len(rows) == N
    got = {r.doc_id: r for r in rows}
    assert (got[1].base_labels, got[1].labels, got[1].first_word, got[1].score) == ("apache", "apache,apache-2.0", 3, 1.0)
    assert (got[2].n_words, got[2].labels, got[2].first_word, got[2].score) == (0, "", None, 0.0)
    assert got[5].n_words == 30_001
    assert license_scan.scan(none).count() == 0


def test_license_with_words_left_out(spark):
    notice = license_scan.NOTICES[2].words
    text = " ".join(["pad"] * 5 + notice[:20] + notice[22:])
    spans = license_scan.spans(spark.createDataFrame([(1, text)], "doc_id int, text string"))
    [span] = [r for r in spans.collect() if r.t >= 0]
    assert (span.label, span.start, span.stop) == ("mit", 5, 5 + len(notice) - 2)


def test_quality_rules(odd, none):
    rows = quality_rules.judge(odd).collect()
    assert len(rows) == N
    got = {r.doc_id: r for r in rows}
    assert (got[2].n_words, got[2].base_failed, got[2].kept) == (0, True, False)
    assert got[5].n_repeat_words == 30_000 and got[5].word_chars == 420_000
    assert quality_rules.judge(none).count() == 0
    kept = quality_rules.keep_good(odd)
    assert kept.columns == odd.columns and kept.count() == sum(r.kept for r in rows)
    assert quality_rules.keep_good(none).count() == 0


def test_host_verdicts(spark):
    good = " ".join(f"word{i}" for i in range(60))
    noisy = " ".join(f"w{i}# $$$" for i in range(60))
    rows = [(i, "bad" if i < 40 else "fine", noisy if i < 30 or i == 99 else good) for i in range(100)]
    got = by_id(quality_rules.judge(spark.createDataFrame(rows, "doc_id long, source string, text string")))
    assert not got[0].kept and got[0].host_failed
    assert got[35].kept  # a clean document of the bad host
    assert got[99].kept  # one failure of a host that is fine


def test_beta_prior():
    a, b = quality_rules.beta_prior(0.2, 0.01)
    assert a / (a + b) == pytest.approx(0.2) and a + b == pytest.approx(15)
    assert quality_rules.beta_prior(0.0, 0.0) == (0.0, 1000.0)


def test_merkle(odd, none, spark):
    rows = merkle.compare_with_edit(odd).collect()
    assert len(rows) == N
    got = {r.doc_id: r for r in rows}
    assert got[2].edited_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[2].fingerprint == got[3].fingerprint and got[2].near_next == 1.0
    assert got[9].fingerprint == got[10].fingerprint
    assert got[5].n_chars == len(LONG)
    assert merkle.compare_with_edit(none).count() == 0
    [alone] = merkle.compare_with_edit(odd.filter("doc_id = 6")).collect()
    assert alone.near_next == 1.0
    text = "\n".join(f"Paragraph {i}. It has two sentences." for i in range(40))
    two = spark.createDataFrame([(text, text.replace("Paragraph 30", "Paragraph x"))], "a string, b string")
    a, b = merkle.tree(two.a), merkle.tree(two.b)
    [row] = two.select(merkle.likeness(a, b).alias("near"), merkle.changed_sections(a, b).alias("at")).collect()
    assert 0.9 < row.near < 1 and any(p["first"] <= 30 < p["first"] + p["size"] for p in row.at)


def test_next_text_over_ranges(spark):
    rows = [(i * i, f"t{i}") for i in range(500)]
    df = spark.createDataFrame(rows, "k long, text string").repartition(7)
    got = {r.k: r.next for r in merkle.with_next(df, "k", "text").collect()}
    assert got == {i * i: f"t{(i + 1) % 500}" for i in range(500)}


def test_ngram_join(odd, none):
    rows = ngram_join.similar_groups(odd).collect()
    assert len(rows) == N
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert got[2] == (0, 2) and got[3] == (0, 3) and got[4] == (0, 4)
    assert got[6] == (6, 6) and got[7] == (6, 6) and got[8] == (7, 6)
    assert got[9] == (1, 9) and got[10] == (1, 9) and got[11] == (2, 11)
    assert got[5] == (2, 5)
    assert ngram_join.similar_groups(none).count() == 0


def test_chain_of_links(spark):
    """Neighbours are linked, the ends of the chain are not alike; one group all the same."""
    base = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(base[4 * i : 4 * i + 60])) for i in range(10)]
    rows += [(100 + i, rows[0][1]) for i in range(30)]
    got = by_id(ngram_join.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {r.component_id for r in got.values()} == {0}


def test_language(odd, none):
    rows = language.identify(odd).collect()
    assert len(rows) == N and {r.lang_pred for r in rows} == {"und"}
    assert language.identify(none).count() == 0
    pairs = [("the and of to with from", "en"), ("der die und nicht mit auf", "de")] * 20
    model = language.fit(pairs)
    import pyarrow as pa

    names, score = language.predict(model, pa.array(["the and the", "und nicht", None, "12 !", "— “”"]))
    assert names == ["en", "de", "und", "und", "und"] and (score[:2] > 0.8).all() and not score[2:].any()
    _, _, _, both = language.label_words(model, pa.array(["the and of to der die und nicht"]))
    assert both.argmax(axis=1).tolist() == [1, 1, 1, 1, 0, 0, 0, 0]


def test_line_quality(odd, none, no_labels, spark):
    rows = line_quality.score(odd, no_labels).collect()
    assert len(rows) == N and {r.score for r in rows} == {0.5}
    assert line_quality.score(none, no_labels).count() == 0
    assert line_quality.keep_good(odd, no_labels).columns == odd.columns
    labels = spark.createDataFrame([(i, int(i % 2)) for i in (6, 7, 8, 9, 10)], "doc_id long, quality int")
    assert all(0 <= r.score <= 1 for r in line_quality.score(odd, labels).collect())


def test_packing(odd, none):
    content = vocabulary_file("byte_bpe_50k.json")
    rows = packing.pack_documents(odd, content).collect()
    totals = {}
    for r in rows:
        totals[r.sequence_id] = totals.get(r.sequence_id, 0) + r.length
    assert max(totals.values()) <= 1024
    assert [r.length for r in rows if r.doc_id == 2] == [1]
    assert packing.pack_documents(none, content).count() == 0
    from tokenizers import Tokenizer

    ids = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(TEXTS[10][1], add_special_tokens=False).ids
    assert 50256 in ids and {r.doc_tokens for r in rows if r.doc_id == 11} == {len(ids) + 1}


@pytest.mark.parametrize("cut", [True, False])
def test_packing_keeps_all_limits(cut):
    import numpy as np

    random = np.random.default_rng(1)
    tokens = random.integers(0, 300, 400)
    prompt = (tokens * random.random(400)).astype(np.int64)
    limits = packing.Limits(tokens=256, segments=4, loss=120)
    rows = packing.plan(tokens, prompt, limits, cut=cut)
    assert rows[:, 2].sum() == tokens.sum()
    for i in np.unique(rows[:, 0]):
        own = rows[rows[:, 0] == i]
        own = own[np.argsort(own[:, 1])]
        assert own[0, 1] == 0 and (own[1:, 1] == (own[:, 1] + own[:, 2])[:-1]).all()
    for s in np.unique(rows[:, 3]):
        own = rows[rows[:, 3] == s]
        loss = np.maximum(0, own[:, 1] + own[:, 2] - np.maximum(own[:, 1], prompt[own[:, 0]]))
        assert own[:, 2].sum() <= 256 and len(own) <= 4 and loss.sum() <= 120


def test_byte_bpe(odd, none):
    content = vocabulary_file("byte_bpe_multi_50k.tiktoken")
    rows = sentencepieces.encode_and_decode(odd, content).collect()
    assert len(rows) == N
    texts = dict(TEXTS)
    assert all(bytes(r.decoded).decode() == (texts[r.doc_id] or "") for r in rows)
    assert sentencepieces.digests(none, content).count() == 0


def test_warc(spark):
    body = "é" * 600
    rows = [(1, "u", body), (2, "u\n", body), (3, None, "short"), (4, "u", "short"), (5, "u", None), (None, "u", body)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, path string")
    files = warc.write_archives(pages.repartition(2))
    got = {r.page_id: r for r in warc.read_archives(files).collect()}
    assert len(got) == 6
    assert (got[1].record_type, got[1].refers_to) == ("revisit", 2) == (got[None].record_type, got[None].refers_to)
    assert (got[2].record_type, got[2].refers_to, got[2].payload_bytes) == ("response", None, 1200)
    assert got[3].record_type == got[4].record_type == "response"
    assert got[5].payload_digest == hashlib.sha1(b"").hexdigest()
    assert warc.read_archives(warc.write_archives(pages.limit(0))).count() == 0


def test_sharding(odd, none, spark, tmp_path):
    rows = sharding.assign(odd, 100).collect()
    assert len(rows) == N
    assert {r.doc_id for r in rows if not r.fits} == {5}
    assert all(r.depth == len(r.shard) for r in rows)
    assert sharding.assign(none, 100).count() == 0
    hot = spark.createDataFrame([(1, "x" * 50)] * 5 + [(2, "y")], "doc_id long, text string")
    got = {(r.doc_id, r.shard_bytes, r.fits) for r in sharding.assign(hot, 100).collect()}
    assert got == {(1, 250, False), (2, 1, True)}
    many = spark.range(300).selectExpr("id AS doc_id", "repeat('z', 10) AS text")
    directory = sharding.write_shards(many, str(tmp_path / "out"), 400)
    assert all(r.fits for r in directory.collect())
    assert spark.read.parquet(str(tmp_path / "out")).count() == 300


def test_repeated_parts_of_a_license_are_not_the_whole(spark):
    rows = [(1, "released under the mit released under the mit"), (2, "Released under the MIT License."), (3, "released under the mit x released under the mit license")]
    got = by_id(license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")))
    assert (got[1].labels, got[1].n_base, got[1].n_spans) == ("", 0, 0)
    assert (got[2].labels, got[2].score) == ("mit", 1.0) and got[3].labels == "mit"


def test_shards_of_a_table_with_a_shard_column(spark, tmp_path):
    rows = [(i if i % 9 else None, "t" * (i % 50), f"own {i}", i) for i in range(200)] + [(7, "again", "x", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string, placed_key int")
    sharding.write_shards(df, str(tmp_path / "out"), 300)
    back = spark.read.parquet(str(tmp_path / "out")).select(*df.columns)
    assert sorted(map(str, map(tuple, back.collect()))) == sorted(map(str, rows))
