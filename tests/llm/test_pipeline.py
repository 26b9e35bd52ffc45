"""The pipeline against plain Python, and its stages on odd rows."""

import os
import re
from collections import Counter

import pytest

import corpus_pipeline
from panelkit.llm import line_quality, quality_rules
from panelkit.llm.common import table

from .test_queries import check_packing

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def measured(text):
    words = words_of(text)
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times, repeated = Counter(grams), set()
    for i, g in enumerate(grams):
        if times[g] > 1:
            repeated |= {i, i + 1, i + 2}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum((text or "").count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_lines": len(lines),
        "n_repeat_words": len(repeated),
    }


def holds(rule, m):
    return bool(eval(rule.replace("AND", "and").replace("OR", "or"), {}, m))


def after_rules(docs):
    """The documents that the rules keep, from their own measures and their hosts' habits."""
    found = {i: measured(d.text) for i, d in docs.items()}
    hosts = {}
    for i, d in docs.items():
        hosts.setdefault(d.source, []).append(found[i])
    low, high = quality_rules.PRIOR_LIMITS
    bad = {}
    for name, rule in quality_rules.RULES.items():
        fails = {h: sum(holds(rule, m) for m in own) for h, own in hosts.items()}
        rates = [fails[h] / len(own) for h, own in hosts.items()]
        mean = sum(rates) / len(rates)
        spread = sum((r - mean) ** 2 for r in rates) / len(rates)
        weight = min(high, max(low, mean * (1 - mean) / spread - 1)) if spread > 0 else high
        for h, own in hosts.items():
            bad[h, name] = (fails[h] + mean * weight) / (len(own) + weight) >= quality_rules.HOST_LIMIT
    kept = {}
    for i, d in docs.items():
        habit = any(holds(rule, found[i]) and bad[d.source, name] for name, rule in quality_rules.RULES.items())
        if not holds(quality_rules.BASE, found[i]) and not habit:
            kept[i] = d
    return kept


def after_near_duplicates(docs):
    sets = {}
    for i, d in docs.items():
        words = words_of("".join(c.lower() if "A" <= c <= "Z" else c for c in d.text or ""))
        whole = {tuple(words)} if words else set()
        sets[i] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} or whole
    group = {i: i for i in docs}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    ids = sorted(docs)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared):
                x, y = sorted((root(a), root(b)))
                group[y] = x
    return {i: d for i, d in docs.items() if root(i) == i}


def test_against_plain_python(spark):
    docs = {r.doc_id: r for r in table(spark, SF_DIR, "documents").collect()}
    scored = line_quality.score(table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels"))
    good = {r.doc_id for r in scored.filter("predicted = 1").collect()}
    left = after_rules({i: d for i, d in docs.items() if i in good})
    first = after_near_duplicates(left)
    assert 0 < len(first) < len(left) < len(good) < len(docs)
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    check_packing(rows, {i: d.text for i, d in first.items()})


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_odd_rows(spark, odd, none, name, stage):
    out = stage(spark, odd, SF_DIR)
    assert stage(spark, none, SF_DIR).count() == 0
    if name == "packing":
        rows = out.collect()
        assert {r.doc_id for r in rows} == {r.doc_id for r in odd.select("doc_id").collect()}
        return
    assert out.columns == odd.columns
    before = Counter(map(str, map(tuple, odd.collect())))
    after = Counter(map(str, map(tuple, out.collect())))
    assert not after - before
    if name == "rules":  # the long text repeats a word, all others are short
        assert not after
    if name == "near_duplicates":
        assert sum(after.values()) == 9
