"""Collocations and their graph against plain counting."""

import random
import re
from collections import Counter

import pytest

from panelkit.llm import collocations


def pieces(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for line in re.split(r"[.,;:!?\x0A-\x0D]", low):
        if words := re.findall(r"[^\x20\x09]+", line):
            yield words


def counted(rows):
    """Occurrences of every phrase of one to three words, per language."""
    out = {}
    for text, lang in rows:
        for words in pieces(text):
            own = out.setdefault(lang or "und", Counter())
            for k in (1, 2, 3):
                own.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return out


def brute(rows, least, top, share=50):
    out = []
    for lang, f in counted(rows).items():
        n = sum(c for g, c in f.items() if len(g) == 1)
        found = []
        for g, a in f.items():
            if len(g) == 1 or a < least:
                continue
            longer = [c for h, c in f.items() if len(h) == 3 > len(g) and c >= least and g in (h[:2], h[1:])]
            if any(100 * c >= share * a for c in longer):
                continue
            cuts = [(1000000 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def mined(df, least, top):
    rows = collocations.mine(df, min_count=least, top=top).collect()
    return sorted((r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in rows)


def some_rows(seed, n):
    rng = random.Random(seed)
    words = [*"abcdefg", "É", "\x1fz", "Grüße", " "]
    fixed = "this Passage\tstands in many texts just as it is"
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(6)):
            parts.append(" ".join(rng.choice(words[: rng.randrange(1, 12)]) for _ in range(rng.randrange(9))))
            if rng.random() < 0.3:
                parts.append(fixed)
        text = "".join(p + rng.choice([". ", ", ", "\n", " ", "!?", "\r\n "]) for p in parts)
        rows.append((rng.choice([text, text.upper(), None]), rng.choice(["x", "x", "x", "y", None])))
    return rows


@pytest.mark.parametrize("seed, least, top", [(1, 2, 10_000), (2, 5, 10_000), (3, 10, 15)])
def test_against_plain_counting(spark, seed, least, top):
    rows = some_rows(seed, 200)
    df = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    assert mined(df, least, top) == brute(rows, least, top)


def test_compacted_paths(spark):
    rows = some_rows(4, 150)
    df = spark.createDataFrame(rows, "text string, lang string")
    graph = collocations.graph(df, min_count=4)
    f = counted(rows)["x"]
    nodes = {r.node: r for r in graph.nodes.filter("lang = 'x'").collect()}
    assert {n: r.f for n, r in nodes.items()} == {" ".join(g): c for g, c in f.items() if len(g) == 2 and c >= 4}
    passage = "passage stands in many texts just as it"
    for r in nodes.values():
        w = tuple(r.node.split(" "))
        entering = [c for g, c in f.items() if len(g) == 3 and g[1:] == w]
        leaving = [c for g, c in f.items() if len(g) == 3 and g[:2] == w]
        assert r.unary == (entering == [r.f] and leaving == [r.f])
        assert (r.path_words is not None) == r.unary
    assert nodes["many texts"].path_words == 10
    texts = {r.phrase: r for r in collocations.path_texts(graph).filter("lang = 'x'").collect()}
    whole = texts[f"this {passage} is"]
    assert (whole.words, whole.a) == (10, f["many", "texts"])
    assert sum(r.words - 3 for r in texts.values()) == sum(r.unary for r in nodes.values())


def test_a_long_path(spark):
    text = " ".join(f"w{i}" for i in range(1500))
    df = spark.createDataFrame([(text, "x")] * 12, "text string, lang string")
    graph = collocations.graph(df)
    (path,) = collocations.path_texts(graph).collect()
    assert (path.phrase, path.words, path.a) == (text, 1500, 12)
    assert collocations.mine(df).count() == 1498


def test_odd_rows(odd, none):
    rows = [(r.text, r.lang) for r in odd.collect()]
    assert mined(odd, 2, 2000) == brute(rows, 2, 2000)
    assert mined(odd, 10, 2000) == brute(rows, 10, 2000)
    assert mined(none, 10, 2000) == []


def test_scores_beyond_64_bits(spark):
    big = 3 * 10**12
    df = spark.createDataFrame([(big, big + 1, big + 7)], "a bigint, l bigint, r bigint")
    assert df.select(collocations._score("l", "r")).first()[0] == 10**6 * big * big // ((big + 1) * (big + 7))
