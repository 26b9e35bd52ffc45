"""The filter audit against plain Python, on texts that fail every mixture of filters."""

import random
import re
from itertools import permutations

import pytest

from panelkit.llm import filter_audit

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()


def some_text(rng):
    n = rng.choice([0, 3, 150, 250])
    words = [f"{rng.choice(WORDS)}{rng.randrange(1000) if rng.random() < 0.6 else ''}" for _ in range(n)]
    text = " ".join(words)
    if rng.random() < 0.3:
        text = text.upper()
    return text + rng.choice(["", "", " #", "\n\t|", " é"])


def fails(rows):
    out = []
    for doc_id, text, _ in rows:
        text = text or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        mine = ""
        mine += "A" if len(words) < 200 else ""
        mine += "B" if 100 * len(set(words)) < 50 * len(words) else ""
        mine += "C" if 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text) else ""
        mine += "D" if set(text) & set("#$%&*|") else ""
        known = doc_id is not None
        mine += "E" if known and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in rows) else ""
        out.append(mine)
    return out


def brute(rows, labels):
    found, out = fails(rows), {}
    good = {i for i, q, _ in labels if q == 1} - {None}
    toxic = {i for i, _, t in labels if t == 1} - {None}
    for part in {r[2] or "" for r in rows}:
        own = [(r[0], f) for r, f in zip(rows, found) if (r[2] or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = list(own)
            for step, name in enumerate(order, 1):
                gone = [x for x in left if name in x[1]]
                redundant = sum(name in f for _, f in own) - len(gone)
                left = [x for x in left if name not in x[1]]
                shapley[name] += len(gone)
                only = sum(f == name for _, f in own)
                lost = [sum(i in s for i, _ in gone) for s in (good, toxic)]
                out[part, order, step] = [len(left), len(gone), redundant, only, *lost]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audited(df, labels):
    rows = filter_audit.audit(df, labels).collect()
    out = {(r.part, r.filter_order, r.step): [r[c] for c in COLUMNS] for r in rows}
    assert len(out) == len(rows)
    return out


def test_against_plain_python(spark):
    rng = random.Random(11)
    texts = [some_text(rng) for _ in range(60)]
    rows = [(i, rng.choice(texts), rng.choice(["a", "a", "a", "b", "", None])) for i in range(150)]
    rows += [(7, rows[7][1], "a"), (None, rows[3][1], "b"), (None, None, None), (151, None, "b"), (152, "", "a")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 150, 2)]
    labels += [(7, 1, 0), (7, 0, 1), (9999, 1, 1), (None, 1, 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    assert audited(df, marks) == brute(rows, labels)


def test_odd_rows(spark, odd, none, no_labels):
    rows = [(r.doc_id, r.text, r.source) for r in odd.collect()]
    assert audited(odd, no_labels) == brute(rows, [])
    assert filter_audit.audit(none, no_labels).collect() == []


@pytest.mark.parametrize("prefix", ["", "A", "CE", "ABCDE"])
def test_survivors(spark, prefix):
    rng = random.Random(2)
    rows = [(i, some_text(rng), "x") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    numbered = filter_audit.measured(df)
    tables = filter_audit.id_tables(numbered, spark.createDataFrame([], "doc_id bigint, quality int, toxic int"))
    left = {r.doc_id for r in filter_audit.survivors(numbered, tables, prefix).collect()}
    assert left == {r[0] for r, f in zip(rows, fails(rows)) if not set(f) & set(prefix)}


def test_a_large_group_of_copies_is_spread(spark):
    rows = spark.range(20_000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'same', concat('t', id)) AS text", "'s' AS source")
    numbered = filter_audit.measured(rows)
    assert filter_audit.copies(numbered).count() == 6_666
