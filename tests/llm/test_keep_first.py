"""One row of each group of near duplicates, decided per row."""

import random

from panelkit.llm import ngram_join

SCHEMA = "doc_id bigint, text string, note string"


def kept(spark, rows, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema).repartition(3)
    out = ngram_join.keep_first(df)
    assert out.columns == df.columns
    return sorted((r.doc_id if r.doc_id is not None else -1, r.text or "", r.note or "") for r in out.collect())


def words(seed, n=80):
    rng = random.Random(seed)
    return [f"w{rng.randrange(10_000)}" for _ in range(n)]


def near(text):
    return text + " end"


A, B, C = (" ".join(words(s)) for s in (1, 2, 3))


def test_rows_that_share_an_id_are_judged_apart(spark):
    assert kept(spark, [(3, A, ""), (5, near(A), ""), (5, B, "")]) == [(3, A, ""), (5, B, "")]
    assert kept(spark, [(5, A, ""), (5, near(A), ""), (5, B, ""), (4, near(B), "")]) in (
        [(4, near(B), ""), (5, A, "")],
        sorted([(4, near(B), ""), (5, near(A), "")]),
    )


def test_repeated_rows_and_rows_without_an_id(spark):
    assert kept(spark, [(7, A, "x")] * 4 + [(8, B, "y")]) == [(7, A, "x"), (8, B, "y")]
    assert kept(spark, [(None, A, ""), (9, near(A), ""), (None, B, ""), (None, B, ""), (None, C, "")]) == sorted(
        [(-1, B, ""), (-1, C, ""), (9, near(A), "")]
    )


def test_wordless_texts_stay(spark):
    rows = [(1, None, ""), (1, None, ""), (2, "", ""), (None, " \n", ""), (None, " \n", "")]
    assert len(kept(spark, rows)) == 5


def test_clashing_names_and_empty_tables(spark, odd, none):
    rows = [(1, A, 1, 2, 3, 4), (2, near(A), 1, 2, 3, 4), (3, B, 1, 2, 3, 4)]
    schema = "doc_id bigint, text string, row_key int, kept_key int, times int, component int"
    out = ngram_join.keep_first(spark.createDataFrame(rows, schema))
    assert sorted(map(tuple, out.collect())) == [rows[0], rows[2]]
    assert ngram_join.keep_first(none).collect() == []
    # 2, 3 and 4 have no words; 6, 7 and 8 are alike, 9 and 10 too, 11 stands twice
    ids = sorted(r.doc_id or 0 for r in ngram_join.keep_first(odd).collect())
    assert ids == [0, 1, 2, 3, 4, 5, 6, 9, 11]


def test_a_large_group_of_equal_rows(spark):
    rows = [(1, A, "")] * 3000 + [(i, near(A), "") for i in range(2, 500)] + [(0, B, "")]
    assert kept(spark, rows) == [(0, B, ""), (1, A, "")]
