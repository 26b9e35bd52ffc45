import pytest

LONG = "word " * 30_000 + "x" * 300_000
TEXTS = [
    (1, "Licensed under the Apache License, Version 2.0.\nThe end."),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (5, LONG),
    (6, "a b c d e f g h i j"),
    (7, "A B C D E F G H I J"),
    (8, "a b c d e f g h i j k"),
    (9, "one two"),
    (10, "one two"),
    (11, "Grüße, 漢字 😀! <|endoftext|> it's fine.  \n\n"),
    (11, "Grüße, 漢字 😀! <|endoftext|> it's fine.  \n\n"),
    (None, "a row without an id"),
]
CLASHING = "words string, hash int, t int, row int, bits string, prefix string, part int, size int, cls int, n_words int, kept string, host string, score string, next string, shard string, root bigint, visit int, quality_score double, bad_symbols boolean, component_id bigint, node string, lang_of string, weight bigint, digest string, part_name string, row_key bigint"


@pytest.fixture(scope="session")
def odd(spark):
    """NULLs, empty, long and repeated texts, ties, and columns with names the operators use."""
    extra = [None] * len(CLASHING.split(","))
    rows = [(i, text, None, "src", None, *extra) for i, text in TEXTS]
    schema = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {CLASHING}"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
