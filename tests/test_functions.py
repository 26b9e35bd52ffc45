from pyspark.sql import functions as F

from panelkit import constants as K
from panelkit import functions as fn


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first().asDict()


def num(v):
    return F.lit(v).cast("double")


def test_numbers_and_missing(spark):
    got = one(
        spark,
        nan=fn.nan_to_null(F.lit(float("nan"))),
        kept=fn.nan_to_null(num(1.5)),
        text=fn.to_number(F.lit("n/a")),
        number=fn.to_number(F.lit(" 1.5e3")),
        suffix=fn.to_number(F.lit("12d")),
        least=fn.least_strict(num(1), num(2)),
        least_null=fn.least_strict(num(None), num(2)),
        zero_zero=fn.ratio_or_zero(num(0), num(0)),
        ratio=fn.ratio_or_zero(num(1), num(4)),
        ratio_null=fn.ratio_or_zero(num(None), num(0)),
        null_member=fn.member_of(F.lit(None).cast("string"), ["a"]),
    )
    assert got == {
        "nan": None,
        "kept": 1.5,
        "text": None,
        "number": 1500.0,
        "suffix": None,
        "least": 1.0,
        "least_null": None,
        "zero_zero": 0.0,
        "ratio": 0.25,
        "ratio_null": None,
        "null_member": False,
    }


def test_aggregates(frame):
    rows = [("a", None, 1.0), ("b", 2.0, 1.0), ("b", None, None), ("c", 1.0, None), ("d", 4.0, 0.0)]
    df = frame("k string, x double, w double", rows).groupBy("k").agg(
        fn.sum_zero(F.col("x")).alias("zero"),
        fn.sum_strict(F.col("x")).alias("strict"),
        fn.weighted_mean(F.col("x"), F.col("w")).alias("mean"),
    )
    got = {r["k"]: (r["zero"], r["strict"], r["mean"]) for r in df.collect()}
    assert got == {
        "a": (0.0, None, None),
        "b": (2.0, None, 2.0),  # the NULL weight sits next to a NULL value
        "c": (1.0, 1.0, None),  # a missing weight next to a value
        "d": (4.0, 4.0, None),  # no weight at all
    }


def test_coverage_and_april_text(spark):
    share, world = fn.extract_groups(
        F.lit("45.5% of jurisdiction emissions, 1% of global emissions"), K.COVERAGE_PATTERN, 2
    )
    none, _ = fn.extract_groups(F.lit("n/a"), K.COVERAGE_PATTERN, 2)
    dollars, local = fn.extract_groups(F.lit("US$ 1,234.5 (EUR 1,100)"), K.APRIL_PRICE_PATTERN, 2)
    got = one(spark, share=share, world=world, none=none, dollars=dollars, local=local)
    assert got == {
        "share": "45.5",
        "world": "1",
        "none": None,
        "dollars": "1,234.5",
        "local": "EUR 1,100",
    }


def test_weight_choice(frame):
    names = ["population", "gdp", "GDP", "arableLand", None]
    df = frame("w string", [(n,) for n in names])
    chosen = df.select(fn.weight_choice(F.col("w")).alias("c"))
    assert [r.c for r in chosen.collect()] == ["pop", "gdp", "gdp", "pop", "pop"]


def test_unit_class(frame):
    units = ["% of GDP", "Index, 0-100", "electricity generation, TWh", "billion USD", None]
    df = frame("u string", [(u,) for u in units]).select(fn.is_relative_unit(F.col("u")).alias("r"))
    assert [r.r for r in df.collect()] == [True, True, True, False, None]


def test_recode_and_pick(frame):
    df = frame("t string", [("Carbon tax",), ("Carbon Tax",), ("ETS",), ("Undecided",), (None,)])
    got = df.select(fn.recode(F.col("t"), K.TYPE_LABELS).alias("r")).collect()
    assert [r.r for r in got] == ["carbon_tax", "carbon_tax", "ets", None, None]
    rows = frame("c string, a double, b double", [("a", 1.0, 2.0), ("b", 1.0, None), ("x", 1.0, 2.0)])
    picked = rows.select(fn.pick(F.col("c"), {"a": F.col("a"), "b": F.col("b")}).alias("v"))
    assert [r.v for r in picked.collect()] == [1.0, None, None]


def test_file_stem(spark):
    got = one(spark, a=fn.file_stem(F.lit("energy.v2.csv")), b=fn.file_stem(F.lit("plain")))
    assert got == {"a": "energy.v2", "b": "plain"}
