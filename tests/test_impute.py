from conftest import cells
from pyspark.sql import functions as F

from panelkit.operators.aggregate import (
    aggregate_regions,
    distinct_counts,
    fill_summary,
    first_per_key,
    sum_out,
)
from panelkit.operators.impute import attach_weight, impute, weight_table, zero_fill_flagged
from panelkit.operators.reshape import drop_constant_columns

ROW = (
    "region string, RegionCode string, driver string, driver_name string, unit string, "
    "weight string, period int, value double, weight_val double"
)


def rows(frame, unit, weights=(1.0, 3.0, 2.0)):
    values = [10.0, 20.0, None]
    return frame(
        ROW,
        [
            (r, "G", "d", None, unit, "pop", 1, v, w)
            for r, v, w in zip("ABC", values, weights)
        ],
    )


def imputed(df):
    return {r.region: (r.value_filled, r.fill_type) for r in impute(df).collect()}


def test_relative_unit_takes_the_average(frame):
    got = imputed(rows(frame, "% of GDP"))
    assert got == {
        "A": (10.0, "original"),
        "B": (20.0, "original"),
        "C": (17.5, "filled_no_scaling"),
    }


def test_absolute_unit_is_scaled(frame):
    assert imputed(rows(frame, "billion USD"))["C"] == (8.75, "filled_scaled")
    assert imputed(rows(frame, None))["C"] == (8.75, "filled_scaled")


def test_missing_weight_makes_the_average_missing(frame):
    got = imputed(rows(frame, "% of GDP", (1.0, None, 2.0)))
    assert got["C"] == (None, "filled_no_scaling")


def test_weights(frame):
    df = frame("region string, period int, weight string", [("A", 1, "GDP"), ("A", 1, "area"), ("B", 1, None)])
    panel = "region string, period int, value double"
    table = weight_table(frame(panel, [("A", 1, 8.0), ("B", 1, 3.0)]), frame(panel, [("A", 1, 2.0)]))
    assert cells(table, "region", value="gdp_per_capita") == {"A": 4.0, "B": None}
    got = sorted((r.region, r.weight, r.weight_val) for r in attach_weight(df, table).collect())
    assert got == [("A", "gdp", 8.0), ("A", "pop", 2.0), ("B", "pop", None)]
    steady = frame("region string, gdp double, pop double", [("A", 8.0, 2.0), ("B", 3.0, None)])
    assert got == sorted((r.region, r.weight, r.weight_val) for r in attach_weight(df, steady).collect())


def test_flagged_series_take_first_metadata(frame):
    mapping = frame(
        "type string, driver string, unit string, na_is_zero string, line int",
        [("late", "d", "u2", "TRUE", 2), ("early", "d", "u1", "TRUE", 1), ("late", "e", "u3", None, 3)],
    )
    df = frame(
        "region string, type string, driver string, unit string, na_is_zero boolean, value double",
        [("A", "late", "d", "u2", True, None), ("A", "late", "e", "u3", False, None)],
    )
    got = {(r.type, r.driver, r.unit): r.value for r in zero_fill_flagged(df, mapping, ["line"]).collect()}
    assert got == {("early", "d", "u1"): 0.0, ("late", "e", "u3"): None}


def test_first_per_key(frame):
    df = frame("k string, a int, line int", [("x", 1, 2), ("x", None, 1), (None, 3, 3)])
    got = {r.k: (r.a, r.line) for r in first_per_key(df, ["k"], ["line"]).collect()}
    assert got == {"x": (None, 1), None: (3, 3)}


def test_aggregate_regions(frame):
    mapping = frame("CountryCode string, RegionCode string", [("A", "G"), ("B", "G"), ("C", "H")])
    data = [("A", 1, 10.0, 1.0), ("B", 1, 20.0, 3.0), ("C", 1, 5.0, 2.0), ("X", 1, 9.0, 9.0)]
    weighted = frame("region string, period int, value double, weight double", data)
    assert cells(aggregate_regions(weighted, mapping), "region") == {"G": 17.5, "H": 5.0}
    assert cells(aggregate_regions(weighted.drop("weight"), mapping), "region") == {"G": 30.0, "H": 5.0}


def test_sum_out(frame):
    df = frame("region string, kind string, value double", [("A", "x", 1.0), ("A", "y", None), ("B", "x", None)])
    assert cells(sum_out(df, ["kind"]), "region") == {"A": 1.0, "B": 0.0}
    assert cells(sum_out(df, ["kind"], strict=True), "region") == {"A": None, "B": None}


def test_constant_columns_and_summary(frame):
    df = frame("a int, b int, c int, d int", [(1, 1, None, None), (1, 2, 3, None)])
    assert drop_constant_columns(df).columns == ["b", "c"]
    assert distinct_counts(df).first().asDict() == {"a": 1, "b": 2, "c": 2, "d": 1}
    summary = fill_summary(frame("fill_type string", [("o",), ("o",), ("f",)]))
    assert {r.fill_type: (r.n, r.pct) for r in summary.collect()} == {"o": (2, 66.7), "f": (1, 33.3)}


def test_imputation_matches_null_group_keys(frame):
    df = rows(frame, None).withColumn("RegionCode", F.lit(None).cast("string"))
    assert imputed(df)["C"] == (8.75, "filled_scaled")


def test_summed_rows_need_no_weight(frame):
    """Where rows are summed by nature a missing weight does not make the total missing."""
    schema = "region string, variable string, value double, weight double"
    rows = [("A", "migration", 1.0, None), ("B", "migration", 2.0, None), ("A", "share", 10.0, 1.0), ("B", "share", 20.0, 3.0)]
    mapping = frame("CountryCode string, RegionCode string", [("A", "G"), ("B", "G")])
    got = aggregate_regions(frame(schema, rows), mapping, summed=F.col("variable") == "migration")
    assert {r.variable: (r.value, r.weight) for r in got.collect()} == {"migration": (3.0, None), "share": (17.5, 4.0)}
