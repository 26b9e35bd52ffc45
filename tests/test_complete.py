import pytest
from conftest import cells

from panelkit.operators.complete import (
    axis_of,
    complete_grid,
    complete_within,
    copy_latest,
    copy_year,
    fill_entities,
    to_country_panel,
)
from panelkit.operators.joins import missing_keys, override_observed, override_with
from panelkit.operators.panel import (
    as_panel,
    assert_unique_key,
    below_minimum,
    write_panel,
)

SCHEMA = "region string, period int, value double"


def test_grid_has_every_combination(frame):
    df = frame(SCHEMA, [("A", 1, 1.0), ("B", 3, 2.0), (None, 1, 5.0)])
    want = {
        ("A", 1): 1.0,
        ("A", 3): None,
        ("B", 1): None,
        ("B", 3): 2.0,
        (None, 1): 5.0,
        (None, 3): None,
    }
    assert cells(complete_grid(df, ["region"]), "region", "period") == want


def test_complete_within(frame):
    df = frame("driver string, period int, region string", [("x", 1, "A"), ("y", 2, "A")])
    got = {(r.driver, r.period): r.region for r in complete_within(df, "driver", "period").collect()}
    assert got == {("x", 1): "A", ("x", 2): None, ("y", 1): None, ("y", 2): "A"}


def test_fill_entities_adds_and_removes(frame):
    df = frame(SCHEMA, [("A", 1, 1.0), ("A", 2, None), ("X", 1, 9.0)])
    got = cells(fill_entities(df, ["A", "B"], fill=0.0), "region", "period")
    assert got == {("A", 1): 1.0, ("A", 2): None, ("B", 1): 0.0, ("B", 2): 0.0}
    got = cells(to_country_panel(df, ["A"], fill=0.0, null_to_zero=True), "region", "period")
    assert got == {("A", 1): 1.0, ("A", 2): 0.0}


def test_copy_latest_year(frame):
    df = frame(SCHEMA, [("A", 2000, 1.0), ("A", 2002, 3.0)])
    got = cells(copy_latest(df, range(2000, 2004)), "period")
    assert got == {2000: 1.0, 2001: 3.0, 2002: 3.0, 2003: 3.0}


def test_copy_year_adds_to_what_is_there(frame):
    df = frame(SCHEMA, [("A", 2023, 1.0), ("A", 2024, 5.0)])
    rows = sorted((r.period, r.value) for r in copy_year(df, 2023, [2024, 2025]).collect())
    assert rows == [(2023, 1.0), (2024, 1.0), (2024, 5.0), (2025, 1.0)]


def test_axis_is_sorted_and_distinct(frame, spark):
    df = frame(SCHEMA, [("A", 3, 1.0), ("B", 1, 1.0), ("C", 3, 1.0), ("D", None, 1.0)])
    assert sorted(r[0] for r in axis_of(df, "period").collect()) == [1, 3]


OBSERVED = [
    ("Observed", "R1", "V", 2020, 5.0),
    ("Observed", "R1", "V", 2030, None),
    ("SSP1", "R1", "V", 2020, 7.0),
    ("SSP1", "R1", "V", 2030, 9.0),
    ("SSP1", "R2", "V", 2020, 4.0),
    ("Other", "R1", "V", 2020, 6.0),
]
SSP = [f"SSP{i}" for i in range(1, 6)]


def test_observed_rows_displace(frame):
    df = frame("s string, region string, v string, period int, value double", OBSERVED)
    keys = ["region", "v", "period"]
    got = cells(override_observed(df, "s", "Observed", SSP, keys), "s", "region", "period")
    want = {(s, "R1", 2020): 5.0 for s in SSP} | {(s, "R1", 2030): None for s in SSP}
    assert got == want | {("SSP1", "R2", 2020): 4.0, ("Other", "R1", 2020): 6.0}
    got = cells(
        override_observed(df, "s", "Observed", SSP, keys, require_value=True),
        *["s", "region", "period"],
    )
    want = {(s, "R1", 2020): 5.0 for s in SSP}
    assert got == want | {
        ("SSP1", "R1", 2030): 9.0,
        ("SSP1", "R2", 2020): 4.0,
        ("Other", "R1", 2020): 6.0,
    }


def test_override_matches_null_keys(frame):
    base = frame(SCHEMA, [(None, 1, 1.0), ("A", 1, 2.0)])
    overlay = frame(SCHEMA, [(None, 1, 9.0)])
    got = cells(override_with(base, overlay, ["region", "period"]), "region", "period")
    assert got == {(None, 1): 9.0, ("A", 1): 2.0}
    assert missing_keys(base, overlay, ["region", "period"]).count() == 1


def test_panel_contract(frame, tmp_path, spark):
    raw = frame("iso string, y string, kind string, v double", [("A", "2000", "x", float("nan"))])
    panel = as_panel(raw, "iso", "y", "v")
    assert panel.dtypes == [
        ("region", "string"),
        ("period", "int"),
        ("kind", "string"),
        ("value", "double"),
    ]
    assert panel.first().value is None
    twice = panel.union(panel)
    with pytest.raises(ValueError):
        assert_unique_key(twice, ["region", "period", "kind"])
    assert assert_unique_key(panel, ["region", "period", "kind"]) is panel
    assert below_minimum(frame(SCHEMA, [("A", 1, -1.0), ("A", 2, 1.0)]), 0.0).count() == 1
    write_panel(panel, str(tmp_path / "panel"))
    again = spark.read.parquet(str(tmp_path / "panel"))
    assert again.select("region", "period", "kind").first() == ("A", 2000, "x")
