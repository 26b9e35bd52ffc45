import pytest
from conftest import cells
from pyspark.sql import functions as F

from panelkit.functions import ratio_or_zero
from panelkit.operators.allocate import (
    allocate_group_total,
    expand_group,
    fold_group,
    group_shares,
    map_groups,
    net_of_group,
    reallocate_excess,
    split_by_share,
    zero_out,
)
from panelkit.operators.joins import combine

CELL = ["region", "period"]
GROUPS = ["bulk", "diffuse"]
LONG = "region string, period int, sector_group string, value double"


def groups(frame, **values):
    return frame(LONG, [("A", 1, g, float(v)) for g, v in values.items()])


@pytest.mark.parametrize(
    "limit, covered, moved, capped, shares",
    [
        ((100, 50), (120, 20), (100, 40), (100, 40), (1, 0.8)),
        ((100, 50), (120, 45), (100, 65), (100, 50), (1, 1)),
        ((100, 50), (120, 60), (110, 70), (100, 50), (1, 1)),
        ((0, 0), (5, 0), (0, 5), (0, 0), (0, 0)),
    ],
)
def test_reallocate_and_cap(frame, limit, covered, moved, capped, shares):
    have = groups(frame, bulk=covered[0], diffuse=covered[1])
    most = groups(frame, bulk=limit[0], diffuse=limit[1])
    free = cells(reallocate_excess(have, most, CELL, GROUPS), "sector_group")
    assert free == dict(zip(GROUPS, moved))
    bound = reallocate_excess(have, most, CELL, GROUPS, capped=True)
    assert cells(bound, "sector_group") == dict(zip(GROUPS, capped))
    share = combine(bound, most, ratio_or_zero, [*CELL, "sector_group"])
    assert cells(share, "sector_group") == pytest.approx(dict(zip(GROUPS, shares)))


def test_split_and_shares(frame):
    base = groups(frame, bulk=60, diffuse=40)
    covered = groups(frame, all=30, bulk=10, diffuse=0)
    got = cells(split_by_share(covered, base, CELL, "all", GROUPS), "sector_group")
    assert got == {"bulk": 28.0, "diffuse": 12.0}
    assert cells(group_shares(base, CELL, GROUPS), "sector_group") == {"bulk": 0.6, "diffuse": 0.4}
    nothing = cells(group_shares(groups(frame, bulk=0), CELL, GROUPS), "sector_group")
    assert nothing == {"bulk": None, "diffuse": None}


def test_fold(frame):
    df = groups(frame, all=5, bulk=10, diffuse=0, other=3, bunkers=2)
    got = cells(fold_group(df, CELL, "all", GROUPS, keep=["bunkers"]), "sector_group")
    assert got == {"bulk": 15.0, "diffuse": 5.0, "bunkers": 2.0}


def test_map_groups_is_dense(frame):
    df = frame("region string, period int, sector string, value double", [("A", 1, "x", 2.0), ("A", 1, "z", 9.0)])
    got = cells(map_groups(df, CELL, {"g": ["x"], "h": ["y"]}, "sector"), "sector_group")
    assert got == {"g": 2.0, "h": 0.0}


def taxes(frame):
    rows = [
        ("own", "A", 1, 30.0),
        ("own", "A", 2, 15.0),
        ("own", "A", 3, 30.0),
        ("rest", "A", 1, 7.0),
        (None, "A", 1, 8.0),
    ]
    return frame("kind string, region string, period int, value double", rows)


def test_net_of_group(frame):
    bloc = frame("region string, period int, value double", [("A", 1, 20.0), ("A", 2, 20.0)])
    out = net_of_group(taxes(frame), F.col("kind") == "own", bloc, CELL)
    # 30 - 20 stays, 15 <= 20 and a year without a bloc price go, an unknown kind goes
    assert sorted((r.kind, r.period, r.value) for r in out.collect()) == [
        ("own", 1, 10.0),
        ("rest", 1, 7.0),
    ]


def test_expand_group(frame):
    df = frame("id string, region string, value double", [("bloc", "EU", 1.0), ("bloc", "EU", 1.0), ("x", "A", 2.0)])
    out = expand_group(df, F.col("id") == "bloc", ["A", "B"], keep=F.col("id") != "bloc")
    assert sorted(map(tuple, out.collect())) == [("bloc", "A", 1.0), ("bloc", "B", 1.0), ("x", "A", 2.0)]


def test_allocate_group_total(frame):
    totals = frame("period int, value double", [(1, 60.0)])
    base = frame(
        "region string, period int, value double",
        [("A", 1, 100.0), ("B", 1, 50.0), ("C", 1, 70.0), ("A", 2, 5.0)],
    )
    got = cells(allocate_group_total(totals, base, ["A", "B"]), "region", "period")
    assert got == {("A", 1): 40.0, ("B", 1): 20.0, ("A", 2): 0.0}


def test_zero_out(frame):
    df = frame("region string, value double", [("A", 1.0), ("LIE", 2.0)])
    assert cells(zero_out(df, ["LIE"]), "region") == {"A": 1.0, "LIE": 0.0}
