import random

from conftest import cells

from panelkit.operators.complete import complete_grid
from panelkit.operators.gaps import (
    complete_and_fill,
    fill_gaps,
    fill_gaps_chunked,
    fill_years,
    zero_fill,
)

SCHEMA = "region string, period int, value double"


def series(frame, values, periods=None):
    periods = periods or range(1, len(values) + 1)
    return frame(SCHEMA, [("A", p, v) for p, v in zip(periods, values)])


def filled(df, **options):
    got = cells(fill_gaps(df, ["region"], **options), "period")
    return [got[p] for p in sorted(got)]


def test_line_then_ends(frame):
    df = series(frame, [None, 2.0, None, None, 8.0, None])
    assert filled(df) == [2.0, 2.0, 4.0, 6.0, 8.0, 8.0]


def test_one_known_value(frame):
    assert filled(series(frame, [None, 5.0, None])) == [5.0, 5.0, 5.0]


def test_no_known_value(frame):
    assert filled(series(frame, [None, None])) == [None, None]


def test_position_or_period_as_axis(frame):
    df = series(frame, [0.0, None, 10.0], [2003, 2005, 2010])
    assert filled(df) == [0.0, 5.0, 10.0]
    assert abs(filled(df, by="period")[1] - 20 / 7) < 1e-12


def test_parts(frame):
    df = series(frame, [None, 2.0, None, 4.0, None])
    assert filled(df, parts=("linear",)) == [None, 2.0, 3.0, 4.0, None]
    assert filled(df, parts=("forward",)) == [None, 2.0, 2.0, 4.0, 4.0]
    assert filled(df, parts=("backward",)) == [2.0, 2.0, 4.0, 4.0, None]


def random_panel(frame, seed):
    rnd = random.Random(seed)
    rows = []
    for region in [*"ABCDEF", None]:
        known = rnd.choice([0, 0.1, 0.5])
        for period in range(0, 120):
            if rnd.random() < 0.8:
                rows.append((region, period, rnd.random() if rnd.random() < known else None))
    return frame(SCHEMA, rows)


def close(a, b):
    assert a.keys() == b.keys()
    for k in a:
        assert (a[k] is None) == (b[k] is None), k
        assert a[k] is None or abs(a[k] - b[k]) < 1e-9, (k, a[k], b[k])


def brute_force(df, by_period):
    """One pass per cell over all known points of its series."""
    out, by_region = {}, {}
    for r in df.collect():
        by_region.setdefault(r.region, []).append((r.period, r.value))
    for region, rows in by_region.items():
        rows.sort()
        x = [p if by_period else i for i, (p, _) in enumerate(rows)]
        for i, (period, value) in enumerate(rows):
            before = [j for j in range(i + 1) if rows[j][1] is not None]
            after = [j for j in range(i, len(rows)) if rows[j][1] is not None]
            if before and after and before[-1] != after[0]:
                a, b = before[-1], after[0]
                value = rows[a][1] + (rows[b][1] - rows[a][1]) * (x[i] - x[a]) / (x[b] - x[a])
            elif before or after:
                value = rows[before[-1] if before else after[0]][1]
            out[region, period] = value
    return out


def test_chunks_equal_whole_series(frame):
    df = random_panel(frame, 1).cache()
    for by in ("position", "period"):
        want = brute_force(df, by == "period")
        close(cells(fill_gaps(df, ["region"], by=by), "region", "period"), want)
        for chunk in (7, 50):
            got = fill_gaps_chunked(df, ["region"], chunk, by=by)
            close(cells(got, "region", "period"), want)


def test_complete_and_fill_equals_two_steps(frame):
    df = random_panel(frame, 2).cache()
    axis = list(range(0, 120, 2))
    two = fill_gaps(complete_grid(df.filter(df.period.isin(axis)), ["region"], axis), ["region"])
    one = complete_and_fill(df, ["region"], axis)
    close(cells(one, "region", "period"), cells(two, "region", "period"))


def test_series_without_rows_are_present(frame):
    df = frame(SCHEMA, [("A", 1, 3.0)])
    wanted = frame("region string", [("A",), ("B",)])
    got = cells(complete_and_fill(df, ["region"], [1, 2], series=wanted), "region", "period")
    assert got == {("A", 1): 3.0, ("A", 2): 3.0, ("B", 1): None, ("B", 2): None}


def test_fill_years(frame):
    df = frame(SCHEMA, [("A", 2000, 1.0), ("A", 2004, 5.0)])
    got = cells(fill_years(df, [1999, 2001, 2003, 2005]), "period")
    assert got == {1999: 1.0, 2001: 2.0, 2003: 4.0, 2005: 5.0}


def test_zero_fill(frame):
    df = frame("flag boolean, value double", [(True, None), (False, None), (True, 2.0)])
    got = zero_fill(df, df.flag).collect()
    assert [r.value for r in got] == [0.0, None, 2.0]
