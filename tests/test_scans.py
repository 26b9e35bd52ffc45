"""What plans read and shuffle: shared aggregates, pushed filters, grids in many tasks."""

import os
import re
from dataclasses import replace

import pytest
from conftest import cells
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import __spark_entry__ as contract
from panelkit.catalog import dashboard
from panelkit.catalog.tables import all_nations
from panelkit.functions import in_years, recode, recoded_to
from panelkit.operators.complete import complete_grid, expand, to_country_panel
from panelkit.operators.gaps import complete_and_fill, numbered
from panelkit.operators.panel import Result, as_panel, counted, read_panel, unique_cells, write_panel
from panelkit.plans.carbon import carbon_price
from panelkit.session import durable
from tools.plans import plan_of

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture()
def without_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def rows_per_partition(df):
    return [r.n for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]


def test_an_unbroadcast_grid_uses_all_tasks(spark, without_broadcast):
    keys = spark.range(20_000).select(F.col("id").alias("k"))
    grid = expand(keys, list(range(300)), "label")
    sizes = rows_per_partition(grid)
    assert sum(sizes) == 6_000_000
    assert len(sizes) >= 6 and max(sizes) < 3 * sum(sizes) / len(sizes)


def test_a_grid_of_few_keys_uses_all_tasks(spark, without_broadcast):
    keys = spark.createDataFrame([("a",), (None,)], "k string")
    axis = spark.range(50_000).select(F.col("id").cast("int").alias("x"))
    grid = expand(keys, axis, "label")
    sizes = rows_per_partition(grid)
    assert sum(sizes) == 100_000 and len(sizes) >= 6
    assert grid.distinct().count() == 100_000


def counting(df):
    """``df``, and an accumulator of the rows that are read of it."""
    read = df.sparkSession.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    return df.mapInArrow(run, df.schema), read


@tables
@pytest.mark.parametrize("subtype", ["effectivePrice", "shareEmissionsCovered"])
def test_history_is_read_once(spark, subtype):
    board = dashboard.dashboard(spark, SF_DIR)
    history = durable(board.history)
    counted_history, read = counting(history)
    board = replace(board, history=counted_history)
    result = carbon_price(spark, board, all_nations(spark, SF_DIR), subtype, dashboard.HISTORY, dashboard.EXCLUDED)
    want = contract.queries()["effective_price" if subtype == "effectivePrice" else "carbon_share_covered"](spark, SF_DIR)
    assert result.data.count() == want.count()
    assert read.value == history.count()


def test_a_grid_reads_its_source_twice(frame):
    rows = [(f"r{i % 40}", i % 23, float(i)) for i in range(900)]
    df = frame("region string, period int, value double", sorted(set(rows)))
    source, read = counting(df)
    assert complete_grid(source, ["region"]).count() >= 40 * 23
    assert read.value == 2 * df.count()
    source, read = counting(df.distinct())
    assert to_country_panel(source, ["r1", "r2", "x"], fill=0.0).count() > 0
    assert read.value == 2 * df.distinct().count()


@tables
@pytest.mark.parametrize(
    "name, filters",
    [
        ("sum_out_type", ["EqualTo(l_linestatus,F)"]),
        ("sum_out_strict", ["EqualTo(l_linestatus,F)"]),
        ("fold_all_group", ["EqualTo(l_linestatus,F)"]),
        ("drop_constant_columns", ["EqualTo(l_linestatus,F)", "EqualTo(l_returnflag,N)"]),
        ("melt_chosen_years", ["GreaterThanOrEqual(o_orderdate,1999-01-01", "LessThan(o_orderdate,2001-01-01"]),
    ],
)
def test_filters_behind_labels_and_years_reach_the_scan(spark, name, filters):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = plan_of(contract.queries()[name](spark, SF_DIR))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = " ".join(re.findall(r"PushedFilters: \[[^\]]*\]", plan))
    for f in filters:
        assert f in pushed


def test_predicates_on_raw_columns_select_the_same_rows(frame):
    labels = {"A": "one", "B": "two", "C": "one"}
    df = frame("x string", [(v,) for v in ["A", "B", "C", "D", None]])
    for wanted in (["one"], ["two"], ["one", "two"], ["three"], []):
        direct = df.filter(recode(F.col("x"), labels).isin(wanted))
        assert sorted(map(str, direct.collect())) == sorted(map(str, df.filter(recoded_to(F.col("x"), labels, wanted)).collect()))
    days = frame("d string", [(f"{y}-{m}",) for y in range(1997, 2004) for m in ("01-01", "06-30", "12-31")] + [(None,)])
    days = days.select(F.col("d").cast("date").alias("d"), F.to_timestamp_ntz("d").alias("t"))
    for years in ([1999, 2000], [1998, 2000, 2001], [2003], []):
        want = days.filter(F.year("d").isin(years)).count()
        assert days.filter(in_years(F.col("d"), years)).count() == want
        assert days.filter(in_years(F.col("t"), years)).count() == want


def test_periods_are_numbered_in_parallel(spark, frame):
    labels = spark.range(0, 9_000, 3).select(F.col("id").cast("int").alias("p"))
    out = numbered(labels, "p", "slot")
    assert {r.p: r.slot for r in out.collect()} == {3 * i: i + 1 for i in range(3_000)}
    assert {r.p: r.slot for r in numbered(frame("p string", [("b",), ("a",), ("c",)]), "p", "slot").collect()} == {
        "a": 1, "b": 2, "c": 3,
    }
    assert numbered(frame("p int", []), "p", "slot").collect() == []
    facts = frame("k string, period int, value double", [("x", 3, 1.0), ("x", 9, 4.0)])
    filled = complete_and_fill(facts, ["k"], labels)
    assert filled.count() == 3_000
    lines = plan_of(filled).splitlines()
    below = [lines[i + 1] for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert all("Aggregate" in line for line in below)


def test_two_values_of_a_cell_are_an_error(frame):
    facts = frame("k string, period int, value double", [("x", 1, 1.0), ("x", 1, 2.0), ("x", 3, 2.0)])
    with pytest.raises(PySparkException, match="two values"):
        complete_and_fill(facts, ["k"], [1, 2, 3]).collect()


def test_unique_cells(frame):
    schema = "region string, period int, kind string, value double, weight double"
    rows = [("A", 1, "x", 1.0, None), ("A", 2, "x", None, 1.0), (None, 1, "x", 3.0, None), ("A", 1, None, 4.0, 2.0)]
    got = unique_cells(frame(schema, rows))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, rows))
    twice = unique_cells(frame(schema, [*rows, (None, 1, "x", 3.0, None)]))
    for read in (twice.collect, twice.count):
        with pytest.raises(PySparkException, match="occurs twice: NULL, 1, x"):
            read()


def test_unique_cells_with_keys_that_may_repeat(frame):
    schema = "region string, period int, value double"
    rows = [(None, 1, 1.0), (None, 1, 2.0), ("A", 1, 3.0)]
    got = unique_cells(frame(schema, rows), unless=F.col("region").isNull()).collect()
    assert sorted((r.region or "", r.period) for r in got) == [("", 1), ("A", 1)]
    with pytest.raises(PySparkException, match="occurs twice: A, 1"):
        unique_cells(frame(schema, [*rows, rows[2]]), unless=F.col("region").isNull()).collect()


def test_the_sink_keeps_the_panel(spark, frame, tmp_path):
    raw = frame("iso string, y int, kind string, v double", [(f"R{i % 50:02d}", 2000 + i // 50, "x", float(i)) for i in range(500)])
    panel = unique_cells(as_panel(raw, "iso", "y", "v"))
    write_panel(panel, str(tmp_path / "panel"))
    again = read_panel(spark, str(tmp_path / "panel"), panel.schema)
    assert again.schema == panel.schema
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, panel.collect()))
    folders = [f for f in os.listdir(tmp_path / "panel") if f.startswith("period=")]
    assert len(folders) == 10
    for folder in folders:
        regions = [r.region for r in spark.read.parquet(str(tmp_path / "panel" / folder)).collect()]
        assert regions == sorted(regions)
    pushed = plan_of(again.filter("period = 2003"))
    assert "PartitionFilters: [isnotnull(period" in pushed


def test_counts_on_the_way(frame):
    df = frame("region string, period int, value double", [("A", 1, -1.0), ("A", 2, 1.0), ("B", 1, None)])
    out, counts = counted(df, negative=F.col("value") < 0, empty=F.col("value").isNull())
    assert out.count() == 3 and counts.get == {"negative": 1, "empty": 1}
    result = Result(df, "unit", "text", minimum=0.0).checked(all=F.lit(True))
    assert cells(result.data, "region", "period") == {("A", 1): -1.0, ("A", 2): 1.0, ("B", 1): None}
    assert result.counts.get == {"all": 3, "below_minimum": 1}


def test_grid_from_one_aggregate_keeps_null_keys(frame):
    df = frame("region string, period int, value double", [("A", 1, 1.0), (None, 3, 5.0), ("B", None, 2.0)])
    got = cells(complete_grid(df, ["region"]), "region", "period")
    assert got == {(r, p): {("A", 1): 1.0, (None, 3): 5.0}.get((r, p)) for r in ("A", "B", None) for p in (1, 3)}
