import csv
import io
import random

import pytest
from pyspark.errors import PySparkException

from panelkit.operators.reshape import (
    align_columns,
    melt_years,
    normalise_headers,
    widen_years,
    year_columns,
)
from panelkit.sources import mangle_header, read_indicator_folder, read_mapping, read_sheet

SHEET = """\
Some title,,,
Updated,2025,,
Unique ID,"Agriculture, Forestry",2020,2021
T1,"a ""quoted"", text",1.5,
T2,,n/a,3
"""


def test_read_sheet_skips_preamble(spark, tmp_path):
    path = tmp_path / "sheet.csv"
    path.write_text(SHEET)
    df = read_sheet(spark, str(path), skip=2)
    assert df.columns == ["unique_id", "agriculture,_forestry", "2020", "2021"]
    assert sorted(map(tuple, df.collect())) == [
        ("T1", 'a "quoted", text', "1.5", None),
        ("T2", None, "n/a", "3"),
    ]
    long = melt_years(df, ["unique_id"])
    assert {(r.unique_id, r.period): r.value for r in long.collect()} == {
        ("T1", 2020): 1.5,
        ("T1", 2021): None,
        ("T2", 2020): None,
        ("T2", 2021): 3.0,
    }
    only = melt_years(df, ["unique_id"], keep=[2021], drop_missing=True)
    assert [tuple(r) for r in only.collect()] == [("T2", 2021, 3.0)]


def test_rows_equal_to_heading_lines_stay(spark, tmp_path):
    path = tmp_path / "sheet.csv"
    path.write_text(SHEET + "Updated,2025,,\nSome title,,,\n")
    df = read_sheet(spark, str(path), skip=2)
    assert sorted(r.unique_id for r in df.collect()) == ["Some title", "T1", "T2", "Updated"]


@pytest.mark.parametrize("note", ["one line", "two\nlines", "a\n\n\n\n\n\nb"])
def test_cells_with_line_breaks(spark, tmp_path, note):
    path = tmp_path / "sheet.csv"
    top = f'Title,"{note}",\n"Unique\nID",Note,"{note} 2020"\n'
    path.write_text(top + f'T1,"first ""line""\n{note}",1\nT2,plain,2\nTitle,"{note}",\n')
    df = read_sheet(spark, str(path), skip=1, multi_line=True)
    assert df.columns[1] == "note" and len(df.columns) == 3
    assert sorted(map(tuple, df.collect())) == [
        ("T1", f'first "line"\n{note}', "1"),
        ("T2", "plain", "2"),
        ("Title", note, None),
    ]


@pytest.fixture()
def small_blocks(spark):
    """Files are read in blocks of a few bytes."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")

    def set_bytes(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))

    yield set_bytes
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def some_cell(rng):
    kinds = ["", "plain", "a b", 'say ""', "x\ny", "\n\n", '"\n"', "long " * 9, "one\r\ntwo", ",", "é\n漢"]
    return "".join(rng.choice(kinds) for _ in range(rng.randrange(4)))


@pytest.mark.parametrize("seed, block", [(1, 7), (2, 40), (3, 300), (4, 1 << 20)])
def test_line_breaks_over_many_blocks(spark, tmp_path, small_blocks, seed, block):
    rng = random.Random(seed)
    rows = [[str(i), some_cell(rng), some_cell(rng)] for i in range(120)]
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=rng.choice(["\n", "\r\n"]))
    writer.writerows([["a title\nover lines", "", ""], ["Id", "Free\ntext", "More"], *rows])
    (tmp_path / "sheet.csv").write_bytes(out.getvalue().encode())
    small_blocks(block)
    df = read_sheet(spark, str(tmp_path / "sheet.csv"), skip=1, multi_line=True)
    assert df.columns == ["id", "free\ntext", "more"]
    want = sorted((a, b or None, c or None) for a, b, c in rows)
    assert sorted(map(tuple, df.collect())) == want
    if block < 1000:
        scan = spark.read.text(str(tmp_path / "sheet.csv")).rdd.getNumPartitions()
        assert scan > 1


def test_a_record_over_several_blocks(spark, tmp_path, small_blocks):
    note = "\n".join(f"line {i}" for i in range(200))
    (tmp_path / "s.csv").write_text(f'Id,Note\n1,"{note}"\n2,x\n3,"{note}"\n')
    small_blocks(64)
    got = {r.id: r.note for r in read_sheet(spark, str(tmp_path / "s.csv"), multi_line=True).collect()}
    assert got == {"1": note, "2": "x", "3": note}


def test_a_broken_cell_is_an_error_by_default(spark, tmp_path):
    path = tmp_path / "sheet.csv"
    path.write_text('Id,Note\n1,"two\nlines"\n2,x\n')
    df = read_sheet(spark, str(path))
    for read in (df.collect, df.count):
        with pytest.raises(PySparkException, match="multi_line"):
            read()


def test_a_cell_that_is_never_closed_is_an_error(spark, tmp_path, small_blocks):
    path = tmp_path / "sheet.csv"
    path.write_text('Id,Note\n1,"two\nlines"\n2,"x\n' + "3,y\n" * 50)
    small_blocks(64)
    with pytest.raises(PySparkException, match="never closed"):
        read_sheet(spark, str(path), multi_line=True).collect()


def test_a_folder_of_sheets(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"{i}.csv").write_text(f"Title,\nId,Note\n{i},a\nTitle,\nId,Note\n")
    for multi_line in (False, True):
        df = read_sheet(spark, str(tmp_path), skip=1, multi_line=multi_line)
        assert sorted(r.id for r in df.collect()) == [*"01234", *["Id"] * 5, *["Title"] * 5]


def test_names_by_position(spark, tmp_path):
    (tmp_path / "s.csv").write_text("Id,,Id,Total,\n1,2,3,4,5\n")
    df = read_sheet(spark, str(tmp_path / "s.csv"))
    assert df.columns == ["id...1", "...2", "id...3", "total", "...5"]
    assert tuple(df.first()) == ("1", "2", "3", "4", "5")


def test_blank_mapping_cell_is_empty_text(spark, tmp_path):
    path = tmp_path / "map.csv"
    path.write_text("unique_id;sector_group;Status\nT1;bulk;x\nT2;;y\n")
    got = read_mapping(spark, str(path)).collect()
    assert [tuple(r) for r in got] == [("T1", "bulk", "x"), ("T2", "", "y")]


def test_indicator_folder(spark, tmp_path):
    (tmp_path / "energy.csv").write_text(
        "Country,Code,ContinentCode,Year,Oil use (%),GDP per capita\n"
        "Costa Rica,CRC,NA,2000,1,2\nPalestine,PS,AS,2000,,x\nEuro,XC,EU,2000,3,4\n"
    )
    (tmp_path / "labour.v1.csv").write_text(
        'Country,Code,ContinentCode,Year,"Jobs, total"\n"A, B",AAA,EU,2001,7\n'
    )
    (tmp_path / "money.csv").write_text(
        'Country,Code,ContinentCode,Year,"Jobs, total"\nA,AAA,EU,2002,8\n'
    )
    (tmp_path / "notes.txt").write_text("not an indicator file")
    got = {tuple(r) for r in read_indicator_folder(spark, str(tmp_path)).collect()}
    assert got == {
        ("CRI", 2000, "energy", "Oil_use____", 1.0),
        ("CRI", 2000, "energy", "GDP_per_capita", 2.0),
        ("PSE", 2000, "energy", "Oil_use____", None),
        ("PSE", 2000, "energy", "GDP_per_capita", None),
        ("AAA", 2001, "labour.v1", "Jobs__total", 7.0),
        ("AAA", 2002, "money", "Jobs__total", 8.0),
    }


def test_many_indicator_files_take_as_many_jobs_as_one(spark, tmp_path):
    def jobs(folder, n):
        for i in range(n):
            (folder / f"f{i}.csv").write_text(f"Code,Year,Driver {i}\r\nAAA,2000,{i}\r\nBBB,2001,\r\n")
        spark.sparkContext.setJobGroup(folder.name, "")
        try:
            rows = read_indicator_folder(spark, str(folder)).collect()
        finally:
            spark.sparkContext.setJobGroup("", "")
        want = {("AAA", 2000, f"f{i}", f"Driver_{i}", float(i)) for i in range(n)}
        want |= {("BBB", 2001, f"f{i}", f"Driver_{i}", None) for i in range(n)}
        assert set(map(tuple, rows)) == want and len(rows) == 2 * n
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(folder.name))

    (tmp_path / "few").mkdir()
    (tmp_path / "many").mkdir()
    few, many = jobs(tmp_path / "few", 40), jobs(tmp_path / "many", 300)
    assert many <= few + 1


def test_indicator_file_without_ids(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Country,Year,x\nA,2000,1\n")
    with pytest.raises(ValueError, match="Code"):
        read_indicator_folder(spark, str(tmp_path))


def test_empty_indicator_folder(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_indicator_folder(spark, str(tmp_path))


def test_mangle_header():
    names = ["GDP per capita", "% of GDP", "2000", ".5x", "if", "Code", "Code"]
    assert mangle_header(names) == [
        "GDP.per.capita",
        "X..of.GDP",
        "X2000",
        "X.5x",
        "if.",
        "Code",
        "Code.1",
    ]


def test_headers_and_year_columns(frame):
    df = frame("`Unique ID` string, `1990` double, `19x` double, `2000.5` double", [])
    assert normalise_headers(df).columns == ["unique_id", "1990", "19x", "2000.5"]
    assert year_columns(df) == ["1990", "2000.5"]
    assert year_columns(df, r"^\d{4}$") == ["1990"]


def test_widen_and_melt_are_inverse(frame):
    df = frame("region string, period int, value double", [("A", 1, 1.0), ("A", 2, None), ("B", 2, 4.0)])
    wide = widen_years(df, ["region"], [1, 2])
    assert {r.region: (r["1"], r["2"]) for r in wide.collect()} == {"A": (1.0, None), "B": (None, 4.0)}
    back = align_columns(melt_years(wide, drop_missing=True), df)
    assert sorted(map(tuple, back.collect())) == [("A", 1, 1.0), ("B", 2, 4.0)]
