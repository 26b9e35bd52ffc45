"""Readers for sheets, indicator folders and mapping tables, all as text exports.

The driver only looks at header lines; the rows are read by Spark.
"""

from __future__ import annotations

import csv
import re
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelkit.constants import CODE_REPAIRS, CODES_DROPPED
from panelkit.functions import file_stem, member_of, to_number
from panelkit.operators.reshape import normalise_headers
from panelkit.session import durable

_FILE_IDS = ["Country", "Code", "ContinentCode", "Year"]

# names a data frame may not have in the tool the indicator files are made for
_RESERVED = {
    "if", "else", "repeat", "while", "function", "for", "next", "break",
    "TRUE", "FALSE", "NULL", "Inf", "NaN", "NA", "in",
}


_BROKEN = "a quoted cell goes on behind the end of its line; read the file with multi_line=True"
_OPEN = "a quoted cell is never closed"


def read_sheet(
    spark: SparkSession, path: str, skip: int = 0, sep: str = ",", multi_line: bool = False
) -> DataFrame:
    """A sheet with ``skip`` records above its header, all columns as text.

    Headers are normalised; one that is blank or stands twice gets its position added. The
    records above the data are removed where they stand, at the start of a file's first block,
    so files are split and read in parallel, and a data row that repeats such a record
    stays. In a folder every file has these records and the same header. Blank lines are no
    data; lines end in LF or CR LF. A record is one line, and a quoted cell that goes on behind
    it is an error when rows are read. With ``multi_line`` such cells are read, in parallel
    too (see :func:`records`), and only a cell that is never closed is an error.
    """
    header = _repaired_names(_first_records(spark, path, skip + 1, sep, multi_line)[-1])
    lines = _lines(spark, path)
    if multi_line:
        rows = records(lines).filter(F.col("number") > skip + 1)
    else:
        rows = lines.filter(_checked(_quotes() % 2 == 1, _BROKEN)).filter(~_is_top(lines, skip + 1))
    parsed = _parsed(rows, len(header), sep)
    return normalise_headers(parsed.select("cells.*").toDF(*header))


def _lines(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    """``value, file, name, block, at``: lines, their file, their block's first byte, and an ascending number."""
    lines = spark.read.options(lineSep="\n", **options).text(path)
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
    )


def _quotes() -> Column:
    return F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))


def _checked(wrong: Column, message: str) -> Column:
    """A condition that always holds, or fails with the message."""
    return F.when(wrong, F.raise_error(F.lit(message)).cast("boolean")).otherwise(True)


def _is_top(lines: DataFrame, count: int) -> Column:
    """Whether a line is one of the first of its file.

    Lines are numbered on in a partition. The first block of a lone file is the first of
    its partition; of several files, the number at which each begins is looked up.
    """
    number = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    if len(lines.inputFiles()) > 1:
        starts = lines.filter("block = 0").groupBy("file").agg(F.min("at").alias("start"))
        entries = starts.agg(F.map_from_entries(F.collect_list(F.struct("file", "start"))).alias("starts"))
        number = F.col("at") - F.element_at(entries.scalar(), F.col("file"))
    return (F.col("block") == 0) & (number < count)


def records(lines: DataFrame) -> DataFrame:
    """``value, file, number``: the records of CSV lines whose quoted cells may hold line breaks.

    A line begins a record if an even number of quotes stands before it in its file. The
    quotes are counted per block; a running count over the blocks, one row each, tells every
    block whether it begins inside a cell. Lines that are whole records then pass as they
    are, the others are put together, across blocks where need be. ``number`` counts the
    records of a file, from 1.
    """
    inside = Window.partitionBy("file", "block").orderBy("at")
    before = F.coalesce(F.sum("odd").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    local = lines.withColumn("odd", _quotes() % 2).withColumn("before", before)
    # how many lines up to here begin a record if the block itself does, and if it does not
    local = local.withColumn("even_starts", F.sum(1 - F.col("before")).over(inside))
    local = local.withColumn("odd_starts", F.sum("before").over(inside))

    blocks = local.groupBy("file", "block").agg(
        (F.sum("odd") % 2).alias("turns"), F.max("even_starts").alias("evens"), F.max("odd_starts").alias("odds")
    )
    whole = Window.partitionBy("file")
    earlier = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("into", F.coalesce(F.sum("turns").over(earlier), F.lit(0)) % 2)
    begun = F.when(F.col("into") == 0, F.col("evens")).otherwise(F.col("odds"))
    blocks = blocks.select(
        F.col("file").alias("in_file"),
        F.col("block").alias("in_block"),
        "into",
        (F.sum("turns").over(whole) % 2 == 1).alias("open"),
        F.coalesce(F.sum(begun).over(earlier), F.lit(0)).alias("prior"),
    )
    joined = local.join(blocks, (F.col("file") == F.col("in_file")) & (F.col("block") == F.col("in_block")))
    joined = joined.filter(_checked(F.col("open"), _OPEN))
    # lines before a block's first own record go on with the last one of an earlier block
    own = F.when(F.col("into") == 0, F.col("even_starts")).otherwise(F.col("odd_starts"))
    joined = joined.withColumn("number", F.col("prior") + own)
    alone = (F.col("odd") == 0) & ((F.col("before") + F.col("into")) % 2 == 0)

    parts = F.array_sort(F.collect_list(F.struct("block", "at", "value")))
    split = joined.filter(~alone).groupBy("file", "number").agg(
        F.array_join(F.transform(parts, lambda x: x["value"]), "\n").alias("value")
    )
    return joined.filter(alone).select("value", "file", "number").unionByName(split)


def _parsed(rows: DataFrame, width: int, sep: str) -> DataFrame:
    """``rows`` with ``cells``, the cells of the record in ``value``; blank records are left out."""
    record = F.regexp_replace("value", "\r$", "")
    options = {"sep": sep, "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}
    schema = ", ".join(f"c{i} string" for i in range(width))
    filled = rows.withColumn("value", record).filter(F.length(F.trim("value")) > 0)
    return filled.withColumn("cells", F.from_csv("value", F.lit(schema), options))


def _first_records(
    spark: SparkSession, path: str, count: int, sep: str, multi_line: bool
) -> list[list[str]]:
    """The first records of a file; with ``multi_line`` as many lines are fetched as they span."""
    n = count
    while True:
        lines = [r.value.removesuffix("\r") for r in spark.read.option("lineSep", "\n").text(path).head(n)]
        if not multi_line:
            return [next(csv.reader([line], delimiter=sep), []) for line in lines]
        parser = csv.reader((line + "\n" for line in lines), delimiter=sep)
        records = list(islice(parser, count))
        # the last record is whole if the parser stopped before the lines ran out
        if len(lines) < n or (len(records) == count and parser.line_num < len(lines)):
            return records
        n *= 4


def read_mapping(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """A mapping table, all columns as text; a blank cell is an empty string."""
    return spark.read.option("header", True).option("sep", sep).csv(path).fillna("")


def read_indicator_folder(spark: SparkSession, path: str) -> DataFrame:
    """All CSV files of a folder as ``region, period, type, driver, value``.

    The file name without extension is the ``type``, each column besides the ids
    a ``driver``. One job looks at the first line of every file, whatever their number; the
    rows of all files are read in one scan, and each row finds its file's column
    names in a table with a row per file. So neither jobs nor plan grow with files or headers.
    """
    lines = _lines(spark, path, pathGlobFilter="*.csv")
    if not lines.inputFiles():
        raise FileNotFoundError(f"no *.csv in {path}")
    top = lines.filter("block = 0").groupBy("file").agg(
        F.min_by(F.regexp_replace("value", "\r$", ""), "at").alias("header"), F.min("at").alias("start")
    )
    found = durable(top)
    headers = [r.header for r in found.select("header").distinct().toLocalIterator()]
    if not headers:
        raise FileNotFoundError(f"no *.csv with a header in {path}")
    cut = {h: _distinct_names(next(csv.reader([h]), [])) for h in headers}
    named = [(h, mangle_header(names)) for h, names in cut.items()]
    for header, columns in named:
        if not {"Code", "Year"} <= set(columns):
            raise ValueError(f"no Code and Year in the header {header!r}")
    names = spark.createDataFrame(named, "h string, names array<string>")
    files = found.join(names, F.col("header") == F.col("h")).select(F.col("file").alias("named"), "names", "start")

    rows = lines.filter(_checked(_quotes() % 2 == 1, _BROKEN)).join(files, F.col("file") == F.col("named"))
    rows = rows.filter("at > start")
    width = max(len(names) for names in cut.values())
    parsed = _parsed(rows, width, ",")
    cells = F.array(*[F.col(f"cells.c{i}") for i in range(width)])
    one = parsed.select("name", "names", cells.alias("cells"))

    def cell(name: str) -> Column:
        return F.try_element_at("cells", F.array_position("names", name).cast("int"))

    pairs = F.filter(F.arrays_zip("names", "cells"), lambda x: x["names"].isNotNull() & ~x["names"].isin(_FILE_IDS))
    long = one.select(
        cell("Code").alias("region"),
        cell("Year").try_cast("int").alias("period"),
        file_stem(F.col("name")).alias("type"),
        F.explode(pairs).alias("pair"),
    ).select(
        "region",
        "period",
        "type",
        F.replace("pair.names", F.lit("."), F.lit("_")).alias("driver"),
        to_number(F.col("pair.cells")).alias("value"),
    )
    return long.replace(CODE_REPAIRS, subset=["region"]).filter(
        ~member_of(F.col("region"), CODES_DROPPED)
    )


def mangle_header(names: list[str]) -> list[str]:
    """Column names as letters, digits, dots and underscores, made unique."""
    out = []
    for name in names:
        clean = re.sub(r"[^\w.]", ".", name)
        if not re.match(r"[^\W\d_]|\.(?!\d)", name):
            clean = "X" + clean
        out.append(clean + "." if clean in _RESERVED else clean)
    return _distinct_names(out, sep=".")


def _distinct_names(names: list[str], sep: str = "...") -> list[str]:
    seen: dict[str, int] = {}
    out = []
    for name in names:
        n = seen.get(name, 0)
        seen[name] = n + 1
        out.append(f"{name}{sep}{n}" if n else name)
    return out


def _repaired_names(names: list[str]) -> list[str]:
    """Sheet headers made unique: a name that is blank or stands twice gets its position, from 1.

    A position that a name already carries is taken off before.
    """
    plain = [re.sub(r"(\.\.\.\d+)+$", "", n) for n in names]
    return [f"{n}...{i}" if not n or plain.count(n) > 1 else n for i, n in enumerate(plain, 1)]
