"""CSV feeds with any number of layouts in one scan.

A header line per file is read on the executors (one small ranged read each); the data is then scanned once for all
layouts by position, and each row finds its columns through its file's header. One plan serves one layout or thousands.

A first scan of the lines tells how many cells the widest line of each file may have, and which files have quoted cells that go on over lines.
Such files are put together from their lines, see `stitched_records`, so that also they are read by as many tasks as they have splits."""
from __future__ import annotations

import csv
import io
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sellthrough.functions.text import standard_header
from sellthrough.operators.joins import join_bounded
from sellthrough.session import materialise
from sellthrough.sources.files import reader_path
from sellthrough.sources.layout import ambiguous, column_positions, empty_feed, from_cells
from sellthrough.sources.states import with_state

# Wider files are taken apart line by line, as the reader by position has a column for each cell of the widest one.
MAX_COLUMNS = 1000
NOT_CLOSED = "a quoted cell is not closed"

# A quoted cell up to its closing quote, and a cell. Possessive, as each has one reading only.
_REST = r'(?:[^"]++|"")*+"'
_CELL = rf'(?:"{_REST}[^,]*+|[^",][^,]*+|)'
_STAYS_OUTSIDE = rf"^{_CELL}(?:,{_CELL})*+$"
_COMES_OUTSIDE = rf"^{_REST}[^,]*+(?:,{_CELL})*+$"


def _header_cells(uri: str) -> list[str]:
    """Cells of the first line that is not blank."""
    from pyarrow import fs

    scheme, _, rest = uri.partition(":")
    if scheme == "file":
        uri = "file:///" + rest.lstrip("/")
    elif scheme in ("s3a", "s3n"):
        uri = "s3:" + rest
    filesystem, path = fs.FileSystem.from_uri(uri)
    with filesystem.open_input_stream(path) as stream:
        lines = io.TextIOWrapper(io.BufferedReader(stream), encoding="utf-8-sig", errors="replace", newline="")
        return next((cells for cells in csv.reader(lines) if cells), [])


def _read_headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        names, errors = [], []
        for uri in batch["source_file"]:
            try:
                names.append(list(map(standard_header, _header_cells(uri))))
                errors.append(None)
            except csv.Error as error:      # the file's fault; a file that cannot be opened is the system's
                names.append([])
                errors.append(f"the header cannot be read: {error}")
        yield pd.DataFrame({"source_file": batch["source_file"], "names": names, "header_error": errors})


def csv_layouts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(source_file, names, positions, layout_error): the standard column names of every file, in file order, and where
    the needed ones stand."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    names = files.select(F.col("_metadata.file_path").alias("source_file"))
    tasks = min(max(1, len(paths) // 8), 1000)
    layouts = names.repartition(tasks).mapInPandas(_read_headers, "source_file string, names array<string>, header_error string")
    return layouts.select("source_file", "names", F.coalesce("header_error", ambiguous(F.col("names"))).alias("layout_error"),
                          column_positions(F.col("names")).alias("positions"))


def csv_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(source_file, split, line_no, value): all lines, numbered in order within each split of their file."""
    return spark.read.text(paths).select(F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("split"),
                                         F.monotonically_increasing_id().alias("line_no"), "value")


def _ends_inside(line: Column, began_inside: bool) -> Column:
    """Whether a quoted cell is open after a line."""
    quoted = line.contains('"')
    if began_inside:
        return ~(quoted & line.rlike(_COMES_OUTSIDE))
    return quoted & ~line.rlike(_STAYS_OUTSIDE)


def csv_shapes(lines: DataFrame) -> DataFrame:
    """(source_file, widest, has_breaks): bound of a line's cells, and whether some quoted cell goes on over lines. While no line that begins outside
    a quoted cell ends inside one, none does."""
    commas = F.length("value") - F.length(F.replace("value", F.lit(","), F.lit("")))
    return lines.groupBy("source_file").agg((F.max(commas) + 1).alias("widest"), F.max(_ends_inside(F.col("value"), False)).alias("has_breaks"))


def stitched_records(lines: DataFrame) -> DataFrame:
    """(source_file, record_no, record, problem): the records of files whose quoted cells go on over lines; the header is record 1.

    What a line does to the state (inside a quoted cell or not) depends on the state before it in one of three ways: it sets it, flips it or
    leaves it. Such steps can be joined: first the lines of each split, then the splits of each file, of which there are few. So the state
    before every line is known without reading a file in order. A record begins with each line that begins outside and isn't blank; only the
    lines of records of several lines are brought together. A file whose last quoted cell is open makes one row with a problem."""
    outside, inside = _ends_inside(F.col("value"), False).cast("int"), _ends_inside(F.col("value"), True).cast("int")
    rows = lines.select("*", outside.alias("o"), inside.alias("i"))
    rows = rows.withColumn("to_state", F.when(F.col("o") == F.col("i"), F.col("o"))).withColumn(
        "flips", F.when((F.col("o") == 1) & (F.col("i") == 0), 1).otherwise(0)).drop("o", "i")
    rows = materialise(with_state(rows, ["source_file", "split"], "line_no"), "csv-lines")

    splits = rows.groupBy("source_file", "split").agg(F.sum("flips").alias("n"), F.max_by(F.struct("to_state", "all_flips"), F.when(
        F.col("to_state").isNotNull(), F.col("line_no"))).alias("last"))
    set_to = (F.col("last.to_state") + F.col("n") - F.col("last.all_flips")) % 2
    splits = splits.select("source_file", "split", set_to.alias("to_state"), F.when(F.col("last").isNull(), F.col("n") % 2).otherwise(0).alias("flips"))
    splits = with_state(splits, ["source_file"], "split").withColumn("start", F.coalesce("fixed", F.col("turned") % 2))
    splits = splits.select("source_file", "split", "start", F.coalesce("to_state", (F.col("start") + F.col("flips")) % 2).alias("end"))
    splits = materialise(splits, "csv-splits")
    ends = splits.groupBy("source_file").agg(F.max_by("end", "split").alias("end"))
    problems = ends.filter("end = 1").select("source_file")

    rows = join_bounded(rows, splits.join(problems, "source_file", "left_anti"), ["source_file", "split"], "inner", splits.count())
    rows = rows.select("source_file", "split", "line_no", "value", F.coalesce("fixed", (F.col("start") + F.col("turned")) % 2).alias("inside"))
    rows = rows.filter((F.col("inside") == 1) | (F.trim("value") != ""))
    rows = rows.withColumn("begins", (F.col("inside") == 0).cast("int"))
    in_split = Window.partitionBy("source_file", "split").orderBy("line_no")
    rows = rows.withColumn("nth", F.sum("begins").over(in_split.rowsBetween(Window.unboundedPreceding, 0)))
    # The last line of a split may go on in the next one.
    rows = materialise(rows.withColumn("alone", F.coalesce((F.col("begins") == 1) & (F.lead("begins").over(in_split) == 1), F.lit(False))), "csv-states")
    earlier = rows.groupBy("source_file", "split").agg(F.sum("begins").alias("n"))
    before = Window.partitionBy("source_file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    earlier = earlier.select("source_file", "split", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    rows = join_bounded(rows, earlier, ["source_file", "split"], "inner", splits.count()).withColumn("record_no", F.col("earlier") + F.col("nth"))
    none = F.lit(None).cast("string").alias("problem")
    alone = rows.filter("alone").select("source_file", "record_no", F.col("value").alias("record"), none)
    parts = F.sort_array(F.collect_list(F.struct("split", "line_no", "value")))
    joined = rows.filter("not alone").groupBy("source_file", "record_no").agg(F.array_join(F.transform(parts, lambda x: x.value), "\n").alias("record"))
    return alone.unionByName(joined.withColumn("problem", none)).unionByName(
        problems.select("source_file", F.lit(0).cast("long").alias("record_no"), F.lit("").alias("record"), F.lit(NOT_CLOSED).alias("problem")))


def record_cells(record: Column) -> Column:
    """The cells of one record, as many as it has. Text after a closing quote makes the cell plain text, quotes included."""
    quoted = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(rf",({_CELL})"), 1)
    plain = F.transform(quoted, lambda c: F.when(c.rlike(rf'^"{_REST}$'), F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c))
    return F.when(record.contains('"'), plain).otherwise(F.split(record, ","))


def read_csv_feed(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Raw feed rows of the given files, all cells text. A row with more cells than its file's header keeps them all, which makes it a reject.
    A file in which a quoted cell is never closed is a fault, and makes one row that carries it."""
    if not paths:
        return empty_feed(spark)
    layouts = materialise(csv_layouts(spark, paths), "layouts")
    shapes = materialise(csv_shapes(csv_lines(spark, paths)).withColumn("apart", F.col("has_breaks") | (F.col("widest") > MAX_COLUMNS)), "shapes")
    files = layouts.count()
    width = shapes.filter("not apart").agg(F.max("widest")).first()[0]
    taken_apart = [r.source_file for r in shapes.filter("apart").select("source_file").collect()]
    whole = {reader_path(p) for p in taken_apart}
    plain = [p for p in paths if p not in whole] if whole else paths
    parts = []
    if plain:
        cells = [f"c{i}" for i in range(width or 1)]
        read = (spark.read.schema(", ".join(f"{c} string" for c in cells)).options(header=True, quote='"', escape='"', encoding="UTF-8").csv(plain))
        last = F.greatest(F.lit(0), F.lit(0), *[F.when(F.col(c) != "", i + 1) for i, c in enumerate(cells)])
        parts.append(read.select(F.col("_metadata.file_path").alias("source_file"), F.array(*[F.coalesce(c, F.lit("")) for c in cells]).alias("cells"),
                                 last.alias("last"), F.lit(None).cast("string").alias("problem")))
    if whole:
        records = stitched_records(csv_lines(spark, sorted(whole))).filter("record_no <> 1")
        records = records.select("source_file", record_cells(F.col("record")).alias("cells"), "problem")
        last = F.coalesce(F.array_max(F.transform("cells", lambda c, i: F.when(c != "", i + 1))), F.lit(0))
        parts.append(records.select("source_file", F.transform("cells", lambda c: F.coalesce(c, F.lit(""))).alias("cells"), last.alias("last"), "problem"))
    joined = join_bounded(reduce(DataFrame.unionByName, parts), layouts, "source_file", "inner", files)
    joined = joined.withColumn("layout_error", F.coalesce("layout_error", "problem"))
    # Up to the header's width, or to the last cell beyond it that holds something.
    width, size = F.greatest(F.size("names"), F.col("last")), F.size("cells")
    kept = F.when(width <= size, F.slice("cells", F.lit(1), width)).otherwise(F.concat("cells", F.array_repeat(F.lit(""), F.greatest(width - size, F.lit(0)))))
    return from_cells(joined.withColumn("cells", kept))
